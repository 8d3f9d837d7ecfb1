"""Training-data operators: ten stand-alone components over text, page and label tables.

Nothing outside this subpackage imports it. Every operator takes and returns
DataFrames; see the module docstrings for the treatment of nulls, empty texts,
ties and repeated rows.
"""
