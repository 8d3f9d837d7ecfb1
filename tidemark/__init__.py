"""Spark-native analytics for keyed multilingual text corpora."""
