"""Proposed edits, reviewer decisions, patches and dictionary standardisation as snapshots with a log."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import fixed_values as V
from tidemark.functions import text as T
from tidemark.operators import relational as R
from tidemark.operators import rules


def guard_proposals(texts: DataFrame, proposals: DataFrame, keys: Sequence[str], text: str = "text", unknown: str | None = None) -> DataFrame:
    """Every proposal against its original text; pure spacing edits are dropped, other rejects keep their reason.

    Proposals of unknown keys are dropped like those of a list that names no text,
    unless ``unknown`` is the status with which they come out, without texts.
    """
    edits = proposals.where(~rules.spacing_only(F.col("target"), F.col("replacement")))
    found = edits.join(texts.select(*keys, F.col(text).alias("original"), F.lit(True).alias("__known")), list(keys), "inner" if unknown is None else "left")
    guard = rules.guard_edit(F.col("original"), F.col("target"), F.col("replacement"), F.col("issue_type"))
    guarded = found.withColumn("g", guard).select(*proposals.columns, "original", "__known", "g.*")
    status = F.col("status") if unknown is None else F.when(F.col("__known"), F.col("status")).otherwise(F.lit(unknown))
    return guarded.select(*proposals.columns, "original", F.col("text").alias("proposed"), status.alias("status"))


def split_verdicts(guarded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Guarded proposals as (accepted, rejected); the rejects keep their reason."""
    passed = F.col("status") == V.PASSED
    return guarded.where(passed), guarded.where(~passed)


def spacing_fallback(texts: DataFrame, candidates: DataFrame, keys: Sequence[str], text: str = "text", candidate: str = "spaced") -> DataFrame:
    """The first candidate by (tier, ord) that changes spacing only, else the original and a rejection."""
    joined = candidates.join(texts.select(*keys, F.col(text).alias("original")), list(keys))
    tried = rules.lock_spacing(joined, F.col("original"), F.col(candidate), "r")
    best = tried.where("r.ok").groupBy(*keys).agg(F.min_by("r", F.struct("tier", "ord")).alias("r"))
    return texts.join(best, list(keys), "left").select(*keys, F.coalesce("r.text", text).alias("text"), F.coalesce("r.status", F.lit(V.CHARACTER_MISMATCH)).alias("status"))


def approved_changes(texts: DataFrame, reviews: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """Reviewed rows that change their text: (keys, ord, old_text, new_text). Unknown keys fail."""
    parsed = reviews.withColumn("decision", rules.decision(F.col("answer"))).where("decision in ('approve', 'custom')")
    wanted = F.when(F.col("decision") == "approve", T.trim_ws(F.coalesce("proposed", F.lit("")))).otherwise(T.trim_ws(F.col("answer")))
    parsed = parsed.select(*keys, "ord", wanted.alias("wanted")).where("wanted != ''")
    joined = R.strict_join(parsed, texts.select(*keys, F.col(text).alias("old_text")), keys)
    return joined.withColumn("new_text", T.typography(F.col("wanted"))).where(R.changed(F.col("old_text"), F.col("new_text"))).select(*keys, "ord", "old_text", "new_text")


def apply_changes(texts: DataFrame, changes: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """The next snapshot: of several changes to a text the last by ``ord`` wins."""
    last = R.last_wins(changes.select(*keys, "ord", "new_text"), keys, ["ord"]).drop("ord")
    return texts.join(last, list(keys), "left").withColumn(text, F.coalesce("new_text", text)).drop("new_text").select(*texts.columns)


def change_log(changes: DataFrame, keys: Sequence[str], version: int, reviews: DataFrame | None = None) -> DataFrame:
    """The log of applied changes: ``version``, keys, issue type, explanation, two empty columns, old and new text.

    Issue types and explanations come from ``reviews`` (keys, ord, issue_type, explanation).
    """
    log = changes
    if reviews is not None:
        log = changes.join(reviews.select(*keys, "ord", "issue_type", "explanation"), [*keys, "ord"], "left")
    said = [F.col(c) if reviews is not None else F.lit(None).cast("string") for c in ("issue_type", "explanation")]
    return log.select(
        F.lit(version).cast("long").alias("version"),
        *keys,
        F.coalesce(said[0], F.lit(V.REVIEW_ISSUE)).alias("issue_type"),
        F.concat(F.lit(V.REVIEW_NOTE), F.coalesce(said[1], F.lit(""))).alias("explanation"),
        F.lit("").alias("target_phrase"),
        F.lit("").alias("replacement_phrase"),
        "old_text",
        "new_text",
    )


def review_run(texts: DataFrame, reviews: DataFrame, keys: Sequence[str], version: int, text: str = "text") -> tuple[DataFrame, DataFrame, int]:
    """(next snapshot, change log, its version): a run that changes nothing keeps the version."""
    changes = approved_changes(texts, reviews, keys, text)
    if changes.isEmpty():
        return texts, change_log(changes, keys, version), version
    noted = reviews if {"issue_type", "explanation"} <= set(reviews.columns) else None
    return apply_changes(texts, changes, keys, text), change_log(changes, keys, version + 1, noted), version + 1


def fan_out_standard(layouts: dict[str, DataFrame], columns: dict[str, Sequence[str]], keep_null: bool = False, **tables) -> tuple[dict[str, DataFrame], DataFrame]:
    """One change table over all layouts of a corpus: (layout -> rewritten rows, a row of counts per layout).

    ``columns`` names each layout's text columns; counts are of rows and of changed rows.
    """
    done = {name: standardize(df, columns[name], keep_null, **tables) for name, df in layouts.items()}
    counts = [df.agg(F.count(F.lit(1)).alias("n"), F.count_if("changed").alias("changed")).select(F.lit(name).alias("layout"), "n", "changed") for name, df in done.items()]
    return {name: df.drop("changed") for name, df in done.items()}, reduce(DataFrame.unionByName, counts)


def apply_patches(texts: DataFrame, patches: DataFrame, keys: Sequence[str], text: str = "text") -> DataFrame:
    """(keys, src, target) replaced everywhere in their texts; a patch whose text or phrase is missing fails."""
    hit = R.strict_join(patches, texts.select(*keys, F.col(text).alias("old_text")), keys)
    present = F.when(F.contains("old_text", "src"), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("phrase not found: "), F.col("src"))))
    return hit.where(present).select(*keys, "old_text", F.replace("old_text", F.col("src"), F.col("target")).alias("new_text"))


def census(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Occurrences of each pattern over all rows, one column each."""
    return df.agg(*[F.coalesce(F.sum(F.regexp_count(F.col(text), F.lit(p))), F.lit(0)).cast("long").alias(n) for n, p in patterns.items()])


def replace_everywhere(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Ordered literal replacement in every text column."""
    pairs = list(pairs)
    return df.withColumns({f.name: T.in_order(F.col(f"`{f.name}`"), pairs) for f in df.schema if f.dataType.simpleString() == "string"})


def standardize(df: DataFrame, columns: Sequence[str], keep_null: bool = False, **tables) -> DataFrame:
    """Canonical spellings in ``columns``, and ``changed`` where any of them changed."""
    out = {c: T.canonicalize(F.col(c), keep_null=keep_null, **tables) for c in columns}
    flag = F.lit(False)
    for c, new in out.items():
        flag = flag | R.changed(F.col(c), new)
    return df.withColumn("changed", flag).withColumns(out)
