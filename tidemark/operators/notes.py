"""Note pools, re-indexing of inline markers, and audits of marker placement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import kernels
from tidemark.functions import text as T
from tidemark.operators import rules


def note_pool(items: DataFrame, group: str, order: str, notes: str) -> DataFrame:
    """(group, note_id, text) of all notes with a leading id; of equal ids the last wins."""
    each = items.select(group, order, F.posexplode(notes).alias("at", "note")).withColumn("note_id", T.note_id(F.col("note")))
    each = each.where("note_id != ''")
    return each.groupBy(group, "note_id").agg(F.max_by(T.note_text(F.col("note")), F.struct(order, "at")).alias("text"))


def reindex(annotated: Column, clean: Column, notes: Column) -> Column:
    """Struct (annotated, notes, count): markers and notes numbered 1..n, the old id kept."""
    some = F.size(F.coalesce(notes, F.array())) > 0
    numbered = F.transform(
        notes,
        lambda n, i: F.struct((i + 1).alias("note_id"), n["note_id"].alias("original_id"), F.concat(F.lit("["), (i + 1).cast("string"), F.lit("]")).alias("marker"), n["text"].alias("text")),
    )
    return F.struct(
        F.when(some, T.rewrite_markers(annotated)).otherwise(clean).alias("annotated"),
        F.when(some, numbered).otherwise(F.array().cast("array<struct<note_id:int,original_id:string,marker:string,text:string>>")).alias("notes"),
        F.when(some, F.size(notes)).otherwise(0).alias("count"),
    )


def placement_audit(df: DataFrame, keys: list[str], source: str, annotated: str, base: str, note_ids: str, width: int = 25) -> DataFrame:
    """Per note: letters before its marker on both sides, their difference, context similarity and tier. Notes without both markers are left out."""
    src, ann = F.col("__source"), F.col("__annotated")
    whole = F.greatest(T.letter_count(F.col(source)), F.lit(1)).alias("__whole")
    base_all = F.greatest(F.length(T.strip_ws(F.col(base))), F.lit(1)).alias("__all")
    found = df.select(*keys, F.col(source).alias("__source"), F.col(annotated).alias("__annotated"), whole, base_all, F.col(note_ids).alias("__ids"))
    found = found.withColumn("__s", kernels.cursor_find(src, F.transform("__ids", lambda n: F.concat(F.lit("("), n, F.lit(")")))))
    found = found.withColumn("__a", kernels.cursor_find(ann, F.transform("__ids", lambda n: F.concat(F.lit("["), n, F.lit("]")))))
    # letters are counted once per text, for all of its notes
    counted = found.withColumns({"__ns": kernels.letters_before(src, F.col("__s"), T.MARKER), "__na": kernels.letters_before(ann, F.col("__a"), T.BRACKET_MARKER)})
    zipped = F.arrays_zip(*[F.col(c).alias(n) for c, n in (("__ids", "note_id"), ("__s", "__at"), ("__a", "__to"), ("__ns", "__n_src"), ("__na", "__n_ann"))])
    each = counted.select(*keys, "__source", "__annotated", "__whole", "__all", F.inline(zipped))
    each = each.where("__at > 0 and __to > 0")
    n_src, n_ann = F.col("__n_src"), F.col("__n_ann")
    size = F.length("note_id") + 2
    context = {
        "left_source": F.regexp_replace(T.context(src, F.col("__at"), width), T.MARKER, ""),
        "left_base": F.regexp_replace(T.context(ann, F.col("__to"), width), T.BRACKET_MARKER, ""),
        "right_source": F.regexp_replace(T.context_after(src, F.col("__at"), size, width), T.MARKER, ""),
        "right_base": F.regexp_replace(T.context_after(ann, F.col("__to"), size, width), T.BRACKET_MARKER, ""),
    }
    each = each.select(*keys, "note_id", "__whole", "__all", n_src.alias("source_letters"), n_ann.alias("base_letters"), *[c.alias(n) for n, c in context.items()])
    shares = F.col("source_letters") * 100.0 / F.col("__whole") - F.col("base_letters") * 100.0 / F.col("__all")
    each = each.withColumns({"letter_delta": F.abs(F.col("source_letters") - F.col("base_letters")), "pct_delta": F.abs(shares)})
    a, b = T.norm_token(F.col("left_source"), ""), T.norm_token(F.col("left_base"), "")
    each = each.withColumn("left_ratio", F.when((a == "") & (b == ""), 1.0).otherwise(kernels.similarity(a, b)))
    tier = rules.placement_tier(F.col("letter_delta"), F.col("pct_delta"), F.col("left_ratio"))
    return each.select(*keys, "note_id", "source_letters", "base_letters", "letter_delta", "pct_delta", "left_source", "left_base", "right_source", "right_base", "left_ratio", tier.alias("status"))
