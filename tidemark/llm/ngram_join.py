"""Jaccard join on word n-grams: classes of documents linked at 80 % or more.

Words are lower-cased (A-Z); a document's set are its distinct n-word shingles.
Documents with equal sets are one node. The join is exact:

1. Rare first. A count sketch over all shingles of all documents orders shingles by
   rarity (then by hash). Sets that overlap enough share a shingle among their first
   ``n - ceil(0.8 n) + 1``: only these are joined. The sketch's size follows that of a
   partition, so that its exchange stays a fraction of the input; where it is too
   small to tell rare from less rare shingles, only the cost grows.
2. Filters. A shared shingle's positions must lie in both sets' prefixes for this
   pair of lengths (length and prefix filter), must leave room for the required
   overlap (positional filter), and the sets' counts over hash ranges must not
   differ by more than the allowed symmetric difference (suffix filter).
3. Every pair that is left is verified once, on whole sets; later rounds look up
   what earlier ones have verified.

A long posting list is not paired with itself. It is split by lengths, a pivot is
verified against all its members, and as Jaccard distance is a metric, members
within 0.2 of the pivot have no link to those beyond 0.4; the list falls apart
into the near and the far side, and pairs already in one class need no check. So
a group of near copies costs about one verification per member, and still no
link between classes is lost. What is left of a list is paired through the filters
once it has at most ``KNOWN_LIST`` members, or twice as many with each further pivot.

Nulls and edge cases: a text with fewer than n words is one shingle; null and
empty texts have none and are linked with nothing. Rows with equal keys are
separate rows; a null key is a document that only others' keys can name. Sets are
identified by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.llm import kernels as K
from tidemark.llm import scratch
from tidemark.llm.components import components

SHINGLE = 5
LINK, FAR = 80, 60  # per cent; distances 0.2 and 0.4
SKETCH_BITS = (20, 23)  # least and most
RANGES = 256
SHORT_LIST = 16
KNOWN_LIST = 512  # once most classes are known, few pairs of a list are open
PARTS = 64  # of a frequent shingle's postings
_CHUNK = 4096


def _blocks(batches, column: int):
    """Batches cut to a few MB of text; at their end, freed memory goes back."""
    for batch in batches:
        for i, j in K.blocks(batch.column(column), 2 * K.BLOCK_BYTES):
            yield batch.slice(i, j - i)
    K.trim()


def _sets(texts: pa.Array, n: int):
    """The sorted distinct shingles of each text of a block."""
    data, offsets = K.string_buffers(texts)
    starts, ends, first = K.word_bounds(data, offsets)
    hashes = K.word_hashes(data, starts, ends, fold_case=True)
    for a, b in zip(first[:-1], first[1:]):
        yield K.shingles(hashes[a:b], n)


def _node(shingles: np.ndarray) -> int:
    """A hash of a set."""
    mixed = K.mix64(shingles ^ np.uint64(0xA0761D6478BD642F))
    parts = [mixed.sum(dtype=np.uint64), np.bitwise_xor.reduce(K.mix64(mixed)), np.uint64(len(shingles))]
    return int(K.rolling(K.mix64(np.array(parts, dtype=np.uint64)), 3).view(np.int64)[0])


def nodes(docs: DataFrame, key: str, text: str, n: int = SHINGLE) -> DataFrame:
    """``key, node, n``: each row's set as a node (null if empty) and its size."""
    kind = docs.schema[key].dataType.simpleString()

    def described(batches):
        for batch in _blocks(batches, 1):
            found = [(_node(s) if len(s) else None, len(s)) for s in _sets(batch.column(1), n)]
            yield pa.record_batch([batch.column(0), pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.int64())], names=["key", "node", "n"])

    return docs.select(F.col(key).alias("key"), F.col(text).alias("t")).mapInArrow(described, f"key {kind}, node long, n long")


def sketch_bits(docs: DataFrame) -> int:
    """One slot for every 16 bytes of a partition, or of the table if that is smaller."""
    partition = docs.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    table = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return min(max((min(partition, table) // 16).bit_length() - 1, SKETCH_BITS[0]), SKETCH_BITS[1])


def sketch(docs: DataFrame, text: str, n: int = SHINGLE, bits: int | None = None) -> np.ndarray:
    """Counts of all documents' shingles in ``1 << bits`` slots; this bounded size is all that reaches the driver."""
    bits = sketch_bits(docs) if bits is None else bits

    def count(batches):
        slots = np.zeros(1 << bits, dtype=np.int64)
        for batch in _blocks(batches, 0):
            found = list(_sets(batch.column(0), n))
            slots += np.bincount((np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
        if slots.any():
            salt = TaskContext.get().partitionId() % 256
            rows = slots.astype(np.uint32).reshape(-1, min(_CHUNK, 1 << bits))
            yield pa.record_batch([pa.array(range(len(rows)), pa.int32()), pa.array([salt] * len(rows), pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())], names=["chunk", "salt", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), dtype=np.uint32).astype(np.uint64) for x in table["counts"])
        return pa.table({"chunk": table["chunk"][:1], "salt": table["salt"][:1], "counts": pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())})

    schema = "chunk int, salt int, counts binary"
    parts = docs.select(F.col(text).alias("t")).mapInArrow(count, schema)
    salted = parts.groupBy("chunk", "salt").applyInArrow(add, schema)
    whole = salted.groupBy("chunk").applyInArrow(add, schema).collect()
    out = np.zeros(1 << bits, dtype=np.uint32)
    for row in whole:
        values = np.frombuffer(row["counts"], dtype=np.uint32)
        out[row["chunk"] * len(values) : (row["chunk"] + 1) * len(values)] = values
    return out


def postings(docs: DataFrame, text: str, counts: np.ndarray, n: int = SHINGLE) -> DataFrame:
    """``token, node, n, pos, often, cnt``: prefix shingles that at least two nodes share, or that may be frequent.

    ``cnt`` is the number of nodes, for one that may be frequent that of a part of them.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(counts)
    shift = np.uint64(64 - (len(counts).bit_length() - 1))
    many = max(1024, 4 * int(counts.mean()))

    def prefixes(batches):
        rare, seen = shared.value, set()
        for batch in _blocks(batches, 0):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for s in _sets(batch.column(0), n):
                size = len(s)
                if not size or (node := _node(s)) in seen:
                    continue
                seen.add(node)
                often = rare[(s >> shift).astype(np.int64)]
                order = np.argsort(often, kind="stable")[: size - (4 * size + 4) // 5 + 1]
                k = len(order)
                for column, values in zip(out, (s[order].view(np.int64), np.full(k, node), np.full(k, size, np.int32), np.arange(k, dtype=np.int32), often[order] > many)):
                    column.append(values)
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in out], names=["token", "node", "n", "pos", "often"])

    rows = docs.select(F.col(text).alias("t")).mapInArrow(prefixes, "token long, node long, n int, pos int, often boolean")
    # A token that may be frequent is split, so that no task sorts all of its rows.
    rows = rows.withColumn("part", F.when(F.col("often"), F.pmod("node", F.lit(PARTS)).cast("int")).otherwise(0))
    here = Window.partitionBy("token", "part").orderBy("node")
    before = F.lag("node").over(here)
    rows = rows.withColumn("fresh", (before.isNull() | (before != F.col("node"))).cast("int"))
    rows = rows.withColumn("cnt", F.sum("fresh").over(here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return rows.where("fresh = 1 and (cnt > 1 or often)").select("token", "node", "n", "pos", "often", "cnt")


def node_sets(docs: DataFrame, key: str, text: str, keys: DataFrame, n: int = SHINGLE) -> DataFrame:
    """``node, n, ranges, odd, items``: the whole sets of the nodes in ``keys`` (key, node), read from one document each."""

    def described(batches):
        seen = set()
        for batch in _blocks(batches, 0):
            rows = []
            for wanted, s in zip(batch.column(1).to_pylist(), _sets(batch.column(0), n)):
                if len(s) and wanted not in seen and _node(s) == wanted:
                    seen.add(wanted)
                    rows.append((wanted, s))
            ranges = [np.minimum(np.bincount((s >> np.uint64(32)).astype(np.int64) % RANGES, minlength=RANGES), 127).astype(np.int8) for _, s in rows]
            yield pa.record_batch(
                [pa.array([x for x, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int32()), _lists(ranges, np.int8), _lists([np.packbits(r & 1).view(np.int64) for r in ranges], np.int64), _lists([s.view(np.int64) for _, s in rows], np.int64)],
                names=["node", "n", "ranges", "odd", "items"],
            )

    chosen = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    chosen = chosen.join(keys, chosen["k"].eqNullSafe(keys["key"])).select("t", "node")
    sets = scratch.cut(chosen.mapInArrow(described, "node long, n int, ranges array<tinyint>, odd array<long>, items array<long>"), "sets")
    if sets.groupBy("node").count().where("count > 1").isEmpty():
        return sets
    single = scratch.cut(sets.dropDuplicates(["node"]), "sets")  # only where rows with the same key and text repeat
    scratch.drop(sets)
    return single


def _lists(parts: list[np.ndarray], kind) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, np.concatenate(parts) if parts else np.zeros(0, kind))


def _fits(na, nb, percent):
    """Of sets with these sizes, the least overlap of a pair at ``percent`` or more."""
    return F.ceil(percent * (na + nb) / (100 + percent))


def _may_overlap(need) -> object:
    """The suffix filter: counts over hash ranges (saturated, so differences only shrink) bound the symmetric difference."""
    apart = F.aggregate(F.zip_with("ra", "rb", lambda x, y: F.abs(x - y).cast("int")), F.lit(0), lambda s, x: s + x)
    return apart <= F.col("na") + F.col("nb") - 2 * need


def _parities_fit(need) -> object:
    """The same on the parities of the counts alone: ranges of different parity differ by one at least."""
    words = [F.bit_count(F.get("oa", F.lit(i)).bitwiseXOR(F.get("ob", F.lit(i)))) for i in range(RANGES // 64)]
    total = words[0]
    for w in words[1:]:
        total = total + w
    return total <= F.col("na") + F.col("nb") - 2 * need


def _pairs(lists: DataFrame, sets: DataFrame | None = None) -> DataFrame:
    """All pairs of short lists (lid, node, n, pos, low, d) in different classes that pass length, prefix and positional filters, and the triangle inequality on distances ``d`` to one node; with ``sets`` also the suffix filter's first step."""
    signed = sets is not None
    if signed:
        lists = lists.join(sets.select("node", "odd"), "node")
    a = lists.select("lid", F.col("node").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("low").alias("la"), F.col("d").alias("da"), *([F.col("odd").alias("oa")] if signed else []))
    b = lists.select("lid", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("low").alias("lb"), F.col("d").alias("db"), *([F.col("odd").alias("ob")] if signed else []))
    need = _fits(F.col("na"), F.col("nb"), LINK)
    room = F.least("pa", "pb") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    close = (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & (100 * F.least("na", "nb") >= LINK * F.greatest("na", "nb"))
    close = close & (F.col("pa") <= F.col("na") - need) & (F.col("pb") <= F.col("nb") - need) & (room >= need)
    close = close & F.coalesce(F.abs(F.col("da") - F.col("db")) < 1.001 - LINK / 100, F.lit(True))
    if signed:
        close = close & _parities_fit(need)
    return a.join(b, "lid").where(close).select("a", "b", F.lit(LINK).alias("percent"))


def _verify(pairs: DataFrame, sets: DataFrame, label: str, done: DataFrame | None = None) -> DataFrame:
    """``a, b, na, nb, common`` of all pairs that the suffix filter leaves; those in ``done`` are not verified again."""
    pairs = pairs.groupBy("a", "b").agg(F.min("percent").alias("percent"))
    if done is not None:
        pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
    small = sets.select("node", "n", "ranges")
    a = small.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("ranges").alias("ra"))
    b = small.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("ranges").alias("rb"))
    left = pairs.join(a, "a").join(b, "b").where(_may_overlap(_fits(F.col("na"), F.col("nb"), F.col("percent")))).select("a", "b", "na", "nb")
    x = sets.select(F.col("node").alias("a"), F.col("items").alias("xa"))
    y = sets.select(F.col("node").alias("b"), F.col("items").alias("xb"))
    found = left.join(x, "a").join(y, "b").select("a", "b", "na", "nb", F.size(F.array_intersect("xa", "xb")).alias("common"))
    return scratch.cut(found, label)


def _at_least(percent: int):
    return (100 + percent) * F.col("common") >= percent * (F.col("na") + F.col("nb"))


def _by_length(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split long lists by pairs of length classes (and the table of classes that it reads); a member stays only where its position is in the prefix for such partners."""
    grade = F.floor(F.log("n") / F.lit(float(np.log(1.05)))).cast("int")
    other = F.explode(F.sequence(F.col("grade") - 5, F.col("grade") + 5))
    least = F.greatest(F.floor(F.pow(F.lit(1.05), F.col("other"))) - 1, F.lit(1), F.ceil(F.col("n") * LINK / 100))
    split = lists.withColumn("grade", grade).withColumn("other", other)
    split = split.where(F.col("pos") <= F.col("n") - _fits(F.col("n"), least, LINK))
    split = split.withColumns({"g0": F.least("grade", "other"), "g1": F.greatest("grade", "other")})
    both = split.groupBy("token", "g0", "g1").agg(F.min("grade").alias("m0"), F.max("grade").alias("m1"), F.count(F.lit(1)).alias("size"))
    both = scratch.cut(both.where("m0 = g0 and m1 = g1 and size > 1").select("token", "g0", "g1"), "grades")  # a pair of classes needs members of both
    return split.join(both, ["token", "g0", "g1"]).select(F.xxhash64("token", "g0", "g1").alias("lid"), "node", "n", "pos"), both


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE) -> DataFrame:
    """``key, n_shingles, component_id``: the smallest key that each document reaches by links."""
    return classes(docs, key, text, n).select(F.col(key), "n_shingles", "component_id")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE) -> DataFrame:
    """As :func:`link`, with ``node`` (a hash of the document's set) and ``class_id`` (the least node of its class); both null without words."""
    with scratch.lean(docs.sparkSession):
        return _link(docs, key, text, n)


def _link(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    rows = scratch.cut(nodes(docs, key, text, n), "nodes")
    lists = scratch.cut(postings(docs, text, sketch(docs, text, n), n), "postings")
    wanted = lists.select("node").distinct()
    keys = rows.where("node is not null").join(wanted, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
    sets = node_sets(docs, key, text, keys, n)

    # a frequent token's parts are added up; the counts are read plainly, so that its rows can be split
    often = scratch.cut(lists.where("often").groupBy("token").agg(F.count(F.lit(1)).alias("cnt")), "often")
    columns = ["token", "node", "n", "pos", "cnt"]
    sized = lists.where("not often").select(*columns).unionByName(lists.where("often").drop("cnt").join(often, "token").select(*columns))
    short = sized.where(F.col("cnt") <= SHORT_LIST).select(F.col("token").alias("lid"), "node", "n", "pos", F.col("node").alias("low"), F.lit(None).cast("double").alias("d"))
    long_ = sized.where(F.col("cnt") > SHORT_LIST)
    weight = long_.groupBy("node").agg(F.sum("cnt").alias("w"))  # of near copies, the one most like all others has most
    graded, grades = _by_length(long_)
    open_ = scratch.cut(graded.join(weight, "node").withColumns({"first": F.lit(1), "d": F.lit(None).cast("double")}), "lists")
    scratch.drop(grades)
    reached = done = None  # (node, low) and verified pairs so far
    garbage = [lists, often, open_]
    pending, limit, round_no = _pairs(short), SHORT_LIST, 0
    while True:
        if reached is not None:
            known = open_.join(reached, "node", "left").withColumn("low", F.coalesce("low", "node"))
        else:
            known = open_.withColumn("low", F.col("node"))
        stats = known.groupBy("lid").agg(F.count(F.lit(1)).alias("cnt"), F.min("low").alias("l0"), F.max("low").alias("l1"), F.max_by("node", F.struct("first", "w", "node")).alias("pivot"))
        stats = scratch.cut(stats.where("l0 != l1").select("lid", "cnt", "pivot"), "stats")  # read plainly, so that a long list's rows can be split
        known = known.join(stats, "lid")
        brief = known.where(F.col("cnt") <= limit)
        wide = known.where(F.col("cnt") > limit).where("node != pivot")
        wide = scratch.cut(wide.select("lid", "node", "n", "pos", "w", F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")), "wide")
        candidates = pending.unionByName(_pairs(brief.select("lid", "node", "n", "pos", "low", "d"), sets)).unionByName(wide.select("a", "b", F.lit(FAR).alias("percent")))
        found = _verify(candidates, sets, f"verified-{round_no}", done)
        linked = found.where(_at_least(LINK)).select("a", "b")
        if reached is None:
            reached = components(linked)
        elif not linked.isEmpty():
            garbage.append(reached)
            reached = components(reached.select(F.col("node").alias("a"), F.col("low").alias("b")).unionByName(linked))
        done = found if done is None else done.unionByName(found)
        garbage += [wide, found, stats]
        if wide.isEmpty():
            break
        # the pivot leaves; near (class 0 and 1) and far (1 and 2) members go on apart
        side = F.when(_at_least(LINK), 0).when(_at_least(FAR), 1).otherwise(2)
        distance = 1 - F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))
        sides = wide.join(done, ["a", "b"], "left").select("lid", "node", "n", "pos", "w", distance.alias("d"), F.when(F.col("common").isNull(), 2).otherwise(side).alias("side"))
        mixed = sides.where("side = 1").select("lid").distinct()
        near = sides.where("side < 2").join(mixed, "lid", "left_semi").select(F.xxhash64("lid", F.lit("near")).alias("lid"), "node", "n", "pos", "w", F.col("side").alias("first"), "d")
        far = sides.where("side > 0").select(F.xxhash64("lid", F.lit("far")).alias("lid"), "node", "n", "pos", "w", F.lit(1).alias("first"), "d")
        open_ = scratch.cut(near.unionByName(far), "lists")
        garbage.append(open_)
        pending, limit = candidates.limit(0), max(KNOWN_LIST, 2 * limit)
        round_no += 1
    for table in [*garbage, sets]:
        scratch.drop(table)

    class_key = rows.where("node is not null").groupBy("node").agg(F.min("key").alias("least")).join(reached, "node", "left").withColumn("low", F.coalesce("low", "node"))
    lowest = class_key.groupBy("low").agg(F.min("least").alias("component_id"))
    named = class_key.join(lowest, "low").select("node", "component_id", F.col("low").alias("class_id"))
    return rows.join(named, "node", "left").select(F.col("key").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("class_id").isNull(), F.col("key")).otherwise(F.col("component_id")).alias("component_id"), "node", "class_id")


def node_of(text: Column, n: int = SHINGLE) -> Column:
    """The node of each text, as :func:`classes` names it; null for an empty set."""

    @F.arrow_udf("long")
    def described(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [_node(s) if len(s) else None for i, j in K.blocks(texts, 2 * K.BLOCK_BYTES) for s in _sets(texts.slice(i, j - i), n)]
            yield pa.array(found, pa.int64())
        K.trim()

    return described(text)


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = SHINGLE) -> DataFrame:
    """One row of each class of linked documents, and every row without words; all columns are kept.

    The row with the smallest key stays (null keys last); of rows of one class that
    share this key, the first in the order of their columns. Rows of different
    classes that share a key are different documents and all stay.
    """
    found = scratch.cut(classes(docs, key, text, n), "links")
    stays = found.where(F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(key).alias("__key"), F.col("node").alias("__node"), F.col("class_id").alias("__class"))
    rows = found.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("rows"))
    some = stays.select("__key").distinct().withColumnRenamed("__key", "kept")
    counts = scratch.cut(rows.join(some, F.col("__key").eqNullSafe(F.col("kept")), "left_semi"), "keys")
    plain = F.col("__key").isNotNull() & (F.col("rows") == 1)  # all rows of this key are one document that stays
    alone = docs.join(counts.where(plain).select("__key"), F.col(f"`{key}`") == F.col("__key"), "left_semi")
    if counts.where(~plain).isEmpty():
        return alone
    names = [F.col(f"`{c}`") for c in docs.columns]
    shared = docs.select(F.struct(*names).alias("row"), F.col(f"`{key}`").alias("own"), F.col(f"`{text}`").alias("t"))
    shared = shared.join(counts.where(~plain).select("__key"), F.col("own").eqNullSafe(F.col("__key")), "left_semi").select("row", "own", node_of(F.col("t"), n).alias("node"))
    shared = shared.join(stays.distinct(), F.col("own").eqNullSafe(F.col("__key")) & F.col("node").eqNullSafe(F.col("__node"))).select("row", "__class")
    firsts = shared.where("__class is not null").groupBy("__class").agg(F.min("row").alias("row")).select("row.*")
    return alone.unionByName(firsts).unionByName(shared.where("__class is null").select("row.*"))
