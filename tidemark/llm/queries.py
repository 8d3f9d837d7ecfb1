"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import html_extract, interval_join, lexical_search, license_scan, media, mixing, ngram_join, packing, quality_model, repetition, simhash_trees, token_files, tokens, url_rules

URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes")
    stored = docs.select("doc_id", n_bytes, media.text_to_media(F.col("text")).alias("media"))
    return stored.select("doc_id", "n_bytes", media.media_features(F.col("media")).alias("f")).select("doc_id", "n_bytes", "f.*")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", html_extract.extract(F.col("html")).alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = _table(spark, sf_dir, "labels").where(~held_out)
    weights = quality_model.fit(docs, labels)
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), quality_model.score(spark, F.col("text"), weights).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_repetition_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.judge(_table(spark, sf_dir, "documents"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokens.default_file(), 4096)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), F.array("source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(_table(spark, sf_dir, "documents"), token_files.new_folder(spark), tokens.default_file())
    return token_files.documents(files)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 50)


def op12_point_in_time_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars", "lang")
    digits = F.sha2(F.col("doc_id").cast("string"), 256)
    a, b, c, d = (F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4))
    event = a % 200_000
    versions = docs.select("source", event.alias("event"), (event - 60 + b % 1200).alias("arrival"), (event + c % 900).alias("expiry"), F.col("doc_id").alias("version_id"), "n_chars", "lang")
    versions = versions.withColumn("start", F.greatest("event", "arrival")).where("version_id is not null")
    owners = docs.groupBy("doc_id").agg(F.min("source").alias("source"))  # of a repeated id, the least source
    asked = _table(spark, sf_dir, "labels").select("doc_id", (d % 200_000).alias("t")).join(owners, "doc_id", "left")
    found = interval_join.latest_valid(asked, versions, "source", "t", "start", "expiry", ["event", "arrival", "version_id"], ["n_chars", "lang"])
    age = F.col("t") - F.col("winner.event")
    status = F.when(age.isNull(), "none").when(age > 20, "stale").otherwise("fresh")
    fresh = status == "fresh"
    return found.select("doc_id", "t", F.col("winner.version_id").alias("version_id"), age.alias("age"), status.alias("status"), F.when(fresh, F.col("winner.n_chars")).alias("n_chars"), F.when(fresh, F.col("winner.lang")).alias("lang"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_trees.link(_table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS spot
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source
), w AS (
  SELECT *, CASE i % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2.0::DOUBLE * source_size AS cap FROM s
), o AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, i) AS k,
         1.5::DOUBLE * sum(source_size) OVER () - (sum(cap) OVER (ORDER BY cap / weight, i) - cap) AS left_over,
         sum(weight) OVER () - (sum(weight) OVER (ORDER BY cap / weight, i) - weight) AS weight_left
  FROM w
), f AS (
  SELECT *, min(CASE WHEN left_over * weight <= cap * weight_left THEN k END) OVER () AS stop FROM o
), t AS (
  SELECT f.source, f.source_size, CASE WHEN f.stop IS NULL OR f.k < f.stop THEN f.cap ELSE g.left_over * f.weight / g.weight_left END AS target
  FROM f LEFT JOIN f g ON g.k = g.stop
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) // source_size ELSE 0 END AS whole,
         CASE WHEN source_size > 0 THEN CAST(floor(target + 0.5) AS BIGINT) % source_size ELSE 0 END AS rest
  FROM t
), r AS (
  SELECT d.*, q.source_size, q.target, q.whole, q.rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY spot, doc_id, size ROWS UNBOUNDED PRECEDING) AS running
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
)
SELECT doc_id, size, source_size, target,
       CAST(size * (whole + CASE WHEN 2 * running - size <= 2 * rest THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r
"""

OP8_SQL = """
WITH rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM cut
), p AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM parts
), fits AS (
  SELECT p.page_id, p.host, p.path, r.verdict, r.host || r.path AS rule
  FROM p LEFT JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule,
       coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict
FROM fits GROUP BY page_id, host, path
"""

OP3_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT rid, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d
), n AS (
  SELECT rid, count(*) AS n FROM s GROUP BY rid
), p AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS common FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY a.rid, b.rid
), l AS (
  SELECT a, b FROM p JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * common >= 80 * (x.n + y.n - common)
), e AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), r AS (
  SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, (SELECT min(o.doc_id) FROM r JOIN d o ON o.rid = r.b WHERE r.a = d.rid) AS component_id
FROM d LEFT JOIN n USING (rid)
"""

_LIMITS = repetition.Limits()
_TOPS, _DUPS = dict(_LIMITS.top_ngram), dict(_LIMITS.dup_ngram)
OP5_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), v AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d
), b AS (
  SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM v
), l AS (
  SELECT rid, line, count(*) AS k FROM (SELECT rid, unnest(lines) AS line FROM b) GROUP BY rid, line
), m AS (
  SELECT rid, sum(k) AS n_lines, sum(k - 1) AS dups, sum(k * length(line)) AS chars, sum((k - 1) * length(line)) AS dup_chars FROM l GROUP BY rid
), k AS (
  SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS i FROM v
), q AS (
  SELECT rid, i, word, {", ".join(f"lead(word, {n - 1}) OVER (PARTITION BY rid ORDER BY i) AS w{n}" for n in range(2, 11))} FROM k
), g AS (
  {" UNION ALL ".join(f"SELECT rid, {n} AS n, i, concat_ws(' ', word, {', '.join(f'w{m}' for m in range(2, n + 1))}) AS gram FROM q WHERE w{n} IS NOT NULL" for n in range(2, 11))}
), o AS (
  SELECT rid, n, gram, count(*) * length(replace(gram, ' ', '')) AS chars, list(i) AS places FROM g GROUP BY rid, n, gram HAVING count(*) > 1
), top AS (
  SELECT rid, {", ".join(f"max(CASE WHEN n = {n} THEN chars END) AS t{n}" for n in _TOPS)} FROM o GROUP BY rid
), c AS (
  SELECT DISTINCT rid, n, i + step AS i FROM (SELECT rid, n, unnest(places) AS i FROM o WHERE n = 3 OR n >= 5), range(10) t(step) WHERE step < n
), x AS (
  SELECT c.rid, count(CASE WHEN n = 3 THEN 1 END) AS inside, {", ".join(f"sum(CASE WHEN n = {n} THEN length(word) END) AS d{n}" for n in _DUPS)} FROM c JOIN k USING (rid, i) GROUP BY c.rid
), y AS (
  SELECT b.rid, doc_id, n_words, word_chars, n_symbols, CAST(coalesce(dups, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(inside, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(dups, 0) AS DOUBLE) / greatest(coalesce(n_lines, 0), 1) AS dup_line_share, CAST(coalesce(dup_chars, 0) AS DOUBLE) / greatest(coalesce(chars, 0), 1) AS dup_line_chars,
         {", ".join(f"least(CAST(coalesce(t{n}, 0) AS DOUBLE) / greatest(word_chars, 1), 1.0) AS top_{n}" for n in _TOPS)},
         {", ".join(f"CAST(coalesce(d{n}, 0) AS DOUBLE) / greatest(word_chars, 1) AS dup_{n}" for n in _DUPS)},
         CAST(n_symbols AS DOUBLE) / greatest(word_chars, 1) AS symbol_share,
         n_words < {_LIMITS.min_words} OR 100 * coalesce(inside, 0) > {_LIMITS.repeat_words_percent} * n_words AS base_failed
  FROM b LEFT JOIN m USING (rid) LEFT JOIN top USING (rid) LEFT JOIN x USING (rid)
)
SELECT * EXCLUDE (rid), NOT (base_failed OR dup_line_share > {_LIMITS.dup_lines} OR dup_line_chars > {_LIMITS.dup_line_chars} OR symbol_share > {_LIMITS.symbols}
  OR {" OR ".join(f"top_{n} > {limit}" for n, limit in _TOPS.items())} OR {" OR ".join(f"dup_{n} > {limit}" for n, limit in _DUPS.items())}) AS kept
FROM y
"""

_TEMPLATES = ",\n    ".join("({}, '{}', {}, {}, '{}', [{}])".format(i, t.label, (n := len(t.words.split())), license_scan.stretch(n), t.words, ", ".join(f"'{k}'" for k in t.keys)) for i, t in enumerate(license_scan.TEMPLATES))
OP10_SQL = f"""
WITH base(phrase, label) AS (
  VALUES {", ".join(f"('{p}', '{label}')" for p, label in license_scan.BASE)}
), templates(t, label, n, more, words, keys) AS (
  VALUES {_TEMPLATES}
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), tokens AS (
  SELECT rid, unnest(w) AS word, unnest(range(len(w))) AS i FROM d
), b AS (
  SELECT k.rid, k.i, base.label FROM tokens k JOIN d USING (rid) JOIN base ON k.word = string_split(base.phrase, ' ')[1] AND d.w[k.i + 1:k.i + len(string_split(base.phrase, ' '))] = string_split(base.phrase, ' ')
), bs AS (
  SELECT rid, CAST(count(*) AS BIGINT) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM b GROUP BY rid
), own AS (
  SELECT t, unnest(string_split(words, ' ')) AS word, unnest(range(n)) AS p FROM templates
), places AS (
  SELECT k.rid, own.t, k.i - own.p AS off, count(*) AS same FROM own JOIN tokens k USING (word) GROUP BY k.rid, own.t, off
), spans AS (
  SELECT p.rid, t.label, t.keys, CAST(same AS DOUBLE) / n AS share, ' ' || array_to_string(d.w[greatest(off - more, 0) + 1:off + n + more], ' ') || ' ' AS span
  FROM places p JOIN templates t USING (t) JOIN d USING (rid) WHERE 2 * same >= n
), ts AS (
  SELECT rid, list(DISTINCT label) AS labels, max(share) AS best FROM spans WHERE len(list_filter(keys, lambda k: NOT contains(span, ' ' || k || ' '))) = 0 GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(array_to_string(bs.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(bs.labels, []), coalesce(ts.labels, [])))), ','), '') AS labels,
       greatest(coalesce(best, 0.0::DOUBLE), CASE WHEN n_base > 0 THEN {license_scan.NAMED}::DOUBLE ELSE 0.0::DOUBLE END) AS score
FROM d LEFT JOIN bs USING (rid) LEFT JOIN ts USING (rid)
"""

OP11_SQL = """
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents
), s AS (
  SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS nt FROM d WHERE len(w) > 0
), q AS (
  SELECT row_number() OVER () AS qid, item_id, list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS terms FROM benchmark
), qt AS (
  SELECT qid, item_id, unnest(terms) AS term FROM q
), tf AS (
  SELECT rid, term, count(*) AS tf FROM (SELECT rid, unnest(w) AS term FROM d) GROUP BY rid, term
), wt AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(nd) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM tf, s WHERE term IN (SELECT term FROM qt) GROUP BY term
), m AS (
  SELECT rid, doc_id, 100 - 50 + (50 * len(w) * nd) // nt AS m FROM d, s WHERE len(w) > 0
), sc AS (
  SELECT qid, item_id, m.rid, m.doc_id, CAST(sum(wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 20 * m.m))) AS BIGINT) AS score
  FROM qt JOIN tf USING (term) JOIN wt USING (term) JOIN m USING (rid) GROUP BY ALL
), r AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM sc WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 50
"""

OP12_SQL = """
WITH h AS (
  SELECT doc_id, source, n_chars, lang, sha256(CAST(doc_id AS VARCHAR)) AS x FROM documents WHERE doc_id IS NOT NULL
), g AS (
  SELECT *, CAST('0x' || x[1:8] AS BIGINT) % 200000 AS event, CAST('0x' || x[9:16] AS BIGINT) AS b, CAST('0x' || x[17:24] AS BIGINT) AS c FROM h
), v AS (
  SELECT doc_id AS version_id, source, n_chars, lang, event, event - 60 + b % 1200 AS arrival, event + c % 900 AS expiry FROM g
), q AS (
  SELECT row_number() OVER () AS qid, l.doc_id, CAST('0x' || sha256(CAST(l.doc_id AS VARCHAR))[25:32] AS BIGINT) % 200000 AS t, o.source
  FROM labels l LEFT JOIN (SELECT doc_id, min(source) AS source FROM documents GROUP BY doc_id) o USING (doc_id)
), j AS (
  SELECT q.qid, q.doc_id, q.t, v.version_id, q.t - v.event AS age, v.n_chars, v.lang,
         row_number() OVER (PARTITION BY q.qid ORDER BY v.event DESC NULLS LAST, v.arrival DESC, v.version_id DESC, v.n_chars DESC NULLS LAST, v.lang DESC NULLS LAST) AS k
  FROM q LEFT JOIN v ON v.source = q.source AND v.event <= q.t AND v.arrival <= q.t AND q.t < v.expiry
)
SELECT doc_id, t, version_id, age, CASE WHEN version_id IS NULL THEN 'none' WHEN age > 20 THEN 'stale' ELSE 'fresh' END AS status,
       CASE WHEN age <= 20 THEN n_chars END AS n_chars, CASE WHEN age <= 20 THEN lang END AS lang
FROM j WHERE k = 1
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_media_columns": op1_media_columns,
    "op2_html_extraction": op2_html_extraction,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_repetition_coverage": op5_repetition_coverage,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_source_mixing": op7_source_mixing,
    "op8_url_filters": op8_url_filters,
    "op9_token_files": op9_token_files,
    "op10_license_scan": op10_license_scan,
    "op11_lexical_search": op11_lexical_search,
    "op12_point_in_time_join": op12_point_in_time_join,
    "op13_simhash_near_dedup": op13_simhash_near_dedup,
}

ORACLES: dict[str, str] = {
    "op3_ngram_jaccard_join": OP3_SQL,
    "op5_repetition_coverage": OP5_SQL,
    "op7_source_mixing": OP7_SQL,
    "op8_url_filters": OP8_SQL,
    "op10_license_scan": OP10_SQL,
    "op11_lexical_search": OP11_SQL,
    "op12_point_in_time_join": OP12_SQL,
}
