"""The registered queries of the training-data operators, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tellerbook.llm.extraction import extract
from tellerbook.llm.fertility import quality_rules
from tellerbook.llm.licenses import BETWEEN_BLOCKS, TEMPLATES, scan_licenses
from tellerbook.llm.licenses import WORD as LICENSE_WORD
from tellerbook.llm.mixing import mix_plan
from tellerbook.llm.near_dedup import near_duplicates
from tellerbook.llm.packing import pack
from tellerbook.llm.periodic import periodic_runs
from tellerbook.llm.pii import pseudonymise
from tellerbook.llm.quotes import reply_ordered
from tellerbook.llm.token_counts import token_counts
from tellerbook.llm.toxicity import toxicity
from tellerbook.llm.vector_dedup import near_vectors
from tellerbook.llm.whitening import whiten
from tellerbook.llm.words import WORD

#: The key of the registered query; jobs pass their own.
PII_KEY = "registered-query"

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"), similarity=85)


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"))


def op3_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonymise(_table(spark, folder, "documents"), PII_KEY)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    plan = mix_plan(_table(spark, folder, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op6_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(_table(spark, folder, "pages"))


def op7_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return reply_ordered(_table(spark, folder, "conversations"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"))


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(_table(spark, folder, "documents"))


def op10_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(_table(spark, folder, "embeddings"))


def with_periodic_tails(documents: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth id by crc32 has its text's end replaced by a period.

    From word a on, word i becomes word a + (i - a) % p; a and p come from the crc32.
    """
    hashed = documents.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    chosen = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})")))
    rows = hashed.select("doc_id", "text", chosen.alias("w"), F.expr("h div 10").alias("g"))
    rows = rows.select("*", F.size("w").cast("long").alias("n"))
    rows = rows.select("*", F.when(F.col("n") > 0, F.col("g") % F.col("n")).alias("a"))
    rows = rows.select("*", F.expr("1 + (n - a) div (3 + g % 8)").alias("p"))
    period = "slice(w, CAST(a + 1 AS int), CAST(p AS int))"
    again = f"flatten(array_repeat({period}, CAST((n - a) div p + 1 AS int)))"
    changed = F.expr(f"array_join(concat(slice(w, 1, CAST(a AS int)), slice({again}, 1, CAST(n - a AS int))), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_periodic_tails(_table(spark, folder, "documents")))
    lines = F.expr(r"array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licenses(_table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.at").alias("first_word"),
        F.array_max("places.at").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct("places.label")), ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whiten(_table(spark, folder, "embeddings"), components=16)
    rows = found.select("*", F.posexplode("whitened").alias("at", "value"))
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("value").alias("whitened"),
        F.get("explained", "at").alias("explained"),
        "identity_error",
    )


def llm_queries() -> dict[str, Query]:
    found = [
        op1_near_dedup, op2_token_counts, op3_pii, op4_mixing, op5_toxicity, op6_html_extraction, op7_chat_formatting,
        op8_packing, op9_quality_rules, op10_vector_dedup, op11_periodic_runs, op12_license_scans, op13_embedding_whitening,
    ]
    return {f.__name__: f for f in found}


_NEAR_DOCUMENTS = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)),
reached(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a)
SELECT a AS doc_id, coalesce(any_value(n), 0) AS n_shingles, min(b) AS component_id, min(b) = a AS kept
FROM reached LEFT JOIN sizes ON doc_id = a GROUP BY a
"""

_MIX = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(concat_ws(':', '17', coalesce(CAST(doc_id AS VARCHAR), chr(0)))) AS d
  FROM documents),
plain AS (
  SELECT source, sum(size)::BIGINT AS source_size, least(4096, ceil(count(*) / 512))::BIGINT AS shards,
         [3.0, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM sizes GROUP BY source),
levels AS (
  SELECT *, 2.0::DOUBLE * source_size AS most,
    (1.5::DOUBLE * sum(source_size) OVER ()
     - coalesce(sum(2.0::DOUBLE * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM plain WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST)),
targets AS (
  SELECT source, source_size, shards,
    least(most, coalesce(max(CASE WHEN most / weight > level THEN level END) OVER () * weight, most)) AS target
  FROM levels),
seats AS (SELECT round(sum(target) / 64)::BIGINT AS n FROM targets),
quotients AS (
  SELECT source, row_number() OVER (ORDER BY target / (2 * s + 1) DESC, source NULLS LAST, s) AS place
  FROM targets, seats, generate_series(0, seats.n) AS g(s) WHERE target > 0),
quotas AS (SELECT source, count(*) AS quota FROM quotients, seats WHERE place <= n GROUP BY source),
placed AS (
  SELECT z.*, t.source_size, t.target, coalesce(q.quota, 0) AS quota, ('0x' || substr(d, 1, 15))::BIGINT AS h,
         ('0x' || substr(d, 16, 15))::BIGINT % t.shards AS shard
  FROM sizes z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source
  LEFT JOIN quotas q ON z.source IS NOT DISTINCT FROM q.source),
shard_sizes AS (
  SELECT source, shard, any_value(quota) AS quota, sum(size)::BIGINT AS words FROM placed GROUP BY source, shard),
shares AS (
  SELECT source, shard, quota,
    row_number() OVER (PARTITION BY source ORDER BY words::DOUBLE / (2 * s + 1) DESC, shard, s) AS place
  FROM (SELECT *, unnest(generate_series(0, quota)) AS s FROM shard_sizes WHERE words > 0)),
lots AS (SELECT source, shard, count(*) AS lot FROM shares WHERE place <= quota GROUP BY source, shard),
due AS (
  SELECT w.*, least(coalesce(lot, 0) * 64, 2 * words) AS due,
    greatest(1, ceil(words / 64))::BIGINT AS blocks,
    ('0x' || substr(md5(concat_ws(':', '17', coalesce(w.source, chr(0)), w.shard)), 1, 15))::BIGINT
      % greatest(1, ceil(words / 64))::BIGINT AS turn
  FROM shard_sizes w
  LEFT JOIN lots l ON w.source IS NOT DISTINCT FROM l.source AND w.shard = l.shard),
picked AS (
  SELECT *, CASE WHEN words > 0 THEN due // words ELSE 0 END AS passes,
    least(blocks, round(CASE WHEN words > 0 THEN due % words ELSE 0 END / 64))::BIGINT AS picks
  FROM due),
spans AS (
  SELECT p.doc_id, p.size, p.source_size, p.target, k.passes, k.picks, k.blocks, k.turn,
    sum(p.size) OVER (PARTITION BY p.source, p.shard ORDER BY p.h, p.doc_id, p.size ROWS UNBOUNDED PRECEDING)::BIGINT
      AS last
  FROM placed p JOIN picked k ON p.source IS NOT DISTINCT FROM k.source AND p.shard = k.shard),
ends AS (
  SELECT *, last - size AS first, (last // 64 + turn) * picks // blocks AS l0, (last // 64 + 1 + turn) * picks // blocks AS l1,
    ((last - size) // 64 + turn) * picks // blocks AS f0, ((last - size) // 64 + 1 + turn) * picks // blocks AS f1
  FROM spans)
SELECT doc_id, size, source_size, target,
  passes * size + (64 * l0 + last % 64 * (l1 - l0)) - (64 * f0 + first % 64 * (f1 - f0)) AS taken
FROM ends
"""

_NEAR_VECTORS = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM good x JOIN good y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
reached(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT r.a AS vec_id, coalesce(any_value(n), 0) AS n_links, min(r.b) AS component_id, min(r.b) = r.a AS kept
FROM reached r LEFT JOIN counted c ON c.a = r.a GROUP BY r.a
"""


# The crc32 of an id's digits, by its polynomial; runs as stretches of equal windows of
# eight words, each lag by itself.
_PERIODIC = r"""
WITH steps AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
hashed AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    xor(4294967295, list_reduce(list_concat([4294967295],
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda crc, b: xor(crc >> 8, t[xor(crc & 255, b) + 1]))) AS h
  FROM documents, steps),
placed AS (SELECT *, len(w) AS n, h // 10 AS g, (h // 10) % greatest(len(w), 1) AS a FROM hashed),
words AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(n), lambda i:
    w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + g % 8)) END]) ELSE w END AS w
  FROM placed),
grams AS (
  SELECT doc_id, i, array_to_string(w[i + 1:i + 8], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(n - 7)) AS i FROM words WHERE n >= 24)),
matches AS (
  SELECT y.doc_id, y.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.s = y.s AND x.i < y.i),
islands AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM matches),
stretches AS (
  SELECT doc_id, min(i) - q AS start, max(i) + 8 - min(i) + q AS length, q AS period
  FROM islands GROUP BY doc_id, q, island HAVING max(i) + 8 - min(i) + q >= greatest(24, 3 * q)),
runs AS (
  SELECT * FROM stretches s WHERE NOT EXISTS (
    SELECT 1 FROM stretches t WHERE t.doc_id = s.doc_id AND t.period < s.period
      AND t.start <= s.start AND t.start + t.length >= s.start + s.length)),
best AS (
  SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) = 1),
listed AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
spelt AS (SELECT doc_id, unnest(w) AS word, unnest(range(n)) AS i FROM words),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM spelt s WHERE NOT EXISTS (
    SELECT 1 FROM runs r WHERE r.doc_id = s.doc_id AND s.i >= r.start + r.period AND s.i < r.start + r.length)
  GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM documents d LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_NOTICES = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))

# Every block against every template, token by token.
_LICENSES = rf"""
WITH lowered AS (SELECT doc_id, translate(coalesce(text, ''), {_LETTERS}) AS t FROM documents),
words AS (SELECT doc_id, regexp_extract_all(t, '{LICENSE_WORD}') AS w FROM lowered),
places AS (
  SELECT doc_id, i, CASE WHEN w[i + 2] = 'license' AND w[i + 1] IN ('mit', 'apache') THEN w[i + 1]
    WHEN w[i + 1] = 'general' AND w[i + 2] = 'public' AND w[i + 3] = 'license' THEN 'gpl' END AS label
  FROM (SELECT doc_id, w, unnest(range(len(w))) AS i FROM words)),
base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list(DISTINCT label) AS labels
  FROM places WHERE label IS NOT NULL GROUP BY doc_id),
notices(template, label, t) AS (VALUES {_NOTICES}),
parts AS (
  SELECT doc_id, block, regexp_extract_all(part, '{LICENSE_WORD}') AS w
  FROM (SELECT doc_id, unnest(b) AS part, generate_subscripts(b, 1) AS block
        FROM (SELECT doc_id, regexp_split_to_array(t, '{BETWEEN_BLOCKS}') AS b FROM lowered))),
tokens AS (
  SELECT DISTINCT doc_id, block, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, block, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM parts WHERE len(w) > 0)),
asked AS (
  SELECT DISTINCT template, label, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT template, label, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i
        FROM (SELECT template, label, regexp_extract_all(translate(t, {_LETTERS}), '{LICENSE_WORD}') AS w FROM notices))),
sizes AS (SELECT template, count(*) AS size FROM asked GROUP BY template),
met AS (
  SELECT doc_id, label, count(*) / any_value(size) AS containment
  FROM tokens JOIN asked USING (s) JOIN sizes USING (template)
  GROUP BY doc_id, block, template, label HAVING 100 * count(*) >= 80 * any_value(size)),
best AS (SELECT doc_id, max(containment) AS score, list(DISTINCT label) AS labels FROM met GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(best.labels, [])))), ',') AS labels,
  coalesce(score, 0.0::DOUBLE) AS score
FROM words LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)
"""


def llm_oracle_sql() -> dict[str, str]:
    """DuckDB twins where SQL can express the whole query."""
    return {
        "op1_near_dedup": _NEAR_DOCUMENTS,
        "op4_mixing": _MIX,
        "op10_vector_dedup": _NEAR_VECTORS,
        "op11_periodic_runs": _PERIODIC,
        "op12_license_scans": _LICENSES,
    }
