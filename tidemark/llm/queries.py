"""Queries over the corpus tables, one for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hmm, quality, toxicity
from .clustering import cluster
from .exact_dedup import exact_duplicates
from .fingerprint import fingerprints
from .lattice import near_vectors
from .licenses import TELLING, TEMPLATES, scan, template_words
from .line_dedup import line_dedup
from .minhash import near_duplicates
from .mixing import mix
from .packing import pack
from .whitening import whiten


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), words_per_shingle=3, percent=85)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select("row.doc_id", "source", "rate", "copies", "copy", "mix_key", F.sha2(F.coalesce("row.text", F.lit("")), 256).alias("text_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def _remainder(by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null ids have none."""
    return F.crc32(F.col("doc_id").cast("string")) % by


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    trees = quality.fit(docs, labels.where(_remainder(5) != 0))
    out = quality.score(docs, trees, keep=["doc_id"]).select("row.doc_id", "score")
    return out.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(_remainder(3) != 1))
    out = toxicity.score(docs, model, keep=["doc_id"]).select("row.doc_id", "score")
    return out.select("doc_id", F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(read(spark, sf_dir, "documents"), _remainder(7) == 2)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(read(spark, sf_dir, "documents")).drop("matches")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings")).select("row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"), keep=["doc_id"]).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash": op1_minhash,
    "op2_lattice": op2_lattice,
    "op3_packing": op3_packing,
    "op4_quality": op4_quality,
    "op5_fingerprint": op5_fingerprint,
    "op6_toxicity": op6_toxicity,
    "op7_hmm": op7_hmm,
    "op8_mixing": op8_mixing,
    "op9_licenses": op9_licenses,
    "op10_line_dedup": op10_line_dedup,
    "op11_whitening": op11_whitening,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_clustering": op13_clustering,
}

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"



def _lloyd_sql(rounds: int = 5) -> str:
    """Each round as two tables: the nearest centroid of every vector, and the centroids after it."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""x{i} AS (
  SELECT vec_id, c.k, list_sum(list_transform(range(1, 65), lambda j: (v.p[j] - c.p[j]) * (v.p[j] - c.p[j])))::BIGINT AS d FROM v, c{i} c
), a{i} AS (SELECT vec_id, arg_min(k, (d, k)) AS k, min(d) AS d FROM x{i} GROUP BY vec_id)""")
        if i < rounds:
            steps.append(f"""s{i} AS (
  SELECT k, j, floor(sum(x)::DOUBLE / count(*))::BIGINT AS m FROM (SELECT k, unnest(range(1, 65)) AS j, unnest(p) AS x FROM a{i} JOIN v USING (vec_id)) GROUP BY k, j
), c{i + 1} AS (SELECT c.k, coalesce(n.p, c.p) AS p FROM c{i} c LEFT JOIN (SELECT k, list(m ORDER BY j) AS p FROM s{i} GROUP BY k) n ON c.k = n.k)""")
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS p FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS (SELECT row_number() OVER (ORDER BY h) - 1 AS k, p FROM (SELECT sha256('2:' || vec_id) AS h, p FROM v ORDER BY h LIMIT 40)),
{", ".join(steps)}
SELECT vec_id, a.k::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY a.k)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c.p, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} c ON a.k = c.k"""


ORACLES: dict[str, str] = {
    "op1_minhash": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_LOW.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END AS sh FROM w
), t AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id
  WHERE 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
), c AS (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m, s.doc_id)) AS component_id,
  least(s.doc_id, coalesce(m, s.doc_id)) = s.doc_id AS kept
FROM s LEFT JOIN c ON s.doc_id = c.doc_id""",
    "op2_lattice": """
WITH RECURSIVE e AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9
), reach(vec_id, other) AS (
  SELECT a, b FROM links UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), c AS (SELECT vec_id, min(other) AS m FROM reach GROUP BY vec_id), n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT x.vec_id, coalesce(n, 0) AS n_links, least(x.vec_id, coalesce(m, x.vec_id)) AS component_id, least(x.vec_id, coalesce(m, x.vec_id)) = x.vec_id AS kept
FROM embeddings x LEFT JOIN c ON x.vec_id = c.vec_id LEFT JOIN n ON x.vec_id = n.vec_id""",
    "op8_mixing": """
WITH RECURSIVE d AS (SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
n AS (SELECT source, count(*) AS n FROM d GROUP BY source),
r AS (SELECT source, 1.0::DOUBLE * (SELECT count(*) FROM d)::DOUBLE / ((SELECT count(*) FROM n)::DOUBLE * n) AS rate FROM n),
parts AS (
  SELECT doc_id, r.source, rate, text, greatest(1, ceil(rate / 16.0::DOUBLE)::INT) AS parts FROM d JOIN r ON d.source = r.source
), u AS (
  SELECT doc_id, source, rate, parts, text, rate / parts AS m, unnest(range(1, parts + 1)) AS j FROM parts
), v AS (
  SELECT *, (CAST('0x' || substr(sha256('mix|' || doc_id || '|' || j), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u FROM u
), p AS (
  SELECT doc_id, source, rate, text, j, m, u, 0 AS i, exp(-m) AS p, exp(-m) AS cdf FROM v
  UNION ALL
  SELECT doc_id, source, rate, text, j, m, u, i + 1, p * m / (i + 1), cdf + p * m / (i + 1) FROM p WHERE u >= cdf AND i < 96
), k AS (
  SELECT doc_id, source, rate, text, sum(k) AS copies FROM (SELECT doc_id, source, rate, text, j, max(i) AS k FROM p GROUP BY ALL) GROUP BY ALL
), c AS (SELECT *, unnest(range(0, copies::BIGINT)) AS copy FROM k)
SELECT doc_id, source, rate, copies::BIGINT AS copies, copy,
  (CAST('0x' || substr(sha256('mix-order|' || doc_id || '|' || copy), 1, 13) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS mix_key,
  sha256(text) AS text_sha256
FROM c""",
    "op9_licenses": f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS k, regexp_extract_all({_LOW.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents
), p AS (
  SELECT *, list_filter(range(1, len(ws) + 1), lambda i: (ws[i] = 'cc' AND ws[i + 1] = 'by') IS TRUE) AS c,
    list_filter(range(1, len(ws) + 1), lambda i: (ws[i] = 'general' AND ws[i + 1] = 'public' AND ws[i + 2] = 'license') IS TRUE) AS g,
    list_filter(range(1, len(ws) + 1), lambda i: (ws[i] = 'all' AND ws[i + 1] = 'rights' AND ws[i + 2] = 'reserved') IS TRUE) AS r FROM d
), t(label, words, telling) AS (VALUES {", ".join(f"('{k}', string_split('{' '.join(ws)}', ' '), {[f' {x} ' for x in TELLING.get(k, [])]}::VARCHAR[])" for k, ws in template_words(TEMPLATES).items())}),
b AS (SELECT k, ws, label, words, telling, unnest(range(0, greatest(len(ws) - 1, 0) // len(words) + 1)) AS i FROM d, t WHERE list_has_any(ws, words)),
c AS (SELECT *, ws[i * len(words) + 1 : (i + 2) * len(words)] AS block FROM b),
s AS (
  SELECT k, label, max(len(list_distinct(list_intersect(words, block)))::DOUBLE / len(list_distinct(words))) AS share FROM c
  WHERE len(list_filter(telling, lambda x: NOT contains(' ' || array_to_string(block, ' ') || ' ', x))) = 0 GROUP BY k, label
),
f AS (SELECT k, list(label) AS labels, max(share) AS share FROM s WHERE share >= 0.8 GROUP BY k)
SELECT doc_id, len(ws) AS n_words, len(c) + len(g) + len(r) AS n_base, list_min(c || g || r) - 1 AS first_word, list_max(c || g || r) - 1 AS last_word,
  concat_ws(',', CASE WHEN len(c) > 0 THEN 'cc-by' END, CASE WHEN len(g) > 0 THEN 'gpl' END, CASE WHEN len(r) > 0 THEN 'reserved' END) AS base_labels,
  array_to_string(list_sort(list_distinct(coalesce(labels, []::VARCHAR[]) || list_filter(['cc-by', 'gpl', 'reserved'],
    lambda x: (x = 'cc-by' AND len(c) > 0) OR (x = 'gpl' AND len(g) > 0) OR (x = 'reserved' AND len(r) > 0)))), ',') AS labels,
  CASE WHEN len(c) + len(g) + len(r) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
FROM p LEFT JOIN f ON p.k = f.k""",
    "op10_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i FROM documents
), k AS (SELECT doc_id, i, line, {_LOW.format(f"trim(line, {_BLANKS})")} AS key FROM l),
o AS (SELECT key, min(doc_id) AS owner FROM k WHERE length(key) >= 10 GROUP BY key),
j AS (SELECT k.doc_id, i, line, owner IS NOT NULL AND owner <> k.doc_id AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op12_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {_LOW.format("coalesce(text, '')")} AS t FROM documents) WINDOW g AS (PARTITION BY t)""",
    "op13_clustering": _lloyd_sql(),
}
