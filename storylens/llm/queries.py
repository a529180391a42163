"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storylens.llm import bitsliced, bpe, extraction, jaccard, langid, mixing, multiindex, packing, resampling, sharding, simhash, toxicity, winnowing
from storylens.llm.common import documents, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(documents(table(spark, sf_dir, "documents"))).select(
        "doc_id", F.expr("length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")
    return bpe.decode(ids).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(table(spark, sf_dir, "documents"))
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, fitted).select(
        "doc_id", F.coalesce(~toxicity.training_rows(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(documents(docs), langid.learn(docs)).select(
        "doc_id", F.coalesce(~langid.training_rows(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "lang_pred", "score")


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = sharding.write(table(spark, sf_dir, "documents"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return shards.select(
        "doc_id", sharding.size(F.col("text")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"), "shard", "slot", sharding.grown_shard(F.col("doc_id"), F.col("shard")).alias("grown_shard"))


@query
def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.against_next(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        F.sha2(F.concat("marks", "positions"), 256).alias("fingerprint"),
        F.sha2(F.concat("edited_marks", "edited_positions"), 256).alias("edited_fingerprint"),
        "near_edited", "near_next")


@query
def op9_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = bitsliced.quantised(table(spark, sf_dir, "embeddings"))
    return bitsliced.search(vectors.where("vec_id % 100 = 0"), bitsliced.index(vectors))


ORACLE["op9_bitsliced_topk"] = """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.parts, c.parts) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extraction.extract(pages, extraction.fit(pages)).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = multiindex.quantised(table(spark, sf_dir, "embeddings"), label)
    books, n = multiindex.fit(vectors)
    return multiindex.mine(vectors.where("vec_id % 100 = 0"), multiindex.index(vectors, books, n), books)


ORACLE["op11_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS parts
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_inner_product(a.parts, c.parts) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
  FROM positives JOIN scored s USING (anchor_id)
  WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""


@query
def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


ORACLE["op12_jaccard_join"] = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, row_number() OVER () AS row, [w FOR w IN regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF w <> ''] AS w
  FROM documents),
shingled AS (
  SELECT doc_id, row, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
  FROM worded),
sets AS (SELECT list_sort(s) AS s, min(row) AS node, len(s) AS n FROM shingled WHERE len(s) > 0 GROUP BY ALL),
postings AS (SELECT node, n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.node AS a, b.node AS b
  FROM postings a JOIN postings b ON a.shingle = b.shingle AND a.node < b.node AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT node, node AS other FROM sets UNION SELECT r.node, l.b FROM reached r JOIN both_ways l ON l.a = r.other),
ids AS (SELECT node, min(doc_id) AS least FROM shingled JOIN sets ON list_sort(shingled.s) = sets.s GROUP BY node),
components AS (SELECT r.node, min(least) AS component_id FROM reached r JOIN ids ON ids.node = r.other GROUP BY r.node)
SELECT doc_id, CAST(len(shingled.s) AS BIGINT) AS n_shingles, CASE WHEN len(shingled.s) = 0 THEN doc_id ELSE component_id END AS component_id
FROM shingled LEFT JOIN sets ON list_sort(shingled.s) = sets.s LEFT JOIN components USING (node)
"""


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


ORACLE["op13_resampling"] = r"""
WITH RECURSIVE steps AS (
  SELECT i AS b, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(CAST(3988292384 AS BIGINT), c >> 1) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
texts AS (
  SELECT 0 AS side, doc_id, row_number() OVER () AS row, text FROM documents
  UNION ALL SELECT 1, NULL, row_number() OVER (), text FROM benchmark),
worded AS (
  SELECT side, doc_id, row, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM texts),
features AS (
  SELECT side, row, unnest(list_concat(w, [w[i] || ' ' || w[i + 1] FOR i IN range(1, greatest(len(w), 1))])) AS f FROM worded),
counted AS (SELECT side, row, f, count(*) AS n FROM features GROUP BY ALL),
buckets AS (
  SELECT f, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST('0x' || substr(hex(f), 2 * i + 1, 2) AS BIGINT) FOR i IN range(strlen(f))]),
                            lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM counted), crc),
placed AS (SELECT side, row, bucket, sum(n) AS n FROM counted JOIN buckets USING (f) GROUP BY ALL),
sums AS (
  SELECT i AS bucket, coalesce(sum(n) FILTER (WHERE side = 0), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 1), 0) AS t
  FROM range(10000) r(i) LEFT JOIN placed ON bucket = i GROUP BY i),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(sum(s) OVER () AS DOUBLE) + 10000)
         / ((CAST(s AS DOUBLE) + 1) * (CAST(sum(t) OVER () AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM sums),
weighed AS (
  SELECT w.doc_id, w.row, len(w.w) AS words, coalesce(sum(n), 0) AS n_features,
         CASE WHEN sum(n) > 0 THEN floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) ELSE 0 END AS weight
  FROM worded w LEFT JOIN placed p ON p.side = 0 AND p.row = w.row LEFT JOIN gains g USING (bucket)
  WHERE w.side = 0 GROUP BY w.doc_id, w.row, w.w),
scored AS (
  SELECT doc_id, row, words, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight,
         CAST(weight + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM weighed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place,
                  count(*) OVER (PARTITION BY words >= 20) AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN words >= 20 AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
"""


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe.encode(documents(table(spark, sf_dir, "documents")), together=1 << 23).select("doc_id", "ids")
    return packing.packed(ids).select(
        "row", "n_tokens", "doc_ids", "parts", "cu_seqlens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("positions", 256).alias("positions_sha256"))
