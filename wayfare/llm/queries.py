"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import alignment, bpe, decontaminate, langid, orderhash, quality, rans, simhash, topk, toxicity, variants, wordpiece
from wayfare.llm.registry import ORACLE, QUERIES, query, table
from wayfare.llm.sharding import stratified_shards
from wayfare.session import scratch_path

__all__ = ["ORACLE", "QUERIES"]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "fingerprint", "component_id")


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@query("op3_contaminated", f"""
WITH i AS (
  SELECT min(item_id) AS item_id, ws, least(5, len(ws)) AS n
  FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0 GROUP BY ws),
ig AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[k : k + n - 1], ' ') AS g
  FROM (SELECT item_id, n, ws, unnest(range(1, len(ws) - n + 2)) AS k FROM i)),
w AS (
  SELECT r, doc_id, unnest(ws) AS a, generate_subscripts(ws, 1) AS p
  FROM (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents)),
five AS (
  SELECT r, doc_id, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS d,
         lead(a, 4) OVER o AS e FROM w WINDOW o AS (PARTITION BY r ORDER BY p)),
dg AS (
  SELECT r, doc_id, 5 AS n, a || ' ' || b || ' ' || c || ' ' || d || ' ' || e AS g FROM five WHERE e IS NOT NULL
  UNION SELECT r, doc_id, 4, a || ' ' || b || ' ' || c || ' ' || d FROM five WHERE d IS NOT NULL
  UNION SELECT r, doc_id, 3, a || ' ' || b || ' ' || c FROM five WHERE c IS NOT NULL
  UNION SELECT r, doc_id, 2, a || ' ' || b FROM five WHERE b IS NOT NULL
  UNION SELECT r, doc_id, 1, a FROM five),
t AS (SELECT item_id, count(*) AS n_item FROM ig GROUP BY item_id)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*)::DOUBLE / n_item AS containment
FROM dg JOIN ig USING (n, g) JOIN t USING (item_id)
GROUP BY r, doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item
""")
def op3_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_quality")
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_documents(docs, model, quality.THRESHOLD)


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op7_bpe_round_trip")
def op7_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


@query("op8_pivot_top_k", """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v AS a JOIN v AS b ON a.vec_id % 50 = 0 AND b.r <> a.r AND len(a.q) = len(b.q))
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 5
""")
def op8_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op9_rans_ids")
def op9_rans_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rans")
    rans.write_ids(table(spark, sf_dir, "documents"), path, BYTE_BPE, end_id=0)
    return rans.read_ids(spark, path, crc_only=True)


@query("op10_stratified_shards", python=False)
def op10_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = stratified_shards(table(spark, sf_dir, "documents"), shards=8)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"),
                         F.col("stratum").alias("source"))


@query("op11_spelling_variants", """
WITH RECURSIVE bits AS (
  SELECT i AS n, i AS v, 0 AS k FROM range(256) AS r(i)
  UNION ALL
  SELECT n, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(v ORDER BY n) AS t FROM bits WHERE k = 8),
runs AS (
  SELECT d, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents) WHERE length(run) >= 7),
counted AS (
  SELECT d, run, count(*) AS n, flatten(list_transform(string_split(d || ':' || run, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS bytes
  FROM runs GROUP BY d, run),
hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, bytes), lambda a, b:
    xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) AS h
  FROM counted, crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT n, CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word
        FROM hashed) WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
without AS (
  SELECT word, n, p, word[:p - 1] || word[p + 1:] AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
near AS (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM without AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM without AS a JOIN words AS b ON a.rest = b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM without AS a JOIN without AS b USING (p, rest)
        WHERE a.word <> b.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS other, max(m) AS m
  FROM near GROUP BY word),
formed AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * n THEN other END AS form,
         CASE WHEN m >= 10 * n THEN m END AS form_n
  FROM words LEFT JOIN best USING (word)),
led AS (
  SELECT word, word AS root, 0 AS step FROM formed
  UNION ALL
  SELECT l.word, f.form, step + 1 FROM led AS l JOIN formed AS f ON l.root = f.word WHERE f.form IS NOT NULL)
SELECT word, form, last_root AS root, n, n_near, form_n
FROM formed JOIN (SELECT word, arg_max(root, step) AS last_root FROM led GROUP BY word) USING (word)
""")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf_dir, "documents"))


@query("op12_order_minhash", python=False)
def op12_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderhash.edit_likeness(table(spark, sf_dir, "documents"))


@query("op13_token_alignment")
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)
