"""One registered query per operator, over whole tables, and the SQL that some of them equal."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from tidewatch.llm import (
    cells, fingerprints, kdtree, lexical, mixing, negatives, packbits, packing, quality, repeats, setsketch, toxicity, warc,
)
from tidewatch.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def keep(function: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return keep


@query("op1_bit_packed_ids")
def bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    files, uri = packbits.write_ids(table(spark, sf_dir, "documents"), path, drops_space=True, end_id=1)
    return packbits.read_ids(files, uri)


@query("op8_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), path)


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(coalesce(length(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size, length(text) AS chars,
    CAST(('0x' || substr(md5('mix' || coalesce('|' || CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT AS DOUBLE)
      / CAST(4503599627370496 AS DOUBLE) AS u
  FROM documents),
keyed AS (
  SELECT *, -ln(1 - u) / (CASE WHEN size > 0 AND CAST(chars AS DOUBLE) / size BETWEEN 3 AND 12 THEN 1.0::DOUBLE ELSE 0.25::DOUBLE END) AS k
  FROM sized),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS n, 3 * CAST(sum(size) AS BIGINT) AS cap,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM keyed GROUP BY source),
p AS (
  SELECT *, row_number() OVER c AS k,
    sum(n) OVER () - coalesce(sum(cap) OVER (c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER (c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ws
  FROM s WINDOW c AS (ORDER BY cap * 6 // w, source NULLS LAST)),
f AS (SELECT k AS k0, rest AS r0, ws AS ws0 FROM p WHERE rest * w <= cap * ws ORDER BY k LIMIT 1),
t AS (
  SELECT source AS src, n, CASE WHEN k0 IS NULL OR k < k0 THEN CAST(cap AS DOUBLE)
    ELSE CAST(r0 * w AS DOUBLE) / CAST(ws0 AS DOUBLE) END AS target
  FROM p LEFT JOIN f ON true),
r AS (
  SELECT doc_id, size, n AS source_size, target, source,
    CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS epochs,
    coalesce(sum(size) OVER (PARTITION BY source ORDER BY keyed.k, doc_id, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed JOIN t ON source IS NOT DISTINCT FROM src)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, floor(target - epochs * source_size) - before)) AS BIGINT) AS taken
FROM r"""


@query("op10_source_mixing", MIX_SQL)
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


@query("op3_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights = quality.fit(docs, table(spark, sf_dir, "labels"), "quality")
    return quality.score(docs, weights).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op5_toxicity_lexicon")
def toxicity_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op7_warc_index_merge")
def warc_index_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_history(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "key", "time", "file", "offset", "length"
    )


TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5"""


@query("op4_exact_top_k", TOP_SQL)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op2_embedding_near_dedup")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op9_setsketch_near_dedup")
def setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), size=4)


@query("op6_run_index_dedup")
def run_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept_text")


NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum(list_transform(list_zip(a.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10"""


@query("op11_hard_negatives", NEGATIVES_SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), shifted, F.col("vec_id") % 100 == 0)


LEXICAL_SQL = r"""
WITH w AS (
  SELECT row_number() OVER () AS d, doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
n AS (SELECT d, any_value(doc_id) AS doc_id, count(*) AS n FROM w GROUP BY d),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
tf AS (SELECT d, term, count(*) AS tf FROM w GROUP BY d, term),
rare AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), c),
i AS (
  SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT i, any_value(item_id) AS item_id, term, count(*) AS k FROM i GROUP BY i, term),
s AS (
  SELECT q.i, any_value(q.item_id) AS item_id, tf.d, any_value(n.doc_id) AS doc_id,
    CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) AS BIGINT) AS score
  FROM q JOIN rare USING (term) JOIN tf USING (term) JOIN n ON n.d = tf.d, c GROUP BY q.i, tf.d)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
WHERE rank <= 20"""


@query("op12_lexical_search", LEXICAL_SQL)
def lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


EXACT_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)"""


@query("op13_exact_dedup", EXACT_SQL)
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.exact_duplicates(table(spark, sf_dir, "documents")).drop("n_bytes", "print")
