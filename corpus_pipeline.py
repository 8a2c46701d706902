"""From raw documents to packed training sequences: five stages, each a table of its own.

Every stage takes the rows its predecessor kept and returns rows with the columns of
``documents``; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm import mixing, packing, quality, repeats, setsketch
from tidewatch.llm.common import WORD, kept, table

ACCEPTED = 0.3  # least quality score of a document that stays


def prefixed(docs: DataFrame, *needed: str) -> DataFrame:
    """The ``needed`` columns, and all of them again as ``c_...``, so that no name of a stage meets one of theirs."""
    return docs.select(*needed, *[F.col(f"`{c}`").alias(f"c_{c}") for c in docs.columns])


def unprefixed(rows: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of ``docs`` from their ``c_...`` forms, or as given."""
    return rows.select(*[changed.get(c, F.col(f"`c_{c}`")).alias(c) for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Texts that are null or have no words score by the trained bias alone; rows that repeat an
    id are judged by their own texts. Columns keep their names and values.
    """
    weights = quality.fit(docs, table(spark, sf_dir, "labels"), "quality")
    scored = quality.score(prefixed(docs, "text"), weights, [f"c_{c}" for c in docs.columns])
    return unprefixed(scored.where(F.col("score") >= ACCEPTED), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of every group of near-duplicates.

    Documents without words or without id are in no group and stay; of rows that repeat an id
    and a text one stays. Columns keep their names and values.
    """
    chosen = setsketch.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("id")).distinct()
    rows = prefixed(docs, "doc_id").withColumn("digest", F.xxhash64("c_text"))
    stay = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    first = F.row_number().over(W.partitionBy("doc_id", "digest").orderBy(F.lit(0)))
    return unprefixed(stay.withColumn("n", first).where(F.col("doc_id").isNull() | (F.col("n") == 1)), docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings that occur earlier; a character that is cut through goes as a whole.

    A null text becomes an empty one. Documents stay, even with nothing left.
    """
    cut = repeats.remove_repeats(docs, docs.columns)
    text = F.col("kept_text")
    return unprefixed(cut, docs, text=text, n_chars=F.length(text).cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time a document is taken whole, and one with its first words for a part.

    Documents without words are not taken. The words of a part are joined by single spaces.
    """
    mixed = mixing.mix(docs, carry=docs.columns).where("taken > 0")
    part = F.col("taken") % F.col("size")
    times = F.expr("sequence(0L, taken div size - if(taken % size = 0, 1L, 0L))")
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all("c_text", F.lit(WORD), 0), 1, part.cast("int")))
    again = mixed.select("*", F.explode(times).alias("time"))
    text = F.when(F.col("time") == F.expr("taken div size"), cut).otherwise(F.col("c_text"))
    rows = again.withColumn("text", text)
    return unprefixed(rows, docs, text=F.col("text"), n_chars=F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 ids in as few sequences as best fit needs; a null text is empty."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
