"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws an exponential key with its weight as the rate, and smaller keys come
first: the order of weighted sampling without replacement. A source first takes as many
complete epochs as fit its target; then documents are taken in key order until the rest of
the target is spent, and the document in which it is spent gives only the words still
missing. Targets follow source weights and stop at ``max_epochs`` times the source's size;
what is cut off is shared out again by weight until no target is above.

Null texts have no words, a null source is a source of its own, repeated ids are separate
documents, and an empty table gives no rows. Keys are digests of ids, so reruns agree. All
steps are column expressions and windows: a source is cut into slices of its key range that
are sorted apart, and only the totals of slices are summed in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.columns import uniform
from tidewatch.llm.common import WORD, kept

MAX_EPOCHS = 3


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def lexical_weight() -> Column:
    """Quality weight from the mean word length: 1 for usual words, 0.25 for odd ones."""
    mean = F.try_divide(F.length("text"), F.col("size"))
    return F.when(mean.between(3, 12), F.lit(1.0)).otherwise(F.lit(0.25))


def source_targets(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source.

    The k sources that are capped are those with the least cap for their weight. With them
    at their caps the rest is shared by weight; the smallest k at which the next source stays
    below its cap is the result of sharing again and again.
    """
    ordered = sources.select(
        "source",
        "source_size",
        ((F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1).cast("long").alias("w"),
        F.sum("source_size").over(W.partitionBy()).alias("total"),
    ).withColumn("cap", F.col("source_size") * max_epochs)
    # Compare cap / w exactly: weights divide 6.
    by_cap = W.orderBy((F.col("cap") * 6 / F.col("w")).cast("long"), F.col("source").asc_nulls_last())
    upto = by_cap.rowsBetween(W.unboundedPreceding, -1)
    shared = ordered.select(
        "*",
        (F.col("total") - F.coalesce(F.sum("cap").over(upto), F.lit(0))).alias("rest"),
        (F.sum("w").over(W.partitionBy()) - F.coalesce(F.sum("w").over(upto), F.lit(0))).alias("weights"),
        F.row_number().over(by_cap).alias("k"),
    )
    open_ = F.col("rest") * F.col("w") <= F.col("cap") * F.col("weights")
    first = F.min(F.when(open_, F.col("k"))).over(W.partitionBy())
    at_first = lambda c: F.max(F.when(F.col("k") == F.col("first"), F.col(c))).over(W.partitionBy())
    level = shared.withColumn("first", first)
    level = level.select("*", at_first("rest").alias("r"), at_first("weights").alias("ws"))
    return level.select(
        "source",
        "source_size",
        F.when(F.col("first").isNull() | (F.col("k") < F.col("first")), F.col("cap").cast("double"))
        .otherwise(F.try_divide(F.col("r") * F.col("w"), F.col("ws")))
        .alias("target"),
    )


def slice_of(key: Column, slices: Column) -> Column:
    """Number of the slice of a key: a rising function of it.

    Slices have equal widths of log2(key). An exponential key of any rate, and so a mixture of
    any weights, falls into one of them with a chance of at most 1.02 / slices (4 ln 2 / e), since
    weights only shift the logarithm.
    """
    return F.floor(F.log2(F.greatest(key, F.lit(1e-300))) * slices / 4)


def mix(
    docs: DataFrame,
    weight: Column | None = None,
    max_epochs: int = MAX_EPOCHS,
    carry: list[str] | None = None,
    salt: str = "mix",
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source) of every document.

    The columns that ``carry`` names follow as ``c_...``; others are ignored, whatever their
    names. Of rows with equal draws the smaller id comes first, then the smaller size, then
    the smaller digest of the text; rows that repeat all of these are alike.
    """
    carried = [F.col(f"`{c}`").alias(f"c_{c}") for c in carry or []]
    kept_names = [f"c_{c}" for c in carry or []]
    key = -F.log(F.lit(1.0) - uniform(salt, "doc_id")) / (lexical_weight() if weight is None else weight)
    sized = docs.select("doc_id", "source", "text", *carried).withColumn("size", word_count())
    drawn = sized.select(
        "doc_id", "source", "size", F.coalesce(key, F.lit(0.0)).alias("key"), F.xxhash64("text").alias("digest"), *kept_names
    )
    drawn = kept(drawn, "mixkeys")
    sources = drawn.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    targets = kept(
        source_targets(sources.select("source", "source_size"), max_epochs).join(
            sources.select(F.col("source").alias("s"), "docs"), F.col("source").eqNullSafe(F.col("s"))
        ).select(
            "source", "source_size", "target",
            F.when(F.col("source_size") > 0, F.floor(F.try_divide(F.col("target"), F.col("source_size")))).otherwise(0).alias("epochs"),
            F.ceil(F.sqrt("docs")).alias("slices"),
        ).withColumn("budget", F.floor(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")),
        "mixtargets",
    ).withColumnRenamed("source", "s")
    placed = drawn.join(targets, F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "slice", slice_of(F.col("key"), F.col("slices"))
    )
    totals = placed.groupBy("source", "slice").agg(F.sum("size").alias("n"))
    upto = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    skips = totals.select(
        F.col("source").alias("s"), F.col("slice").alias("t"), F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("skip")
    )
    inside = W.partitionBy("source", "slice").orderBy("key", "doc_id", "size", "digest").rowsBetween(W.unboundedPreceding, -1)
    ranked = placed.select("*", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("here")).join(
        skips, F.col("source").eqNullSafe(F.col("s")) & (F.col("slice") == F.col("t"))
    )
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("skip") - F.col("here")))
    return ranked.select(
        "doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).cast("long").alias("taken"),
        "source", *kept_names,
    )
