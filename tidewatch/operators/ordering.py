"""Running sums, ranks and cut points over a global order, without a single-task window.

``sum() over (order by x)`` with no partition key moves every row to one task. Here the
order is first cut into slices that hold about the same number of rows; sums run inside
the slices in parallel, and the totals of the preceding slices (one row per slice) are
added afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.functions.columns import uniform

HASH_SLICES = 1 << 16


def default_slices(df: DataFrame) -> int:
    """Several slices per shuffle partition, as a power of two; at least 128."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return 1 << min(14, max(7, ceil(log2(4 * partitions))))


def with_slices(
    df: DataFrame, order: str, totals: Sequence[str], slices: int, like: DataFrame | None = None
) -> DataFrame:
    """Add ``_slice``: which of ``slices`` equally filled ranges of ``order`` a row is in.

    The cut points come from one scalar subquery over the same input. It also sums
    ``totals``, which keeps its column list equal to the main branch, so that Spark reuses
    the shuffle below instead of computing it again. The slice is found by a binary search
    spelled out as log2(slices) projections, which stay inside generated code.

    ``like`` gives the cut points instead where ``df`` is far larger. They decide how evenly
    rows are dealt, not what the sums are.
    """
    points = ", ".join(f"{i / slices}D" for i in range(1, slices))
    cuts = (df if like is None else like).agg(
        F.struct(
            F.expr(
                f"percentile_approx(`{order}`, array({points}), {max(10000, 20 * slices)})"
            ).alias("cuts"),
            *[F.sum(t).alias(f"t{i}") for i, t in enumerate(totals)],
        ).alias("s")
    ).scalar()
    found = df.withColumn("_cuts", cuts["cuts"]).withColumn("_slice", F.lit(0))
    step = slices // 2
    while step:
        found = found.withColumn(
            "_slice",
            F.expr(f"_slice + IF(coalesce(get(_cuts, _slice + {step - 1}) <= `{order}`, false), {step}, 0)"),
        )
        step //= 2
    return found.drop("_cuts")


def sum_by_slices(
    sliced: DataFrame, order: Sequence[str], totals: Sequence[str], by: Sequence[str]
) -> DataFrame:
    """Exclusive running sums given ``_slice``; see :func:`running_totals`."""
    # A struct compares NULL fields as equal, so a NULL group key joins like any other;
    # keys that cannot be NULL stay plain columns, which sort faster.
    plain = not any(sliced.schema[c].nullable for c in by)
    grouped = sliced if plain else sliced.withColumn("_g", F.struct(*by))
    group = list(by) if plain else ["_g"]
    keys = ["_slice", *group]
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = grouped.select(
        "*", *[F.coalesce(F.sum(t).over(inside), F.lit(0)).alias(f"_in_{t}") for t in totals]
    )
    # One row per (group, slice): the window below sees at most `slices` rows per group.
    per_slice = grouped.groupBy(*keys).agg(*[F.sum(t).alias(f"_s_{t}") for t in totals])
    before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_slice.select(
        *keys,
        *[F.coalesce(F.sum(f"_s_{t}").over(before), F.lit(0)).alias(f"_off_{t}") for t in totals],
        *[F.sum(f"_s_{t}").over(W.partitionBy(*group)).alias(f"{t}_all") for t in totals],
    )
    # The join keys equal the window's partitioning, so only `offsets` has to move;
    # whether it is broadcast is left to adaptive execution, which knows its size.
    return local.join(offsets, keys).select(
        *sliced.drop("_slice").columns,
        *[(F.col(f"_in_{t}") + F.col(f"_off_{t}")).alias(f"{t}_before") for t in totals],
        *[f"{t}_all" for t in totals],
    )


def running_totals(
    df: DataFrame,
    order: str,
    totals: Sequence[str],
    by: Sequence[str] = (),
    slices: int | None = None,
    like: DataFrame | None = None,
) -> DataFrame:
    """Add ``<t>_before`` (sum over smaller ``order`` values) and ``<t>_all`` per group.

    ``df`` must hold one row per (by, order) pair, i.e. be aggregated to distinct values
    first, which also removes any skew in how often a value occurs. The plan is the same
    for every size. ``like`` is for :func:`with_slices`.
    """
    sliced = with_slices(df, order, totals, slices or default_slices(df), like)
    return sum_by_slices(sliced, [order], totals, by)


def hash_positions(
    df: DataFrame,
    key: Sequence[str],
    salt: str | int,
    name: str,
    by: Sequence[str] = (),
    slices: int | None = None,
    draw: str | None = None,
) -> DataFrame:
    """Add a 1-based rank in the random order given by ``salt``; exact and gap-free.

    The draw is uniform by construction, so equal ranges of it are equal slices and no
    pass over the data is needed to find them. ``draw`` names a column that holds one already.
    """
    slices = slices or default_slices(df)
    columns = [c for c in df.columns if c != draw]
    drawn = df.select(*columns, (F.col(draw) if draw else uniform(salt, *key)).alias("_u"), F.lit(1).alias("_one")).withColumn(
        "_slice", F.floor(F.col("_u") * slices).cast("int")
    )
    ranked = sum_by_slices(drawn, ["_u", *key], ["_one"], by)
    return ranked.select(*columns, (F.col("_one_before") + 1).alias(name))


def hash_cutoffs(
    df: DataFrame,
    key: Sequence[str],
    salt: str | int,
    ranks: Callable[[Column], Column],
    by: str | None = None,
    slices: int = HASH_SLICES,
) -> Column:
    """Scalar array of (group, draw, key) cut points at exact ranks of a random order.

    ``ranks`` maps a group's row count to an array of ranks. Rows are counted per slice of
    the draw, the slice that holds each rank is found from those counts, and only rows of
    these few slices are sorted. Labelling rows against the result is then a map without a
    shuffle. The array has (groups x ranks) entries: ``by`` must be a class label.
    """
    group = F.col(by).cast("string") if by else F.lit("")
    drawn = df.select(
        group.alias("_g"), uniform(salt, *key).alias("_u"), F.struct(*key).alias("_k")
    ).withColumn("_slice", F.floor(F.col("_u") * slices).cast("int"))
    counts = drawn.groupBy("_g", "_slice").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("_g").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    placed = counts.select(
        "_g",
        "_slice",
        "n",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"),
        F.sum("n").over(W.partitionBy("_g")).alias("size"),
    )
    wanted = (
        placed.select("*", F.posexplode(ranks(F.col("size"))).alias("cut", "rank"))
        .where((F.col("rank") > F.col("skip")) & (F.col("rank") <= F.col("skip") + F.col("n")))
        .agg(
            F.collect_list(
                F.struct("_g", "_slice", "cut", (F.col("rank") - F.col("skip")).alias("local"))
            ).alias("w")
        )
        .scalar()
    )
    near = drawn.withColumn("_w", wanted).select(
        "_g",
        "_u",
        "_k",
        "_slice",
        F.explode(
            F.filter(
                "_w",
                lambda w: w["_g"].eqNullSafe(F.col("_g")) & (w["_slice"] == F.col("_slice")),
            )
        ).alias("_t"),
    )
    in_slice = W.partitionBy("_g", "_slice", "_t.cut").orderBy("_u", "_k")
    hits = near.withColumn("_rn", F.row_number().over(in_slice)).where(
        F.col("_rn") == F.col("_t.local")
    )
    return hits.agg(
        F.collect_list(F.struct(F.col("_g").alias("g"), F.col("_u").alias("u"), F.col("_k").alias("k")))
        .alias("c")
    ).scalar()


def cutoffs_passed(
    df: DataFrame,
    name: str,
    key: Sequence[str],
    salt: str | int,
    ranks: Callable[[Column], Column],
    by: str | None = None,
    slices: int = HASH_SLICES,
    ties: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: how many of the cut points of its group a row has reached.

    A cut point is the first row of the next part, so the count is the number of the part."""
    cut_points = hash_cutoffs(df if ties is None else ties, key, salt, ranks, by, slices)
    group = F.col(by).cast("string") if by else F.lit("")
    here = F.struct(F.col("_u").alias("u"), F.struct(*key).alias("k"))
    reached = F.filter(
        "_c",
        lambda c: c["g"].eqNullSafe(group)
        & (F.struct(c["u"].alias("u"), c["k"].alias("k")) <= here),
    )
    return (
        df.withColumn("_c", cut_points)
        .withColumn("_u", uniform(salt, *key))
        .withColumn(name, F.coalesce(F.size(reached), F.lit(0)))
        .drop("_c", "_u")
    )
