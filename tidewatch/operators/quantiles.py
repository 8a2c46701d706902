"""Exact quantiles of many columns at once, without holding values on one reducer.

Spark's ``percentile`` keeps every distinct value of a column in one aggregation buffer.
Here values are counted by a shuffle and the rank is found from running counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import number_of
from tidewatch.operators.ordering import running_totals


def value_counts(df: DataFrame, columns: Sequence[str], count: str = "n") -> DataFrame:
    """(feature, value, n) of the non-missing values of numeric columns."""
    wide = df.select(*[number_of(df, c).alias(c) for c in columns])
    return (
        wide.unpivot([], list(columns), "feature", "value")
        .where("value IS NOT NULL")
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias(count))
    )


def quantiles_of_ranked(
    ranked: DataFrame,
    probabilities: Sequence[float],
    count: str = "n",
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(feature, total, quantiles, *carry) from running counts over distinct values.

    A row is first labelled with how many of the wanted ranks it has passed; per feature
    that leaves about twice as many groups as quantiles, and picking the values is cheap.
    ``carry`` holds further per-row columns whose maximum is wanted.
    """
    carry = carry or {}
    total = f"{count}_all"
    # Ranks as doubles that cannot be NULL: the comparisons below then compile to a few
    # instructions each. Whole numbers up to 2**53 stay exact.
    placed = ranked.withColumns(
        {
            "_reached": F.expr(f"coalesce(CAST({count}_before + {count} AS DOUBLE), 0D)"),
            "_last": F.expr(f"coalesce(CAST({total} - 1 AS DOUBLE), 0D)"),
        }
    )
    spots = [f"_last * {float(q)}D" for q in probabilities]
    # For whole numbers c > floor(x) is c > x, and c > floor(x) + 1 is c - 1 > x.
    passed = {
        "_lows": " + ".join(f"CAST(_reached > {spot} AS INT)" for spot in spots),
        "_highs": f"IF(_reached > _last, {len(spots)}, "
        + " + ".join(f"CAST(_reached - 1D > {spot} AS INT)" for spot in spots)
        + ")",
    }
    marks = placed.groupBy(
        "feature", *[F.expr(text).alias(name) for name, text in passed.items()]
    ).agg(
        F.min("value").alias("value"),
        F.max(total).alias("total"),
        *[F.max(column).alias(name) for name, column in carry.items()],
    )
    picked = marks.groupBy("feature").agg(
        F.max("total").alias("total"),
        *[
            F.expr(f"min(CASE WHEN {side} > {i} THEN value END)").alias(f"{side}{i}")
            for side in ("_lows", "_highs")
            for i in range(len(probabilities))
        ],
        *[F.max(name).alias(name) for name in carry],
    )
    # Interpolation is anchored at the nearer end, so two equal ends give exactly that value.
    cells = []
    for i, q in enumerate(probabilities):
        low, high = f"_lows{i}", f"_highs{i}"
        fraction = f"((total - 1) * {float(q)}D - floor((total - 1) * {float(q)}D))"
        cells.append(
            f"IF({fraction} < 0.5D, {low} + ({high} - {low}) * {fraction}, "
            f"{high} - ({high} - {low}) * (1D - {fraction}))"
        )
    return picked.select(
        "feature", "total", F.expr(f"array({', '.join(cells)})").alias("quantiles"), *carry
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    slices: int | None = None,
) -> DataFrame:
    """(feature, quantiles array) for numeric columns; a column without values has no row."""
    ranked = running_totals(value_counts(df, columns), "value", ["n"], ["feature"], slices)
    return quantiles_of_ranked(ranked, probabilities).select("feature", "quantiles")


def exact_median(df: DataFrame, column: str) -> Column:
    """The median as a scalar subquery: usable in any expression, computed once."""
    return exact_quantiles(df, [column], [0.5]).select(F.col("quantiles")[0]).scalar()
