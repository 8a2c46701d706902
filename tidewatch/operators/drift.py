"""Distribution drift between a reference table and a current table.

All numeric columns travel together in long form (feature, value, n_ref, n_cur), one row
per distinct value, and all categorical columns in another. One scan of each side and one
shuffle of distinct values give quantile edges, PSI, the KS statistic and the summaries.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import (
    bucket_of,
    finite,
    kolmogorov_survival,
    linear_interior_probabilities,
    number_of,
    psi_term,
    smoothed_share,
)
from tidewatch.functions.tails import chi_squared_survival, kolmogorov_exact
from tidewatch.operators.ordering import running_totals
from tidewatch.operators.quantiles import quantiles_of_ranked

NAN = float("nan")


@dataclass(frozen=True)
class DriftPolicy:
    """Decision thresholds. p-values are reported and never decide."""

    bins: int = 10
    psi: float = 0.2
    p_value: float = 0.05
    share: float = 0.15


def _as_category(df: DataFrame, name: str, binary: bool) -> Column:
    """Text form; binary columns go through int so that ``0`` and ``0.0`` are one category."""
    if binary:
        return number_of(df, name).cast("int").cast("string")
    return F.col(name).cast("string")


def _stack(df: DataFrame, values: Sequence[tuple[str, Column]], value: str, side: str) -> DataFrame:
    wide = df.select(*[c.alias(n) for n, c in values])
    current = F.lit(side == "current")
    return wide.unpivot([], [n for n, _ in values], "feature", value).select(
        "feature", value, current.alias("is_current")
    )


def _count_sides(long: DataFrame, *values: str) -> DataFrame:
    """Counts per side; the NULL row carries the missing values, counted apart.

    The aggregate itself always has the same sums, and the split into present and missing is
    a projection on top, so every consumer can share one shuffle.
    """
    now = F.col("is_current")
    kind = [F.max("is_numeric").alias("is_numeric")] if "is_numeric" in long.columns else []
    totals = long.groupBy("feature", *values).agg(
        F.sum(F.when(now, 0).otherwise(1)).cast("long").alias("r"),
        F.sum(F.when(now, 1).otherwise(0)).cast("long").alias("c"),
        *kind,
    )
    present = reduce(lambda a, b: a | b, [F.col(v).isNotNull() for v in values])
    return totals.select(
        "feature",
        *values,
        *[
            F.when(keep, F.col(short)).otherwise(F.lit(0)).cast("long").alias(f"{name}_{side}")
            for name, keep in (("n", present), ("null", ~present))
            for short, side in (("r", "ref"), ("c", "cur"))
        ],
        *(["is_numeric"] if kind else []),
    )


def _mixed(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str], binary: Sequence[str], side: str
) -> DataFrame:
    """(feature, value, category, is_numeric, is_current): every monitored cell, in one scan."""
    none, text = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = [(c, number_of(df, c), text, True) for c in numeric]
    cells += [(c, none, _as_category(df, c, True), False) for c in binary]
    cells += [(c, none, _as_category(df, c, False), False) for c in categorical]
    flat = [x for name, value, category, kind in cells for x in (F.lit(name), value, category, F.lit(kind))]
    return df.select(
        F.stack(F.lit(len(cells)), *flat).alias("feature", "value", "category", "is_numeric"),
        F.lit(side == "current").alias("is_current"),
    )


def mixed_counts(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    binary: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """:func:`numeric_counts` and :func:`category_counts` from one scan of each side and one shuffle.

    Which of the two a row belongs to is itself an aggregate: a filter on the name would be
    pushed below the shuffle and make two of it.
    """
    sides = [
        _mixed(df, numeric, categorical, binary, side)
        for df, side in ((reference, "reference"), (current, "current"))
    ]
    counts = _count_sides(sides[0].unionAll(sides[1]), "value", "category")
    return (
        counts.where("is_numeric").drop("category", "is_numeric"),
        counts.where("NOT is_numeric").drop("value", "is_numeric"),
    )


def numeric_counts(
    reference: DataFrame, current: DataFrame, columns: Sequence[str]
) -> DataFrame:
    """(feature, value, n_ref, n_cur, null_ref, null_cur), one row per distinct value."""
    sides = [
        _stack(df, [(c, number_of(df, c)) for c in columns], "value", side)
        for df, side in ((reference, "reference"), (current, "current"))
    ]
    return _count_sides(sides[0].unionAll(sides[1]), "value")


def category_counts(
    reference: DataFrame,
    current: DataFrame,
    categorical: Sequence[str] = (),
    binary: Sequence[str] = (),
) -> DataFrame:
    """Category counts of both sides over the union of observed categories."""
    names = [(c, True) for c in binary] + [(c, False) for c in categorical]
    sides = [
        _stack(df, [(c, _as_category(df, c, b)) for c, b in names], "category", side)
        for df, side in ((reference, "reference"), (current, "current"))
    ]
    return _count_sides(sides[0].unionAll(sides[1]), "category")


def _edges(ranked: DataFrame, bins: int, **carry: Column) -> DataFrame:
    """(feature, total, edges, *carry): distinct interior quantiles of the reference side."""
    found = quantiles_of_ranked(ranked, linear_interior_probabilities(bins), "n_ref", carry)
    edges = F.expr("array_distinct(array_compact(quantiles))")
    return found.withColumn("edges", edges).drop("quantiles")


def _ranked(counts: DataFrame, slices: int | None = None) -> DataFrame:
    return running_totals(counts, "value", ["n_ref", "n_cur"], ["feature"], slices)


def quantile_edges(reference: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, edges): distinct interior quantiles with linear interpolation, exact."""
    nothing = reference.limit(0)
    ranked = _ranked(numeric_counts(reference, nothing, columns))
    return _edges(ranked, bins).select("feature", "edges")


def _gap() -> Column:
    """Distance of the two cumulative shares at a value, times both totals.

    Cross-multiplied, so that a row costs no division and equal shares give exactly 0.
    """

    def number(text: str) -> str:
        return f"coalesce(CAST({text} AS DOUBLE), 0D)"

    ref, cur = number("n_ref_before + n_ref"), number("n_cur_before + n_cur")
    return F.expr(f"abs({ref} * {number('n_cur_all')} - {cur} * {number('n_ref_all')})")


def _ks_columns() -> list[Column]:
    n_ref, n_cur = F.col("n_ref").cast("double"), F.col("n_cur").cast("double")
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    distance = F.try_divide(F.col("gap"), n_ref * n_cur)
    size = F.try_divide(n_ref * n_cur, n_ref + n_cur)
    # The exact law of small samples; the limit law where the larger one is beyond its range.
    tail = F.coalesce(kolmogorov_exact(n_ref, n_cur, F.col("gap")), kolmogorov_survival(F.sqrt(size) * distance))
    return [
        F.when(both, distance).otherwise(0.0).alias("statistic"),
        F.when(both, tail).otherwise(1.0).alias("p_value"),
    ]


def ks_two_sample(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, n_ref, n_cur, statistic, p_value); (0, 1) if a side is empty."""
    ranked = _ranked(numeric_counts(reference, current, columns))
    return (
        ranked.groupBy("feature")
        .agg(
            F.max("n_ref_all").alias("n_ref"),
            F.max("n_cur_all").alias("n_cur"),
            F.max(_gap()).alias("gap"),
        )
        .select("feature", "n_ref", "n_cur", *_ks_columns())
    )


def _moments(side: str) -> list[Column]:
    n = F.col(f"n_{side}")
    return [
        F.sum(n).alias(f"n_{side}"),
        F.sum(F.col(f"null_{side}")).alias(f"null_{side}"),
        F.try_divide(F.sum(n * F.col("value")), F.sum(n)).alias(f"mean_{side}"),
    ]


def _missing(side: str) -> Column:
    rows = F.col(f"n_{side}") + F.col(f"null_{side}")
    return F.try_divide(F.col(f"null_{side}"), rows)


def numeric_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    bins: int = 10,
    slices: int | None = None,
) -> DataFrame:
    """PSI, KS and summaries for every numeric column; one row per column."""
    return _numeric_drift(numeric_counts(reference, current, columns), bins, slices)


def _numeric_drift(counts: DataFrame, bins: int, slices: int | None = None) -> DataFrame:
    shape = _edges(_ranked(counts, slices), bins, gap=_gap())
    sums = counts.groupBy("feature").agg(*_moments("ref"), *_moments("cur"))
    # One row per monitored column: as long as the column list, whatever the table size.
    fitted = shape.join(sums, "feature").select(
        "feature",
        "edges",
        "gap",
        *[F.col(f"{c}_{s}").alias(f"{c}_{s}_t") for c in ("n", "null", "mean") for s in ("ref", "cur")],
    )
    spread = {
        s: F.sum(F.col(f"n_{s}") * F.pow(F.col("value") - F.col(f"mean_{s}_t"), 2))
        for s in ("ref", "cur")
    }
    buckets = (
        counts.join(F.broadcast(fitted), "feature")
        .withColumn("bucket", bucket_of("edges", "value", bins - 1))
        .groupBy("feature", "bucket")
        .agg(
            F.sum("n_ref").alias("b_ref"),
            F.sum("n_cur").alias("b_cur"),
            *[e.alias(f"ss_{s}") for s, e in spread.items()],
            *[F.first(c).alias(c) for c in fitted.columns if c != "feature"],
        )
    )
    term = psi_term(
        smoothed_share(F.col("b_ref"), F.col("n_ref_t")),
        smoothed_share(F.col("b_cur"), F.col("n_cur_t")),
    )
    per_column = buckets.groupBy("feature").agg(
        F.sum(F.when((F.col("n_ref_t") > 0) & (F.col("n_cur_t") > 0), term)).alias("psi"),
        *[F.sum(f"ss_{s}").alias(f"ss_{s}") for s in ("ref", "cur")],
        *[
            F.first(f"{c}_{s}_t").alias(f"{c}_{s}")
            for c in ("n", "null", "mean")
            for s in ("ref", "cur")
        ],
        F.first("gap").alias("gap"),
    )
    return per_column.select(
        "feature",
        F.coalesce("psi", F.lit(NAN)).alias("psi"),
        F.lit("ks").alias("test"),
        *_ks_columns(),
        "n_ref",
        "n_cur",
        *[
            c
            for s in ("ref", "cur")
            for c in (
                F.col(f"mean_{s}"),
                F.when(F.col(f"n_{s}") > 1, F.sqrt(F.try_divide(F.col(f"ss_{s}"), F.col(f"n_{s}") - 1))).alias(
                    f"std_{s}"
                ),
                _missing(s).alias(f"missing_{s}"),
            )
        ],
    )


def psi_numeric(
    reference: DataFrame, current: DataFrame, columns: Sequence[str], bins: int = 10
) -> DataFrame:
    """(feature, psi) over quantile bins of the reference; NaN if a side has no values."""
    counts = numeric_counts(reference, current, columns)
    fitted = _edges(_ranked(counts), bins, t_cur=F.expr("n_cur_before + n_cur")).withColumnRenamed(
        "total", "t_ref"
    )
    buckets = (
        counts.join(F.broadcast(fitted), "feature")  # one row per monitored column
        .groupBy("feature", bucket_of("edges", "value", bins - 1).alias("bucket"))
        .agg(
            F.sum("n_ref").alias("b_ref"),
            F.sum("n_cur").alias("b_cur"),
            F.first("t_ref").alias("t_ref"),
            F.first("t_cur").alias("t_cur"),
        )
    )
    term = psi_term(
        smoothed_share(F.col("b_ref"), F.col("t_ref")),
        smoothed_share(F.col("b_cur"), F.col("t_cur")),
    )
    both = (F.col("t_ref") > 0) & (F.col("t_cur") > 0)
    return buckets.groupBy("feature").agg(
        F.coalesce(F.sum(F.when(both, term)), F.lit(NAN)).alias("psi")
    )


def categorical_drift(
    reference: DataFrame,
    current: DataFrame,
    categorical: Sequence[str] = (),
    binary: Sequence[str] = (),
) -> DataFrame:
    """PSI and chi-squared homogeneity per categorical column.

    Totals are joined back instead of summed over a per-column window, so a column with
    very many categories is still spread over all tasks.
    """
    return _categorical_drift(category_counts(reference, current, categorical, binary))


def _categorical_drift(counts: DataFrame) -> DataFrame:
    totals = counts.groupBy("feature").agg(
        F.sum("n_ref").alias("t_ref"),
        F.sum("n_cur").alias("t_cur"),
        F.sum("null_ref").alias("m_ref"),
        F.sum("null_cur").alias("m_cur"),
        F.count("category").alias("k"),
    )
    joined = counts.join(F.broadcast(totals), "feature")  # one row per monitored column
    usable = F.col("category").isNotNull() & (F.col("t_ref") > 0) & (F.col("t_cur") > 0)
    row = (F.col("n_ref") + F.col("n_cur")).cast("double")
    grand = F.col("t_ref") + F.col("t_cur")

    def residual(observed: str, total: str) -> Column:
        expected = F.try_divide(row * F.col(total), grand)
        distance = F.abs(F.col(observed) - expected)
        # Continuity correction for a 2 x 2 table, never past zero.
        distance = F.when(F.col("k") == 2, distance - F.least(F.lit(0.5), distance)).otherwise(
            distance
        )
        return F.try_divide(distance * distance, expected)

    term = psi_term(
        smoothed_share(F.col("n_ref"), F.col("t_ref")),
        smoothed_share(F.col("n_cur"), F.col("t_cur")),
    )
    per_column = joined.groupBy("feature").agg(
        F.sum(F.when(usable, term)).alias("psi"),
        F.sum(F.when(usable, residual("n_ref", "t_ref") + residual("n_cur", "t_cur"))).alias("x2"),
        *[F.first(c).alias(c) for c in ("k", "t_ref", "t_cur", "m_ref", "m_cur")],
    )
    testable = (F.col("k") >= 2) & (F.col("t_ref") > 0) & (F.col("t_cur") > 0)
    statistic = F.when(testable, F.col("x2")).otherwise(0.0)
    dof = F.greatest(F.col("k") - 1, F.lit(0))
    return per_column.select(
        "feature",
        F.coalesce("psi", F.lit(NAN)).alias("psi"),
        F.lit("chi2").alias("test"),
        statistic.alias("statistic"),
        F.when(testable, chi_squared_survival(statistic, dof)).otherwise(1.0).alias("p_value"),
        dof.alias("dof"),
        F.col("t_ref").alias("n_ref"),
        F.col("t_cur").alias("n_cur"),
        *[
            F.try_divide(F.col(f"m_{s}"), F.col(f"t_{s}") + F.col(f"m_{s}")).alias(f"missing_{s}")
            for s in ("ref", "cur")
        ],
    )


def category_shares(
    df: DataFrame, categorical: Sequence[str] = (), binary: Sequence[str] = ()
) -> DataFrame:
    """(feature, category, share): non-null shares to 4 decimals, one row per category."""
    counts = category_counts(df, df.limit(0), categorical, binary).where("category IS NOT NULL")
    totals = counts.groupBy("feature").agg(F.sum("n_ref").alias("total"))
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", "category", F.bround(F.col("n_ref") / F.col("total"), 4).alias("share")
    )


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, std, missing_fraction): one aggregate over the wide table."""
    cells = []
    for c in columns:
        value = number_of(df, c)
        cells.append(
            F.struct(
                F.lit(c).alias("feature"),
                F.avg(value).alias("mean"),
                F.when(F.count(value) > 1, F.stddev_samp(value)).alias("std"),
                F.avg(value.isNull().cast("double")).alias("missing_fraction"),
            )
        )
    return df.agg(F.array(*cells).alias("rows")).select(F.inline("rows"))


def drift_report(
    reference: DataFrame,
    current: DataFrame,
    numeric: Sequence[str] = (),
    categorical: Sequence[str] = (),
    binary: Sequence[str] = (),
    policy: DriftPolicy = DriftPolicy(),
    reference_scores: DataFrame | None = None,
    current_scores: DataFrame | None = None,
    score: str = "churn_probability",
    slices: int | None = None,
) -> DataFrame:
    """One row per monitored column, and one for the model score when both are given.

    ``drift_detected`` is decided by PSI alone; a PSI that is not finite never alerts.
    """
    parts = []
    numbers, words = mixed_counts(reference, current, numeric, categorical, binary)
    if numeric:
        parts.append(_numeric_drift(numbers, policy.bins, slices).withColumn("kind", F.lit("numeric")))
    if categorical or binary:
        kind = F.when(F.col("feature").isin(list(binary)), F.lit("binary")).otherwise("categorical")
        parts.append(_categorical_drift(words).drop("dof").withColumn("kind", kind))
    if reference_scores is not None and current_scores is not None:
        parts.append(
            numeric_drift(reference_scores, current_scores, [score], policy.bins, slices).withColumn(
                "kind", F.lit("prediction")
            )
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part, allowMissingColumns=True)
    flag = F.coalesce(finite(F.col("psi")) & (F.col("psi") >= policy.psi), F.lit(False))
    return report.withColumn("drift_detected", flag)


def dataset_drift(report: DataFrame, policy: DriftPolicy = DriftPolicy()) -> DataFrame:
    """Roll-up of a report: share of drifted inputs, the flag and the score's PSI."""
    inputs = F.col("kind") != "prediction"
    drifted = inputs & F.col("drift_detected")
    share = F.try_divide(F.sum(drifted.cast("long")), F.sum(inputs.cast("long")))
    return report.agg(
        F.sum(inputs.cast("long")).alias("n_features"),
        F.sum(drifted.cast("long")).alias("n_drifted"),
        share.alias("drift_share"),
        (share >= policy.share).alias("dataset_drift"),
        # as long as the column list
        F.array_sort(F.collect_list(F.when(drifted, F.col("feature")))).alias("drifted_features"),
        F.max(F.when(~inputs, F.col("psi"))).alias("prediction_psi"),
    )


def windowed_drift(
    reference: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    ts: str,
    width: str,
    bins: int = 10,
) -> DataFrame:
    """PSI of each time window of ``current`` against the whole reference.

    Edges and reference bucket counts are fitted once and are one small row per column;
    the current side is reduced to (window, feature, bucket) counts on the map side.
    """
    counts = numeric_counts(reference, reference.limit(0), columns)
    edges = _edges(_ranked(counts), bins).select("feature", "edges")
    expected = (
        counts.join(F.broadcast(edges), "feature")
        .groupBy("feature", bucket_of("edges", "value", bins - 1).alias("bucket"))
        .agg(F.sum("n_ref").alias("n"), F.first("edges").alias("edges"))
        .groupBy("feature")
        .agg(
            F.first("edges").alias("edges"),
            F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("ref"),  # <= bins
            F.sum("n").alias("t_ref"),
        )
    )
    wide = current.select(
        F.window(ts, width).start.alias("window_start"),
        *[number_of(current, c).alias(c) for c in columns],
    )
    observed = (
        wide.unpivot(["window_start"], list(columns), "feature", "value")
        .where("value IS NOT NULL")
        .join(F.broadcast(expected.select("feature", "edges")), "feature")
        .groupBy("window_start", "feature", bucket_of("edges", "value", bins - 1).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("window_start", "feature")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("cur"),
            F.sum("n").alias("t_cur"),
        )
    )
    joined = observed.join(F.broadcast(expected), "feature")
    return joined.select(
        "window_start",
        "feature",
        F.col("t_cur").alias("n_current"),
        psi_between_maps(F.col("ref"), F.col("t_ref"), F.col("cur"), F.col("t_cur")).alias("psi"),
    )


def psi_between_maps(ref: Column, t_ref: Column, cur: Column, t_cur: Column) -> Column:
    """PSI of two bucket -> count maps with their totals."""
    keys = F.array_sort(F.array_union(F.map_keys(ref), F.map_keys(cur)))
    zero = F.lit(0)

    def term(k: Column) -> Column:
        return psi_term(
            smoothed_share(F.coalesce(F.try_element_at(ref, k), zero), t_ref),
            smoothed_share(F.coalesce(F.try_element_at(cur, k), zero), t_cur),
        )

    return F.aggregate(keys, F.lit(0.0), lambda acc, k: acc + term(k))
