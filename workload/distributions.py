"""Drift queries over line items before and after a date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import drift
from workload.registry import query, tidy
from workload.views import frames, with_clause

BOTH = with_clause("drift_reference", "drift_current")
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CATEGORICAL = ["l_returnflag", "l_linestatus"]
BINARY = ["bulk"]
PROBABILITIES = "[" + ", ".join(repr(i * 0.1) for i in range(1, 10)) + "]"


def _long(columns: list[str], cast: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS {cast}) AS v, {side} AS cur FROM {source}"
        for c in columns
        for source, side in (("drift_reference", 0), ("drift_current", 1))
    )


NUMERIC_CTE = f"""{BOTH}, long AS ({_long(NUMERIC, 'DOUBLE')}),
totals AS (SELECT feature, count(*) FILTER (WHERE cur = 0) AS nr, count(*) FILTER (WHERE cur = 1) AS nc FROM long GROUP BY 1),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {PROBABILITIES}))) AS e FROM long WHERE cur = 0 GROUP BY 1),
bucketed AS (SELECT feature, len(list_filter(e, lambda x: x <= v)) AS b, cur FROM long JOIN edges USING (feature)),
shares AS (SELECT feature, b, greatest(count(*) FILTER (WHERE cur = 0) / CAST(any_value(nr) AS DOUBLE), 1e-4) AS pe,
  greatest(count(*) FILTER (WHERE cur = 1) / CAST(any_value(nc) AS DOUBLE), 1e-4) AS pa
  FROM bucketed JOIN totals USING (feature) GROUP BY 1, 2),
npsi AS (SELECT feature, sum((pa - pe) * ln(pa / pe)) AS psi FROM shares GROUP BY 1),
per_value AS (SELECT feature, v, count(*) FILTER (WHERE cur = 0) AS r, count(*) FILTER (WHERE cur = 1) AS c FROM long GROUP BY 1, 2),
running AS (SELECT feature, sum(r) OVER w AS rr, sum(c) OVER w AS rc FROM per_value
  WINDOW w AS (PARTITION BY feature ORDER BY v)),
gap AS (SELECT feature, max(abs(rr / CAST(nr AS DOUBLE) - rc / CAST(nc AS DOUBLE))) AS d, any_value(nr) AS nr, any_value(nc) AS nc
  FROM running JOIN totals USING (feature) GROUP BY 1),
ks AS (SELECT feature, nr, nc, d, sqrt(CAST(nr AS DOUBLE) * nc / (nr + nc)) * d AS lam FROM gap)"""
KS_P = """CASE WHEN lam < 0.2 THEN 1 ELSE least(1, greatest(0, list_sum(list_transform(range(1, 101),
  lambda k: (CASE WHEN k % 2 = 1 THEN 2 ELSE -2 END) * exp(-2 * CAST(k AS DOUBLE) * k * lam * lam))))) END"""
CATEGORY_CTE = f"""clong AS ({_long(CATEGORICAL + BINARY, 'VARCHAR')}),
cells AS (SELECT feature, v, count(*) FILTER (WHERE cur = 0) AS r, count(*) FILTER (WHERE cur = 1) AS c FROM clong GROUP BY 1, 2),
ctot AS (SELECT feature, sum(r) AS nr, sum(c) AS nc, count(*) AS k FROM cells GROUP BY 1),
cpsi AS (SELECT feature, sum((pa - pe) * ln(pa / pe)) AS psi FROM (
  SELECT feature, greatest(r / CAST(nr AS DOUBLE), 1e-4) AS pe, greatest(c / CAST(nc AS DOUBLE), 1e-4) AS pa
  FROM cells JOIN ctot USING (feature)) GROUP BY 1),
resid AS (SELECT feature, k, (r + c) * CAST(nr AS DOUBLE) / (nr + nc) AS er, (r + c) * CAST(nc AS DOUBLE) / (nr + nc) AS ec, r, c
  FROM cells JOIN ctot USING (feature)),
chi AS (SELECT feature, any_value(k) - 1 AS dof, sum(CASE WHEN k = 2
    THEN (abs(r - er) - least(0.5, abs(r - er))) ** 2 / er + (abs(c - ec) - least(0.5, abs(c - ec))) ** 2 / ec
    ELSE (r - er) ** 2 / er + (c - ec) ** 2 / ec END) AS x2 FROM resid GROUP BY 1)"""
# dof is 1 or 2 on these columns: erfc(sqrt(x/2)) by its series, and exp(-x/2).
CHI_P = """CASE WHEN dof = 2 THEN exp(-x2 / 2) ELSE 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 60),
  lambda n: (CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END) * sqrt(x2 / 2) ** (2 * n + 1) / (gamma(n + 1) * (2 * n + 1)))) END"""


def _sides(spark: SparkSession, sf: str) -> list[DataFrame]:
    return frames(spark, sf, "drift_reference", "drift_current")


@query(
    "quantile_edges",
    f"""{NUMERIC_CTE}, flat AS (SELECT feature, unnest(e) AS edge FROM edges)
SELECT feature, CAST(row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS INT) AS position, round(edge, 6) AS edge FROM flat""",
)
def quantile_edges(spark: SparkSession, sf: str) -> DataFrame:
    reference, _ = _sides(spark, sf)
    edges = drift.quantile_edges(reference, NUMERIC)
    return tidy(edges.select("feature", F.posexplode("edges").alias("position", "edge")))


@query("psi_numeric", f"{NUMERIC_CTE} SELECT feature, round(psi, 8) AS psi FROM npsi")
def psi_numeric(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drift.psi_numeric(*_sides(spark, sf), NUMERIC), 8)


@query("psi_categorical", f"{BOTH}, {CATEGORY_CTE} SELECT feature, round(psi, 8) AS psi FROM cpsi")
def psi_categorical(spark: SparkSession, sf: str) -> DataFrame:
    found = drift.categorical_drift(*_sides(spark, sf), CATEGORICAL, BINARY)
    return tidy(found.select("feature", "psi"), 8)


@query(
    "ks_two_sample",
    f"""{NUMERIC_CTE} SELECT feature, CAST(nr AS BIGINT) AS n_ref, CAST(nc AS BIGINT) AS n_cur,
  round(d, 8) AS statistic, round({KS_P}, 8) AS p_value FROM ks""",
)
def ks_two_sample(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drift.ks_two_sample(*_sides(spark, sf), NUMERIC), 8)


@query(
    "chi2_homogeneity",
    f"""{BOTH}, {CATEGORY_CTE} SELECT feature, CAST(dof AS BIGINT) AS dof, round(x2, 6) AS statistic,
  round({CHI_P}, 6) AS p_value FROM chi""",
)
def chi2_homogeneity(spark: SparkSession, sf: str) -> DataFrame:
    found = drift.categorical_drift(*_sides(spark, sf), CATEGORICAL, BINARY)
    return tidy(found.select("feature", F.col("dof").cast("long"), "statistic", "p_value"))


DRIFT_REPORT = f"""{NUMERIC_CTE}, {CATEGORY_CTE},
moments AS (SELECT feature, avg(v) FILTER (WHERE cur = 0) AS mr, avg(v) FILTER (WHERE cur = 1) AS mc,
  stddev_samp(v) FILTER (WHERE cur = 0) AS sr, stddev_samp(v) FILTER (WHERE cur = 1) AS sc FROM long GROUP BY 1),
report AS (
SELECT feature, 'numeric' AS kind, round(psi, 6) AS psi, 'ks' AS test, round(d, 6) AS statistic, round({KS_P}, 6) AS p_value,
  round(mr, 4) AS mean_ref, round(sr, 4) AS std_ref, round(mc, 4) AS mean_cur, round(sc, 4) AS std_cur, psi >= 0.2 AS drift_detected
FROM npsi JOIN ks USING (feature) JOIN moments USING (feature)
UNION ALL
SELECT feature, CASE WHEN feature = 'bulk' THEN 'binary' ELSE 'categorical' END, round(psi, 6), 'chi2', round(x2, 6), round({CHI_P}, 6),
  NULL, NULL, NULL, NULL, psi >= 0.2
FROM cpsi JOIN chi USING (feature))"""


@query("drift_report", f"{DRIFT_REPORT} SELECT * FROM report")
def drift_report(spark: SparkSession, sf: str) -> DataFrame:
    report = drift.drift_report(*_sides(spark, sf), NUMERIC, CATEGORICAL, BINARY)
    names = ["mean_ref", "std_ref", "mean_cur", "std_cur"]
    return tidy(
        report.select(
            "feature", "kind", "psi", "test", "statistic", "p_value", *names, "drift_detected"
        ),
        **{n: 4 for n in names},
    )


@query(
    "dataset_drift",
    f"""{DRIFT_REPORT} SELECT count(*) AS n_features, count(*) FILTER (WHERE drift_detected) AS n_drifted,
  round(avg(CAST(drift_detected AS INT)), 6) AS drift_share, avg(CAST(drift_detected AS INT)) >= 0.15 AS dataset_drift,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE drift_detected), '') AS drifted_features FROM report""",
)
def dataset_drift(spark: SparkSession, sf: str) -> DataFrame:
    report = drift.drift_report(*_sides(spark, sf), NUMERIC, CATEGORICAL, BINARY)
    return tidy(drift.dataset_drift(report).drop("prediction_psi"))


@query(
    "windowed_drift",
    f"""{BOTH}, rlong AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS v FROM drift_reference" for c in NUMERIC)}),
clong AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS v, time_bucket(INTERVAL '30 days', l_shipdate, TIMESTAMP '1970-01-01') AS w FROM drift_current" for c in NUMERIC)}),
edges AS (SELECT feature, list_sort(list_distinct(quantile_cont(v, {PROBABILITIES}))) AS e, count(*) AS nr FROM rlong GROUP BY 1),
rb AS (SELECT feature, len(list_filter(e, lambda x: x <= v)) AS b, count(*) AS n, any_value(nr) AS nr FROM rlong JOIN edges USING (feature) GROUP BY 1, 2),
cb AS (SELECT feature, w, len(list_filter(e, lambda x: x <= v)) AS b, count(*) AS n FROM clong JOIN edges USING (feature) GROUP BY 1, 2, 3),
ct AS (SELECT feature, w, count(*) AS nc FROM clong GROUP BY 1, 2),
grid AS (SELECT ct.feature, w, nc, b, greatest(rb.n / CAST(nr AS DOUBLE), 1e-4) AS pe FROM ct JOIN rb USING (feature)),
terms AS (SELECT g.feature, g.w, g.nc, pe, greatest(coalesce(cb.n, 0) / CAST(nc AS DOUBLE), 1e-4) AS pa
  FROM grid g LEFT JOIN cb ON cb.feature = g.feature AND cb.w = g.w AND cb.b = g.b)
SELECT w AS window_start, feature, nc AS n_current, round(sum((pa - pe) * ln(pa / pe)), 6) AS psi FROM terms GROUP BY 1, 2, 3""",
)
def windowed_drift(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drift.windowed_drift(*_sides(spark, sf), NUMERIC, "l_shipdate", "30 days"))
