"""Operational metrics over the request log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import timeseries
from workload.log import histogram_sql
from workload.registry import query, tidy
from workload.views import frame, with_clause

REQ = with_clause("request_log")
ORIGIN = "TIMESTAMP '1970-01-01'"


def _bucket(width: str) -> str:
    return f"time_bucket(INTERVAL '{width}', ts, {ORIGIN})"


@query(
    "event_rate",
    f"""{REQ}, s AS (SELECT {_bucket('6 hours')} - i * INTERVAL '6 hours' AS window_start, route
  FROM request_log, (SELECT unnest(range(0, 4)) AS i))
SELECT window_start, route, count(*) AS n, round(count(*) / CAST(86400 AS DOUBLE), 8) AS rate FROM s GROUP BY 1, 2""",
)
def event_rate(spark: SparkSession, sf: str) -> DataFrame:
    requests = frame(spark, sf, "request_log")
    return tidy(timeseries.event_rate(requests, "ts", "1 day", "6 hours", ["route"]), 8)


@query(
    "error_ratio",
    f"""{REQ} SELECT {_bucket('1 hour')} AS window_start, count(*) AS n, count(*) FILTER (WHERE status LIKE '5%') AS n_failed,
  round(count(*) FILTER (WHERE status LIKE '5%') / CAST(count(*) AS DOUBLE), 6) AS ratio FROM request_log GROUP BY 1""",
)
def error_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(timeseries.error_ratio(frame(spark, sf, "request_log"), "ts", "1 hour"))


@query("label_counters", f"{REQ} SELECT method, route, status, count(*) AS n FROM request_log GROUP BY 1, 2, 3")
def label_counters(spark: SparkSession, sf: str) -> DataFrame:
    return timeseries.label_counters(frame(spark, sf, "request_log"), ["method", "route", "status"])


@query(
    "latency_histogram",
    f"{REQ} {histogram_sql('request_log', 'duration_s', timeseries.LATENCY_BOUNDS, 'route')}",
)
def latency_histogram(spark: SparkSession, sf: str) -> DataFrame:
    requests = frame(spark, sf, "request_log")
    return tidy(
        timeseries.cumulative_histogram(requests, "duration_s", timeseries.LATENCY_BOUNDS, ["route"]), 4
    )


def quantile_sql(q: float) -> str:
    """The first bucket whose cumulative count reaches the rank, interpolated."""
    cases, low, below = [], 0.0, "0"
    for i, bound in enumerate(timeseries.LATENCY_BOUNDS):
        cases.append(
            f"WHEN c{i} >= {q} * n AND c{i} > {below} THEN {low} + ({bound} - {low}) * ({q} * n - {below}) / CAST(c{i} - {below} AS DOUBLE)"
        )
        low, below = bound, f"c{i}"
    return f"CASE {' '.join(cases)} ELSE {low} END"


BUCKETS = f"""b AS (SELECT {_bucket('1 day')} AS window_start, route, count(*) AS n, {', '.join(
    f"count(*) FILTER (WHERE duration_s <= {b}) AS c{i}" for i, b in enumerate(timeseries.LATENCY_BOUNDS))}
  FROM request_log WHERE route LIKE '/predict%' GROUP BY 1, 2)"""


@query(
    "histogram_quantile",
    f"""{REQ}, {BUCKETS} SELECT window_start, route, n, round({quantile_sql(0.5)}, 9) AS p50, round({quantile_sql(0.95)}, 9) AS p95 FROM b""",
)
def histogram_quantile(spark: SparkSession, sf: str) -> DataFrame:
    requests = frame(spark, sf, "request_log").where("route LIKE '/predict%'")
    found = timeseries.histogram_quantiles(
        requests, "duration_s", timeseries.LATENCY_BOUNDS, {"p50": 0.5, "p95": 0.95}, "ts", "1 day", by=["route"]
    )
    return tidy(found, 9)


SAMPLES = f"""{REQ}, ratio AS (SELECT {_bucket('6 hours')} AS ts, count(*) FILTER (WHERE status LIKE '5%') / CAST(count(*) AS DOUBLE) AS v
  FROM request_log GROUP BY 1),
lat AS (SELECT {_bucket('6 hours')} AS ts, count(*) AS n, {', '.join(
    f"count(*) FILTER (WHERE duration_s <= {b}) AS c{i}" for i, b in enumerate(timeseries.LATENCY_BOUNDS))}
  FROM request_log WHERE route LIKE '/predict%' GROUP BY 1),
up AS (SELECT TIMESTAMP '2024-02-01 00:00:00' AS ts, CAST(date_sub('second', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS DOUBLE) AS v FROM request_log),
x AS (SELECT 'high_error_rate' AS alert, 'warning' AS severity, 300 AS hold, ts, v, v > 0.05 AS hit FROM ratio
  UNION ALL SELECT 'high_latency', 'warning', 300, ts, {quantile_sql(0.95)}, ({quantile_sql(0.95)}) > 0.5 FROM lat
  UNION ALL SELECT 'monitor_stale', 'warning', 0, ts, v, v > 600 FROM up),
runs AS (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY alert ORDER BY ts) AS run FROM x),
since AS (SELECT *, min(CASE WHEN hit THEN ts END) OVER (PARTITION BY alert, run) AS s FROM runs)"""


@query(
    "alert_states",
    f"""{SAMPLES} SELECT alert, severity, ts, round(v, 9) AS value,
  CASE WHEN NOT hit THEN 'inactive' WHEN date_sub('second', s, ts) >= hold THEN 'firing' ELSE 'pending' END AS state FROM since""",
)
def alert_states(spark: SparkSession, sf: str) -> DataFrame:
    requests = frame(spark, sf, "request_log")
    ratio = timeseries.error_ratio(requests, "ts", "6 hours").select(
        F.lit("error_ratio").alias("metric"), F.col("window_start").alias("ts"), F.col("ratio").alias("value")
    )
    latency = timeseries.histogram_quantiles(
        requests.where("route LIKE '/predict%'"),
        "duration_s",
        timeseries.LATENCY_BOUNDS,
        {"value": 0.95},
        "ts",
        "6 hours",
    ).select(F.lit("latency_p95").alias("metric"), F.col("window_start").alias("ts"), "value")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    stale = timeseries.age_samples(requests, "monitor_age_seconds", now)
    samples = ratio.unionByName(latency).unionByName(stale)
    return tidy(timeseries.alert_states(samples), 9)


ALL_INPUTS = f"""{with_clause('request_log', 'cycles', 'error_counter')},
hours AS (SELECT DISTINCT {_bucket('1 hour')} AS h FROM request_log),
grid AS (SELECT unnest(generate_series((SELECT min(h) FROM hours), TIMESTAMP '2024-02-01 00:00:00', INTERVAL 1 HOUR)) AS ts),
ratio AS (SELECT {_bucket('6 hours')} AS ts, count(*) FILTER (WHERE status LIKE '5%') / CAST(count(*) AS DOUBLE) AS v
  FROM request_log GROUP BY 1),
lat AS (SELECT {_bucket('6 hours')} AS ts, count(*) AS n, {', '.join(
    f"count(*) FILTER (WHERE duration_s <= {b}) AS c{i}" for i, b in enumerate(timeseries.LATENCY_BOUNDS))}
  FROM request_log WHERE route LIKE '/predict%' GROUP BY 1),
steps AS (SELECT ts, value, lag(value) OVER (ORDER BY ts, value) AS before FROM error_counter),
grown AS (SELECT {_bucket('6 hours')} AS ts, CAST(sum(CASE WHEN value >= before THEN value - before ELSE coalesce(value - 0 * before, 0) END) AS DOUBLE) AS v
  FROM steps GROUP BY 1),
x AS (
  SELECT 'service' AS model_name, 'api_down' AS alert, 'critical' AS severity, 60 AS hold, ts, CASE WHEN h IS NULL THEN 0 ELSE 1 END AS v, h IS NULL AS hit
    FROM grid LEFT JOIN hours ON h = ts
  UNION ALL SELECT model_name, 'model_not_loaded', 'critical', 120, cycle_ts, CASE WHEN model_version IS NULL THEN 0 ELSE 1 END, model_version IS NULL FROM cycles
  UNION ALL SELECT 'service', 'high_error_rate', 'warning', 300, ts, v, v > 0.05 FROM ratio
  UNION ALL SELECT 'service', 'high_latency', 'warning', 300, ts, {quantile_sql(0.95)}, ({quantile_sql(0.95)}) > 0.5 FROM lat
  UNION ALL SELECT 'service', 'prediction_log_failing', 'warning', 0, ts, v, v > 0 FROM grown
  UNION ALL SELECT model_name, 'data_drift', 'warning', 0, cycle_ts, CASE WHEN drift_share >= 0.15 THEN 1 ELSE 0 END, drift_share >= 0.15 FROM cycles
  UNION ALL SELECT model_name, 'live_roc_auc_low', 'warning', 0, cycle_ts, live_auc, live_auc < 0.75 FROM cycles
  UNION ALL SELECT model_name, 'monitor_stale', 'warning', 0, TIMESTAMP '2024-02-01 00:00:00',
    date_sub('second', max(cycle_ts)::TIMESTAMP, TIMESTAMP '2024-02-01 00:00:00'), date_sub('second', max(cycle_ts)::TIMESTAMP, TIMESTAMP '2024-02-01 00:00:00') > 600
    FROM cycles GROUP BY model_name),
runs AS (SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY model_name, alert ORDER BY ts) AS run FROM x),
since AS (SELECT *, min(CASE WHEN hit THEN ts END) OVER (PARTITION BY model_name, alert, run) AS s FROM runs)"""


@query(
    "alert_states_all",
    f"""{ALL_INPUTS} SELECT model_name, alert, severity, CAST(ts AS TIMESTAMP) AS ts, round(CAST(v AS DOUBLE), 9) AS value,
  CASE WHEN NOT hit THEN 'inactive' WHEN date_sub('second', s, ts) >= hold THEN 'firing' ELSE 'pending' END AS state FROM since""",
)
def alert_states_all(spark: SparkSession, sf: str) -> DataFrame:
    """All eight alerts, from requests, the counter of errors and the cycles of every model."""
    requests, cycles, errors = (frame(spark, sf, v) for v in ("request_log", "cycles", "error_counter"))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    service = F.lit("service").alias("model_name")
    at = F.col("window_start").alias("ts")
    latency = timeseries.histogram_quantiles(
        requests.where("route LIKE '/predict%'"), "duration_s", timeseries.LATENCY_BOUNDS, {"value": 0.95}, "ts", "6 hours"
    )
    daily = cycles.withColumn("cycle_ts", F.col("cycle_ts").cast("timestamp_ntz"))
    gauges = timeseries.gauges_of_cycles(
        daily.withColumns({
            "model_loaded": F.col("model_version").isNotNull().cast("int"),
            "dataset_drift": (F.col("drift_share") >= 0.15).cast("int"),
            "live_roc_auc": F.col("live_auc"),
        }),
        ["model_loaded", "dataset_drift", "live_roc_auc"], "model_name", "cycle_ts",
    )
    parts = [
        timeseries.presence(requests, "ts", "1 hour", "up", until=now).select(service, "metric", "ts", "value"),
        timeseries.error_ratio(requests, "ts", "6 hours").select(
            service, F.lit("error_ratio").alias("metric"), at, F.col("ratio").alias("value")
        ),
        latency.select(service, F.lit("latency_p95").alias("metric"), at, "value"),
        timeseries.counter_increase(errors, "ts", "value", "6 hours").select(
            service, F.lit("log_errors_increase").alias("metric"), at, F.col("increase").alias("value")
        ),
        gauges.select("model_name", F.col("gauge").alias("metric"), F.col("cycle_ts").alias("ts"), "value"),
        timeseries.age_samples(
            daily.select("model_name", F.col("cycle_ts").alias("ts")), "monitor_age_seconds", now, ["model_name"]
        ),
    ]
    samples = reduce(DataFrame.unionByName, parts)
    return tidy(timeseries.alert_states(samples, by=["model_name"]), 9)
