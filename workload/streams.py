"""Streaming queries, run to completion over the given tables as files of a stream.

The tables arrive in several ranges of time, and after each the stream runs again from its
checkpoint. Each query writes its micro-batches to a fresh folder and returns what it holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.operators import timeseries
from tidewatch.session import work_dir, written
from tidewatch.sources.tables import LOG_COLUMNS, Workspace
from tidewatch.streaming import drift as stream_drift
from tidewatch.streaming import events, logsink, state
from workload.distributions import NUMERIC
from workload.lifecycle import CYCLES, statuses
from workload.log import FED, LABELED, LOG
from workload.registry import ORACLES, query, tidy
from workload.traffic import ORIGIN, REQ, quantile_sql
from workload.views import VIEWS, frame, frames


PARTS = 5


class Feed:
    """A table that reaches a stream in ranges of time, each with a run of the stream of its own.

    ``after`` are rows that come last, by themselves: a later event moves the watermark past
    all others.
    """

    def __init__(self, df: DataFrame, ts: str, after: DataFrame | None = None):
        spark = df.sparkSession
        at = F.unix_micros(F.col(ts).cast("timestamp"))
        span = df.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
        low, width = span["low"] or 0, max(1, (span["high"] or 0) - (span["low"] or 0) + 1)
        part = F.floor((at - low) * F.lit(PARTS) / F.lit(width)).cast("int")
        self.rows = [df.where(F.coalesce(part, F.lit(0)) == i) for i in range(PARTS)]
        self.rows += [after] if after is not None else []
        self.path = f"{work_dir(spark, 'feed')}/in"
        df.limit(0).write.parquet(self.path)
        self.stream = spark.readStream.schema(df.schema).parquet(self.path)

    def put(self, i: int) -> None:
        if i < len(self.rows):
            self.rows[i].write.mode("append").parquet(self.path)


def feed_of(spark: SparkSession, sf: str, table: str, ts: str) -> Feed:
    return Feed(frame(spark, sf, table), ts)


def view_of(spark: SparkSession, view: str, **feeds: Feed) -> DataFrame:
    """A view of the workload over streams instead of tables."""
    return spark.sql(VIEWS[view], **{name: feed.stream for name, feed in feeds.items()})


def drive(start: Callable[[], StreamingQuery], *feeds: Feed) -> None:
    """Run a stream to its end after every part of its inputs, from one checkpoint."""
    for i in range(max(len(f.rows) for f in feeds)):
        for feed in feeds:
            feed.put(i)
        start().awaitTermination()


def run_to_end(spark: SparkSession, stream: DataFrame, *feeds: Feed, mode: str = "append") -> DataFrame:
    base = work_dir(spark, "stream")
    drive(lambda: events.write_batches(stream, f"{base}/out", f"{base}/checkpoint", mode), *feeds)
    return spark.read.parquet(f"{base}/out")


@query(
    "stream_unique_predictions",
    f"{LOG} SELECT prediction_id, model_version, churn_prediction FROM prediction_log",
)
def stream_unique_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Every prediction sent twice, each kept once."""
    feed = feed_of(spark, sf, "events", "ts")
    log = view_of(spark, "prediction_log", events=feed)
    sent = log.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    kept = run_to_end(spark, events.unique_predictions(sent, "1 hour"), feed)
    return kept.select("prediction_id", "model_version", "churn_prediction")


@query(
    "stream_label_join",
    f"""{FED} SELECT p.prediction_id, p.model_version, f.actual, f.feedback_at FROM prediction_log p
JOIN feedback f ON f.prediction_id = p.prediction_id AND f.feedback_at >= p.created_at AND f.feedback_at <= p.created_at + INTERVAL '1' DAY""",
)
def stream_label_join(spark: SparkSession, sf: str) -> DataFrame:
    """The inner part of the label join; the outer part waits for the watermark."""
    feed = feed_of(spark, sf, "events", "ts")
    predictions, labels = (view_of(spark, v, events=feed) for v in ("prediction_log", "feedback"))
    predictions = predictions.select("prediction_id", "created_at", "model_version")  # state holds these alone
    joined = run_to_end(spark, events.join_labels(predictions, labels, "2 days", "'1' DAY", "inner"), feed)
    return joined.select(
        "prediction_id", "model_version", "actual", F.col("feedback_at").cast("timestamp_ntz").alias("feedback_at")
    )


@query(
    "stream_event_rate",
    f"""{LOG} SELECT time_bucket(INTERVAL '1 hour', created_at, {ORIGIN}) AS window_start, model_version, count(*) AS n,
  round(count(*) / CAST(3600 AS DOUBLE), 8) AS rate FROM prediction_log GROUP BY 1, 2""",
)
def stream_event_rate(spark: SparkSession, sf: str) -> DataFrame:
    feed = feed_of(spark, sf, "events", "ts")
    log = events.with_event_time(view_of(spark, "prediction_log", events=feed), "created_at", "1 hour")
    rates = timeseries.event_rate(log, "created_at", "1 hour", by=["model_version"])
    updates = run_to_end(spark, rates, feed, mode="update")
    final = events.latest_update(updates, ["window_start", "model_version"])
    return tidy(final.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), 8)


@query("stream_windowed_drift", ORACLES["windowed_drift"])
def stream_windowed_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly PSI of streamed line items against the reference period."""
    fitted = stream_drift.written_buckets(
        frame(spark, sf, "drift_reference"), NUMERIC, f"{work_dir(spark, 'fitted')}/buckets"
    )
    feed = feed_of(spark, sf, "lineitem", "l_shipdate")
    current = events.with_event_time(view_of(spark, "drift_current", lineitem=feed), "l_shipdate", "1 day")
    counts = stream_drift.window_bucket_counts(current, fitted, NUMERIC, "l_shipdate", "30 days")
    updates = run_to_end(spark, counts, feed, mode="update")
    final = events.latest_update(updates, ["window_start", "feature", "bucket"])
    found = stream_drift.finish_windows(final, fitted)
    return tidy(found.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query(
    "stream_debounce",
    f"""SELECT * FROM ({ORACLES['debounce']}) WHERE (model_name, cycle_ts) IN (SELECT (model_name, cycle_ts) FROM (
  {CYCLES} SELECT model_name, cycle_ts FROM cycles WHERE model_version IS NOT NULL AND run_id IS NOT NULL AND window_size >= 2))""",
)
def stream_debounce(spark: SparkSession, sf: str) -> DataFrame:
    """Stateful debounce of the evaluated cycles, which arrive in the order of time."""
    evaluated = statuses(spark, sf).where("status NOT IN ('no_model', 'insufficient_data')")
    cycles = written(evaluated.select("model_name", "cycle_ts", "triggered"), "cycles")  # every part reads them
    feed = Feed(cycles, "cycle_ts")
    fired = run_to_end(spark, state.debounce_stream(feed.stream, 2), feed)
    return fired.select("model_name", "cycle_ts", F.col("streak").cast("long"), "fire")


@query(
    "stream_log_append",
    f"""{LOG} SELECT prediction_id, created_at, model_version, round(churn_probability, 6) AS churn_probability,
  CAST(created_at AS DATE) AS created_date FROM prediction_log""",
)
def stream_log_append(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions, each sent twice, streamed into the log by a stream that loses its checkpoint.

    The second start runs every batch again, and the log holds each prediction once.
    """
    feed = feed_of(spark, sf, "events", "ts")
    log = view_of(spark, "prediction_log", events=feed)
    sent = log.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    base = work_dir(spark, "log")
    ws = Workspace(base)
    sink = logsink.log_sink(ws, "api")
    drive(lambda: events.start(sent, sink, f"{base}/first"), feed)
    events.start(sent, sink, f"{base}/second").awaitTermination()
    return tidy(
        ws.predictions(spark).select(
            "prediction_id", F.col("created_at").cast("timestamp_ntz").alias("created_at"),
            "model_version", "churn_probability", "created_date",
        )
    )


@query(
    "stream_labeled_log",
    f"""{LABELED} SELECT prediction_id, model_version, churn_prediction, coalesce(actual, -1) AS actual, feedback_at,
  CAST(created_at AS DATE) AS created_date FROM labeled""",
)
def stream_labeled_log(spark: SparkSession, sf: str) -> DataFrame:
    """All predictions with their last label: what the stream's join gives, then late labels.

    A last event far in the future lets the unmatched predictions out.
    """
    predictions, feedback = frames(spark, sf, "prediction_log", "feedback")
    predictions = predictions.select(*LOG_COLUMNS)  # what the labeled table keeps, and the state of the join
    feedback = written(feedback, "feedback")  # three scans of the events, which every part reads
    later = lambda column: (F.max(column) + F.expr("INTERVAL '100' DAY")).alias(column)
    end = F.lit(END).alias("prediction_id")
    p = Feed(predictions, "created_at", _only(predictions, predictions.agg(later("created_at")).select("*", end)))
    f = Feed(feedback, "feedback_at", _only(feedback, feedback.agg(later("feedback_at")).select("*", end)))
    base = work_dir(spark, "labeled")
    ws = Workspace(base)
    joined = events.join_labels(p.stream, f.stream, "1 day", "'1' HOUR")
    sink = logsink.labeled_sink(ws, "labels", F.col("prediction_id") != END)
    drive(lambda: events.start(joined, sink, f"{base}/checkpoint"), p, f)
    logsink.repair_labels(ws, predictions, feedback, "'1' HOUR", "repair")
    return ws.labeled(spark).select(
        "prediction_id", "model_version", "churn_prediction", F.coalesce("actual", F.lit(-1)).alias("actual"),
        F.col("feedback_at").cast("timestamp_ntz").alias("feedback_at"), "created_date",
    )


END = "~end"


def _only(like: DataFrame, rows: DataFrame) -> DataFrame:
    """Rows with the columns of another table, NULL where they have none."""
    return like.limit(0).unionByName(rows, allowMissingColumns=True).select(*like.columns)


HOURLY = f"time_bucket(INTERVAL '6 hours', ts, {ORIGIN}) - i * INTERVAL '6 hours'"


@query(
    "stream_error_ratio",
    f"""{REQ}, s AS (SELECT {HOURLY} AS window_start, status FROM request_log, (SELECT unnest(range(0, 4)) AS i))
SELECT window_start, count(*) AS n, count(*) FILTER (WHERE status LIKE '5%') AS n_failed,
  round(count(*) FILTER (WHERE status LIKE '5%') / CAST(count(*) AS DOUBLE), 6) AS ratio FROM s GROUP BY 1""",
)
def stream_error_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """Error ratio over the last day, every six hours, from counts kept per window."""
    feed = feed_of(spark, sf, "events", "ts")
    requests = events.with_event_time(view_of(spark, "request_log", events=feed), "ts", "1 hour")
    ratios = timeseries.error_ratio(requests, "ts", "1 day", "6 hours")
    final = events.latest_update(run_to_end(spark, ratios, feed, mode="update"), ["window_start"])
    return tidy(final.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


SLIDING = f"""s AS (SELECT {HOURLY} AS window_start, route, duration_s FROM request_log, (SELECT unnest(range(0, 4)) AS i)
  WHERE route LIKE '/predict%'),
b AS (SELECT window_start, route, count(*) AS n, {', '.join(
    f"count(*) FILTER (WHERE duration_s <= {b}) AS c{i}" for i, b in enumerate(timeseries.LATENCY_BOUNDS))} FROM s GROUP BY 1, 2)"""


@query(
    "stream_latency_quantile",
    f"""{REQ}, {SLIDING} SELECT window_start, route, n, round({quantile_sql(0.5)}, 9) AS p50, round({quantile_sql(0.95)}, 9) AS p95 FROM b""",
)
def stream_latency_quantile(spark: SparkSession, sf: str) -> DataFrame:
    """Latency quantiles over the last day, every six hours; state is one count per bucket."""
    feed = feed_of(spark, sf, "events", "ts")
    requests = events.with_event_time(view_of(spark, "request_log", events=feed), "ts", "1 hour")
    found = timeseries.histogram_quantiles(
        requests.where("route LIKE '/predict%'"), "duration_s", timeseries.LATENCY_BOUNDS,
        {"p50": 0.5, "p95": 0.95}, "ts", "1 day", "6 hours", ["route"],
    )
    final = events.latest_update(run_to_end(spark, found, feed, mode="update"), ["window_start", "route"])
    return tidy(final.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")), 9)
