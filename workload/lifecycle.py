"""Registry state, decisions and monitoring cycles, for many models at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.operators import decisions, registry, timeseries
from tidewatch.operators.cycles import cycle_payload, latest_cycle
from workload.registry import ORACLES, query, tidy
from workload.views import frame, frames, with_clause

GATE = with_clause("gate_metrics")
REG = with_clause("model_versions", "alias_events", "version_tags", "model_uris")
CYCLES = with_clause("cycles")
ALIASES = """cur AS (SELECT model_name, alias, version, event_ts AS moved_at FROM (SELECT *, row_number() OVER (
  PARTITION BY model_name, alias ORDER BY event_ts DESC, version DESC) AS rn FROM alias_events) WHERE rn = 1)"""
NOTES = """notes AS (SELECT model_name, version, max(value) FILTER (WHERE key = 'promotion.decision') AS decision,
  max(value) FILTER (WHERE key = 'promotion.reason') AS reason FROM version_tags GROUP BY 1, 2)"""
NOW = "TIMESTAMP '2001-12-31 00:00:00'"


@query(
    "promotion_gate",
    f"""{GATE}, g AS (SELECT *, CASE WHEN challenger_auc < 0.75 OR challenger_f1 < 0.45 THEN 'failed_gate'
  WHEN champion_auc IS NULL THEN 'no_champion' WHEN isnan(champion_auc) THEN 'champion_unscored'
  WHEN challenger_auc >= champion_auc + 0.01 THEN 'better' ELSE 'not_better' END AS outcome FROM gate_metrics)
SELECT model_name, outcome, outcome IN ('no_champion', 'champion_unscored', 'better') AS promote,
  concat_ws(',', CASE WHEN challenger_f1 < 0.45 THEN 'f1' END, CASE WHEN challenger_auc < 0.75 THEN 'roc_auc' END) AS failed_gates,
  round(challenger_auc, 6) AS challenger_score,
  CASE WHEN outcome IN ('better', 'not_better') THEN round(champion_auc, 6) END AS champion_score FROM g""",
)
def promotion_gate(spark: SparkSession, sf: str) -> DataFrame:
    pairs = frame(spark, sf, "gate_metrics").select(
        "model_name",
        F.create_map(
            F.lit("roc_auc"), "challenger_auc", F.lit("f1"), "challenger_f1"
        ).alias("challenger"),
        F.when(
            F.col("champion_auc").isNotNull(), F.create_map(F.lit("roc_auc"), "champion_auc")
        ).alias("champion"),
    )
    decided = decisions.promotion_gate(pairs)
    return tidy(
        decided.select("model_name", "outcome", "promote", "failed_gates", "challenger_score", "champion_score")
    )


@query(
    "registry_list",
    f"""{REG}, {ALIASES}, {NOTES}, names AS (SELECT model_name, version, string_agg(alias, ',' ORDER BY alias) AS aliases FROM cur GROUP BY 1, 2)
SELECT v.model_name, v.version, coalesce(aliases, '') AS aliases, run_id, status, coalesce(decision, '') AS decision, coalesce(reason, '') AS reason
FROM model_versions v LEFT JOIN names USING (model_name, version) LEFT JOIN notes USING (model_name, version)""",
)
def registry_list(spark: SparkSession, sf: str) -> DataFrame:
    listing = registry.list_versions(*frames(spark, sf, "model_versions", "alias_events", "version_tags"))
    return tidy(listing)


@query("current_aliases", f"{REG}, {ALIASES} SELECT * FROM cur")
def current_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return registry.current_aliases(frame(spark, sf, "alias_events"))


@query(
    "resolve_alias",
    f"""{REG}, {ALIASES}, parts AS (SELECT uri, nullif(regexp_extract(uri, '^models:/([^/@]+)[@/]', 1), '') AS model_name,
  nullif(regexp_extract(uri, '^models:/[^/@]+@([^/]+)$', 1), '') AS alias,
  TRY_CAST(nullif(regexp_extract(uri, '^models:/[^/@]+/(\\d+)$', 1), '') AS BIGINT) AS fixed FROM model_uris),
p AS (SELECT uri, parts.model_name, coalesce(fixed, cur.version) AS version FROM parts LEFT JOIN cur ON cur.model_name = parts.model_name AND cur.alias = parts.alias)
SELECT uri, p.model_name, coalesce(v.version, -1) AS version, run_id,
  CASE WHEN p.model_name IS NULL THEN uri WHEN v.version IS NOT NULL THEN 'models:/' || p.model_name || '/' || CAST(v.version AS VARCHAR) END AS resolved_uri
FROM p LEFT JOIN model_versions v ON v.model_name = p.model_name AND v.version = p.version""",
)
def resolve_alias(spark: SparkSession, sf: str) -> DataFrame:
    uris, events, versions = frames(spark, sf, "model_uris", "alias_events", "model_versions")
    found = registry.resolve_uris(uris, events, versions)
    return found.withColumn("version", F.coalesce("version", F.lit(-1)).cast("long"))


@query(
    "rollback_target",
    f"""{REG}, {ALIASES}, {NOTES}, now AS (SELECT model_name, version AS current_version FROM cur WHERE alias = 'champion')
SELECT now.model_name, current_version, coalesce(max(n.version), -1) AS target_version FROM now LEFT JOIN notes n
  ON n.model_name = now.model_name AND n.decision = 'promoted' AND n.version < current_version GROUP BY 1, 2""",
)
def rollback_target(spark: SparkSession, sf: str) -> DataFrame:
    versions, events, tags = frames(spark, sf, "model_versions", "alias_events", "version_tags")
    found = registry.rollback_targets(versions, events, tags, "champion")
    return found.withColumn("target_version", F.coalesce("target_version", F.lit(-1)))


@query(
    "cooldown",
    f"""{REG} SELECT model_name, max(created_at) AS newest_at,
  round(date_diff('second', max(created_at), {NOW}) / CAST(60 AS DOUBLE), 4) AS minutes FROM model_versions GROUP BY 1""",
)
def cooldown(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit("2001-12-31 00:00:00").cast("timestamp_ntz")
    return tidy(registry.minutes_since_newest(frame(spark, sf, "model_versions"), now), 4)


GUARDS = decisions.RetrainPolicy(min_labeled=40, cooldown_minutes=60.0 * 24 * 400)


@query(
    "retrain_guards",
    f"""{with_clause('model_versions', 'alias_events', 'version_tags', 'cycles')}, {ALIASES},
newest AS (SELECT model_name, date_diff('second', max(created_at), {NOW}) / CAST(60 AS DOUBLE) AS minutes FROM model_versions GROUP BY 1),
labels AS (SELECT model_name, sum(window_size) AS n FROM cycles GROUP BY 1),
s AS (SELECT n.model_name, minutes, c.version, v.run_id, coalesce(l.n, 0) AS n_labeled FROM newest n
  LEFT JOIN cur c ON c.model_name = n.model_name AND c.alias = 'champion'
  LEFT JOIN model_versions v ON v.model_name = c.model_name AND v.version = c.version
  LEFT JOIN labels l ON l.model_name = n.model_name)
SELECT model_name, CAST(n_labeled AS BIGINT) AS n_labeled, CASE WHEN minutes < {60.0 * 24 * 400} THEN 'cooldown' WHEN version IS NULL THEN 'no_champion'
  WHEN run_id IS NULL THEN 'champion_without_run' WHEN n_labeled < 40 THEN 'too_few_labels' ELSE 'none' END AS guard FROM s""",
)
def retrain_guards(spark: SparkSession, sf: str) -> DataFrame:
    versions, events, cycles = frames(spark, sf, "model_versions", "alias_events", "cycles")
    now = F.lit("2001-12-31 00:00:00").cast("timestamp_ntz")
    newest = registry.minutes_since_newest(versions, now).select(
        "model_name", F.col("minutes").alias("minutes_since_newest")
    )
    champion = (
        registry.current_aliases(events)
        .where("alias = 'champion'")
        .join(versions, ["model_name", "version"], "left")
        .select(
            "model_name",
            F.col("version").alias("champion_version"),
            F.col("run_id").alias("champion_run_id"),
        )
    )
    labels = cycles.groupBy("model_name").agg(F.sum("window_size").alias("n_labeled"))
    states = newest.join(champion, "model_name", "left").join(labels, "model_name", "left")
    guarded = decisions.retrain_guards(states, GUARDS)
    return guarded.select(
        "model_name",
        F.coalesce("n_labeled", F.lit(0)).alias("n_labeled"),
        F.coalesce("guard", F.lit("none")).alias("guard"),
    )


POLICY = decisions.MonitorPolicy(min_window=2)
STATUS = """st AS (SELECT *, model_version IS NULL OR run_id IS NULL AS nomodel, drift_share >= 0.15 AS drifted, live_auc < 0.75 AS weak FROM cycles),
status AS (SELECT *, CASE WHEN nomodel THEN 'no_model' WHEN window_size < 2 THEN 'insufficient_data' WHEN weak THEN 'degraded'
  WHEN drifted THEN 'drift' ELSE 'ok' END AS status,
  CASE WHEN nomodel OR window_size < 2 THEN 0 ELSE drifted::INT + weak::INT END AS n_reasons FROM st)"""


def statuses(spark: SparkSession, sf: str) -> DataFrame:
    cycles = frame(spark, sf, "cycles").withColumns(
        {
            "drifted_features": F.expr(
                "array_compact(array(IF(large_seen = 1, 'monthly_charges', NULL), IF(error_seen = 1, 'num_support_tickets', NULL)))"
            ),
            "live": F.create_map(F.lit("roc_auc"), "live_auc"),
        }
    )
    return decisions.cycle_status(cycles, POLICY)


@query(
    "cycle_status",
    f"{CYCLES}, {STATUS} SELECT model_name, cycle_ts, status, n_reasons, n_reasons > 0 AS triggered FROM status",
)
def cycle_status(spark: SparkSession, sf: str) -> DataFrame:
    found = statuses(spark, sf)
    return found.select(
        "model_name", "cycle_ts", "status", F.size("retrain_reasons").alias("n_reasons"), "triggered"
    )


@query(
    "debounce",
    f"""{CYCLES}, {STATUS}, c AS (SELECT *, NOT nomodel AND window_size >= 2 AS counted, n_reasons > 0 AS hit FROM status),
runs AS (SELECT *, sum(CASE WHEN counted AND NOT hit THEN 1 ELSE 0 END) OVER (PARTITION BY model_name ORDER BY cycle_ts) AS run FROM c),
pos AS (SELECT *, sum(CASE WHEN counted AND hit THEN 1 ELSE 0 END) OVER (PARTITION BY model_name, run ORDER BY cycle_ts) AS p FROM runs)
SELECT model_name, cycle_ts, CAST(CASE WHEN counted AND hit THEN (p - 1) % 2 + 1 ELSE 0 END AS BIGINT) AS streak, counted AND hit AND p % 2 = 0 AS fire FROM pos""",
)
def debounce(spark: SparkSession, sf: str) -> DataFrame:
    evaluated = statuses(spark, sf).withColumn(
        "evaluated", ~F.col("status").isin("no_model", "insufficient_data")
    )
    fired = decisions.debounce(evaluated, 2, evaluated="evaluated")
    return fired.select("model_name", "cycle_ts", F.col("streak").cast("long"), "fire")


@query(
    "cycle_report",
    f"""{CYCLES}, {STATUS}, l AS (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY cycle_ts DESC) AS rn FROM status)
SELECT model_name, cycle_ts AS at, status, window_size, round(drift_share, 6) AS drift_share, n_reasons FROM l WHERE rn = 1""",
)
def cycle_report(spark: SparkSession, sf: str) -> DataFrame:
    """The latest report of each model, written to JSON and read back."""
    reports = statuses(spark, sf).select(
        "model_name", "cycle_ts", cycle_payload(["status", "window_size", "drift_share", "retrain_reasons"]).alias("payload")
    )
    last = latest_cycle(reports, "cycle_ts")
    parsed = last.withColumn(
        "p",
        F.from_json(
            "payload", "status string, window_size long, drift_share double, retrain_reasons array<string>"
        ),
    )
    return tidy(
        parsed.select(
            "model_name",
            F.col("cycle_ts").alias("at"),
            "p.status",
            "p.window_size",
            "p.drift_share",
            F.size("p.retrain_reasons").alias("n_reasons"),
        )
    )


@query(
    "latest_gauges",
    f"""{CYCLES}, {STATUS}, long AS (SELECT model_name, cycle_ts, 'window_size' AS gauge, CAST(window_size AS DOUBLE) AS v FROM status
  UNION ALL SELECT model_name, cycle_ts, 'drift_share', drift_share FROM status
  UNION ALL SELECT model_name, cycle_ts, 'live_roc_auc', live_auc FROM status
  UNION ALL SELECT model_name, cycle_ts, 'champion_version', TRY_CAST(model_version AS DOUBLE) FROM status),
r AS (SELECT *, row_number() OVER (PARTITION BY model_name, gauge ORDER BY cycle_ts DESC) AS rn FROM long WHERE v IS NOT NULL)
SELECT model_name, gauge, round(v, 6) AS value, cycle_ts AS at FROM r WHERE rn = 1""",
)
def latest_gauges(spark: SparkSession, sf: str) -> DataFrame:
    cycles = statuses(spark, sf).withColumns(
        {"live_roc_auc": F.col("live_auc"), "champion_version": F.col("model_version").try_cast("double")}
    )
    long = timeseries.gauges_of_cycles(
        cycles, ["window_size", "drift_share", "live_roc_auc", "champion_version"], "model_name", "cycle_ts"
    )
    return tidy(timeseries.latest_gauges(long, ["model_name"], "cycle_ts"))


@query(
    "retrain_outcomes",
    f"""WITH streaks AS ({ORACLES['debounce']}), o AS (
  {CYCLES} SELECT cycles.model_name, window_size, streak,
    CASE WHEN model_version IS NULL THEN 'no_champion' WHEN run_id IS NULL THEN 'champion_without_run' WHEN window_size < 2 THEN 'too_few_labels' END AS guard,
    CASE WHEN error_seen = 1 THEN 'error' END AS error, live_auc >= 0.8 AS promoted
  FROM cycles JOIN streaks USING (model_name, cycle_ts)),
s AS (SELECT *, CASE WHEN guard IS NOT NULL THEN 'skipped' WHEN streak < 2 THEN 'pending' WHEN error IS NOT NULL THEN 'failed'
  WHEN promoted THEN 'promoted' ELSE 'rejected' END AS status,
  CASE WHEN guard IS NOT NULL THEN guard WHEN streak < 2 THEN CAST(streak AS VARCHAR) || ' of 2 consecutive triggered cycles'
  WHEN error IS NOT NULL THEN error ELSE 'by score' END AS reason FROM o)
SELECT model_name, status, reason, count(*) AS n, CAST(sum(window_size) AS BIGINT) AS n_holdout FROM s GROUP BY 1, 2, 3""",
)
def retrain_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What came of an attempt at every cycle, counted by model, status and reason."""
    evaluated = statuses(spark, sf).withColumn("evaluated", ~F.col("status").isin("no_model", "insufficient_data"))
    guards = {"no_champion": "model_version IS NULL", "champion_without_run": "run_id IS NULL", "too_few_labels": "window_size < 2"}
    guard = F.coalesce(*[F.when(F.expr(test), F.lit(name)) for name, test in guards.items()])
    attempts = decisions.debounce(evaluated, 2, evaluated="evaluated").select(
        "model_name", guard.alias("guard"), "streak", F.lit(2).alias("required"),
        F.col("retrain_reasons").alias("trigger_reasons"), F.when(F.col("error_seen") == 1, "error").alias("error"),
        (F.col("live_auc") >= 0.8).alias("promoted"), F.lit("by score").alias("decision"),
        F.lit(0).alias("n_fresh_train"), F.lit(0).alias("n_reference"), F.col("window_size").alias("n_holdout"),
    )
    counts = decisions.outcome_counts(decisions.retrain_outcomes(attempts), ["model_name", "reason"])
    return counts.groupBy("model_name", "status", "reason").agg(F.sum("n").alias("n"), F.sum("n_holdout").alias("n_holdout"))
