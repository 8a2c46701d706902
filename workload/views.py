"""Relations derived from the given tables, as SQL text that Spark and DuckDB both run.

Each entry names the views and tables it reads in braces; :func:`frame` builds it in Spark
and :func:`with_clause` spells the same chain as common table expressions.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

CUTOFF = "TIMESTAMP '2000-08-01 00:00:00'"

VIEWS = {
    # One row per customer at a cutoff date; churned = no later order. Line items are
    # summed per order before they meet the orders, which halves the join and removes skew.
    "customer_features": f"""
        SELECT c_custkey AS customer_id,
          CAST(tenure AS INT) AS tenure_months,
          round(coalesce(spend, 0) / 1000 / greatest(tenure, 1), 2) AS monthly_charges,
          round(spend / 1000, 2) AS total_charges,
          CAST(coalesce(urgent, 0) AS INT) AS num_support_tickets,
          round(avg_qty, 1) AS avg_monthly_gb,
          CAST(c_acctbal < 0 AS INT) AS senior_citizen,
          CAST(c_nationkey % 2 AS INT) AS paperless_billing,
          CAST(coalesce(high_prio, 0) AS INT) AS has_tech_support,
          CASE WHEN c_mktsegment IN ('BUILDING','FURNITURE') THEN 'month_to_month'
               WHEN c_mktsegment = 'MACHINERY' THEN 'two_year' ELSE 'one_year' END AS contract_type,
          CASE WHEN n_regionkey IN (0, 1) THEN 'dsl' WHEN n_regionkey IN (2, 3) THEN 'fiber_optic'
               ELSE 'none' END AS internet_service,
          CASE c_nationkey % 4 WHEN 0 THEN 'electronic_check' WHEN 1 THEN 'mailed_check'
               WHEN 2 THEN 'bank_transfer' ELSE 'credit_card' END AS payment_method,
          CAST(coalesce(later, 0) = 0 AS INT) AS churned
        FROM (
          SELECT c.*, n.n_regionkey, o.spend, o.urgent, o.high_prio, o.later, q.avg_qty,
            coalesce(24008 - (CAST(extract(year FROM o.first_order) AS INT) * 12
              + CAST(extract(month FROM o.first_order) AS INT)), 0) AS tenure
          FROM {{customer}} c JOIN {{nation}} n ON c.c_nationkey = n.n_nationkey
          LEFT JOIN (
            SELECT o_custkey,
              min(CASE WHEN o_orderdate < {CUTOFF} THEN o_orderdate END) AS first_order,
              sum(CASE WHEN o_orderdate < {CUTOFF} THEN o_totalprice END) AS spend,
              sum(CASE WHEN o_orderdate < {CUTOFF} AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS urgent,
              max(CASE WHEN o_orderdate < {CUTOFF} AND o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS high_prio,
              sum(CASE WHEN o_orderdate >= {CUTOFF} THEN 1 ELSE 0 END) AS later
            FROM {{orders}} GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
          LEFT JOIN (
            SELECT o_custkey, sum(qty) / sum(lines) AS avg_qty
            FROM {{orders}} JOIN (
              SELECT l_orderkey, sum(l_quantity) AS qty, count(*) AS lines
              FROM {{lineitem}} GROUP BY l_orderkey) s ON l_orderkey = o_orderkey
            WHERE o_orderdate >= TIMESTAMP '1998-01-01 00:00:00' AND o_orderdate < {CUTOFF}
            GROUP BY o_custkey) q ON q.o_custkey = c.c_custkey) b""",
    # The same table with every kind of contract violation written into some of its rows.
    "dirty_customers": """
        SELECT CASE WHEN customer_id % 97 = 0 THEN customer_id - 1 ELSE customer_id END AS customer_id,
          CASE WHEN customer_id % 50 = 0 THEN 500 ELSE tenure_months END AS tenure_months,
          CASE WHEN customer_id % 60 = 0 THEN CAST(-5 AS DOUBLE) ELSE monthly_charges END AS monthly_charges,
          CASE WHEN customer_id % 2 = 0 THEN NULL ELSE total_charges END AS total_charges,
          CASE WHEN customer_id % 70 = 0 THEN 'many' WHEN customer_id % 71 = 0 THEN '3d'
               WHEN customer_id % 73 = 0 THEN ' 4 ' WHEN customer_id % 79 = 0 THEN 'NaN'
               WHEN customer_id % 83 = 0 THEN '2.5'
               ELSE CAST(num_support_tickets AS STRING) END AS num_support_tickets,
          avg_monthly_gb,
          CASE WHEN customer_id % 80 = 0 THEN 2 ELSE senior_citizen END AS senior_citizen,
          paperless_billing, has_tech_support,
          CASE WHEN customer_id % 30 = 0 THEN 'weekly_' || CAST(customer_id % 7 AS STRING)
               ELSE contract_type END AS contract_type,
          internet_service,
          CASE WHEN customer_id % 33 = 0 THEN NULL ELSE payment_method END AS payment_method,
          CASE WHEN customer_id % 67 = 0 THEN 3 WHEN customer_id % 61 = 0 THEN NULL ELSE churned END AS churned
        FROM {customer_features}""",
    "prediction_log": """
        SELECT 'p' || CAST(event_id AS STRING) AS prediction_id, ts AS created_at, 'm' AS model_name,
          CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN '1' ELSE '2' END AS model_version,
          props AS features, user_id, event_type,
          value / (value + 25) AS churn_probability,
          CAST(value / (value + 25) >= 0.35 AS INT) AS churn_prediction
        FROM {events}""",
    # A batch to load: everything, with the errors sent a second time a minute later.
    "incoming_batch": """
        SELECT * FROM {prediction_log}
        UNION ALL
        SELECT prediction_id, created_at + INTERVAL '1' MINUTE AS created_at, model_name, model_version,
          features, user_id, event_type, churn_probability, churn_prediction
        FROM {prediction_log} WHERE event_type = 'error'""",
    # Late labels, some corrected an hour later, some for ids that were never logged.
    "feedback": """
        SELECT 'p' || CAST(event_id AS STRING) AS prediction_id, CAST(event_type = 'purchase' AS INT) AS actual,
          ts + CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) * INTERVAL '1' MINUTE AS feedback_at
        FROM {events} WHERE event_type IN ('purchase', 'error')
        UNION ALL
        SELECT 'p' || CAST(event_id AS STRING), 0,
          ts + (CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) + 60) * INTERVAL '1' MINUTE
        FROM {events} WHERE event_type = 'purchase' AND user_id % 5 = 0
        UNION ALL
        SELECT 'x' || CAST(event_id AS STRING), 1, ts FROM {events} WHERE event_type = 'signup'""",
    "request_log": """
        SELECT ts, 'POST' AS method,
          CASE event_type WHEN 'signup' THEN '/feedback' WHEN 'click' THEN '/predict/batch' ELSE '/predict' END AS route,
          CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status, value / 100 AS duration_s
        FROM {events}""",
    # Errors so far as a counter that starts again every day.
    "error_counter": """
        SELECT ts, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (
          PARTITION BY CAST(ts AS DATE) ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
        FROM {events}""",
    "scored_docs": """
        SELECT d.doc_id, d.lang, d.source, d.n_chars / (d.n_chars + CAST(2000 AS DOUBLE)) AS churn_probability,
          d.n_chars / (d.n_chars + CAST(500 AS DOUBLE)) AS challenger_probability,
          l.quality AS actual
        FROM {documents} d LEFT JOIN {labels} l ON l.doc_id = d.doc_id""",
    "drift_reference": """
        SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(l_quantity > 25 AS INT) AS bulk,
          l_returnflag, l_linestatus, l_shipdate
        FROM {lineitem} WHERE l_shipdate < TIMESTAMP '1998-06-01 00:00:00'""",
    "drift_current": """
        SELECT l_quantity, l_extendedprice * CAST(1.3 AS DOUBLE) AS l_extendedprice, l_discount, l_tax,
          CAST(l_quantity > 25 AS INT) AS bulk, l_returnflag, l_linestatus, l_shipdate
        FROM {lineitem} WHERE l_shipdate >= TIMESTAMP '1998-06-01 00:00:00'""",
    # A registry with one model per customer and one version per order.
    "model_versions": """
        SELECT 'm' || CAST(o_custkey AS STRING) AS model_name, o_orderkey AS version,
          CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'r' || CAST(o_orderkey AS STRING) END AS run_id,
          'READY' AS status, o_orderdate AS created_at
        FROM {orders}""",
    "alias_events": """
        SELECT 'm' || CAST(o_custkey AS STRING) AS model_name, 'challenger' AS alias, o_orderkey AS version,
          o_orderdate AS event_ts FROM {orders}
        UNION ALL
        SELECT 'm' || CAST(o_custkey AS STRING), 'champion', o_orderkey, o_orderdate
        FROM {orders} WHERE o_orderstatus = 'F'""",
    "version_tags": """
        SELECT 'm' || CAST(o_custkey AS STRING) AS model_name, o_orderkey AS version,
          'promotion.decision' AS key, CASE o_orderstatus WHEN 'F' THEN 'promoted' ELSE 'rejected' END AS value,
          o_orderdate AS event_ts
        FROM {orders} WHERE o_orderstatus IN ('F', 'O')
        UNION ALL
        SELECT 'm' || CAST(o_custkey AS STRING), o_orderkey, 'promotion.reason', o_orderpriority, o_orderdate
        FROM {orders}""",
    "model_uris": """
        SELECT CASE o_orderstatus WHEN 'F' THEN 'models:/m' || CAST(o_custkey AS STRING) || '@champion'
                 WHEN 'O' THEN 'models:/m' || CAST(o_custkey AS STRING) || '/' || CAST(o_orderkey AS STRING)
                 ELSE 'runs:/' || CAST(o_orderkey AS STRING) END AS uri
        FROM {orders}""",
    # Metrics of a challenger and a champion per model, one model per supplier.
    "gate_metrics": """
        SELECT 's' || CAST(l_suppkey AS STRING) AS model_name,
          0.5 + avg(l_quantity) / 100 AS challenger_auc,
          CAST(0.2 AS DOUBLE) + avg(l_discount) * 5.5 AS challenger_f1,
          CASE WHEN l_suppkey % 5 = 0 THEN NULL WHEN l_suppkey % 7 = 0 THEN CAST('NaN' AS DOUBLE)
            ELSE 0.5 + avg(CASE WHEN l_returnflag = 'A' THEN l_quantity END) / 100 END AS champion_auc
        FROM {lineitem} GROUP BY l_suppkey""",
    # One monitoring cycle per model (user) and day.
    "cycles": """
        SELECT 'm' || CAST(user_id AS STRING) AS model_name, CAST(ts AS DATE) AS cycle_ts,
          CASE WHEN user_id % 11 = 0 THEN NULL WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN '1' ELSE '2' END AS model_version,
          CASE WHEN user_id % 13 = 0 THEN NULL ELSE 'r' || CAST(user_id AS STRING) END AS run_id,
          count(*) AS window_size,
          avg(CASE WHEN value > 40 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS drift_share,
          max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS error_seen,
          max(CASE WHEN value > 90 THEN 1 ELSE 0 END) AS large_seen,
          avg(value) / (avg(value) + 12) AS live_auc
        FROM {events} GROUP BY 1, 2, 3, 4""",
}

_NAME = re.compile(r"\{(\w+)\}")


def _reads(text: str) -> list[str]:
    return list(dict.fromkeys(_NAME.findall(text)))


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or view as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = VIEWS[name].replace("{{", "{").replace("}}", "}")
    inputs = {n: frame(spark, sf_dir, n) for n in _reads(text)}
    return spark.sql(text, **inputs)


def frames(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [frame(spark, sf_dir, n) for n in names]


def _chain(name: str, seen: list[str]) -> list[str]:
    if name in TABLES or name in seen:
        return seen
    for inner in _reads(VIEWS[name].replace("{{", "{").replace("}}", "}")):
        seen = _chain(inner, seen)
    return [*seen, name]


def with_clause(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` for the views and everything they read."""
    order = reduce(lambda seen, n: _chain(n, seen), names, [])
    parts = [
        f"{n} AS ({_NAME.sub(lambda m: m.group(1), VIEWS[n].replace('{{', '{').replace('}}', '}'))})"
        for n in order
    ]
    return "WITH " + ",\n".join(parts)
