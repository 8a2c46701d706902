"""Queries over the customer feature table: contract, features, splits, scoring."""

from __future__ import annotations

from math import exp

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.contract import CHURN
from tidewatch.functions.columns import decide_class, sigmoid
from tidewatch.operators import drift, features, sampling, validation
from tidewatch.operators.importance import permutation_importance as importance_of
from tidewatch.operators.lineage import dataset_digest
from tidewatch.operators.quantiles import exact_median
from tidewatch.session import work_dir
from tidewatch.sources import synthetic, tables
from workload.registry import query, tidy, u
from workload.views import frame, with_clause

CLEAN = with_clause("customer_features")
DIRTY = with_clause("dirty_customers")
NUMBER = r"'^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)\s*$'"
TICKETS = (
    f"CASE WHEN regexp_matches(num_support_tickets, {NUMBER}) "
    "THEN TRY_CAST(trim(num_support_tickets) AS DOUBLE) END"
)
RANGES = {
    "tenure_months": (0, 120, False),
    "monthly_charges": (0, 500, False),
    "total_charges": (0, 60000, True),
    "num_support_tickets": (0, 100, False),
    "avg_monthly_gb": (0, 5000, True),
}
BINARIES = ("senior_citizen", "paperless_billing", "has_tech_support")
DOMAINS = {
    "contract_type": ("month_to_month", "one_year", "two_year"),
    "internet_service": ("dsl", "fiber_optic", "none"),
    "payment_method": ("electronic_check", "mailed_check", "bank_transfer", "credit_card"),
}


def _contract_oracle() -> str:
    """The checks one by one, each as its own scan."""
    rows = []

    def row(column: str, check: str, test: str, when: str = "n > 0", message: str = "NULL") -> None:
        rows.append(
            f"SELECT '{column}' AS \"column\", '{check}' AS check_name, 'error' AS severity, n, "
            f"{message} AS examples FROM (SELECT count(*) FILTER (WHERE {test}) AS n, "
            f"count(*) AS total FROM d) WHERE {when}"
        )

    for name, (low, high, optional) in RANGES.items():
        value = "tix" if name == "num_support_tickets" else name
        if optional:
            row(name, "missing_fraction", f"{name} IS NULL", "n > 0.2 * total")
        else:
            row(name, "not_null", f"{name} IS NULL")
        row(name, "dtype", f"{name} IS NOT NULL AND {value} IS NULL")
        row(name, "range", f"{value} < {low} OR {value} > {high}")
    for name in BINARIES:
        row(name, "not_null", f"{name} IS NULL")
        row(name, "binary", f"{name} NOT IN (0, 1)")
    for name, domain in DOMAINS.items():
        words = ", ".join(f"'{w}'" for w in domain)
        row(name, "not_null", f"{name} IS NULL")
        rows.append(
            f"SELECT '{name}', 'categories', 'error', count(DISTINCT {name}), "
            f"array_to_string(list_sort(list(DISTINCT {name}))[1:5], ', ') "
            f"FROM d WHERE {name} NOT IN ({words}) HAVING count(*) > 0"
        )
    body = "\nUNION ALL\n".join(rows)
    return f"{DIRTY}, d AS (SELECT *, {TICKETS} AS tix FROM dirty_customers)\n{body}"


@query("validate_contract", _contract_oracle())
def validate_contract(spark: SparkSession, sf: str) -> DataFrame:
    issues = validation.check_features(frame(spark, sf, "dirty_customers"))
    examples = F.when(
        F.col("check_name") == "categories", F.regexp_replace("message", "^unknown: ", "")
    )
    return issues.select("column", "check_name", "severity", "n", examples.alias("examples"))


@query(
    "validate_target",
    f"""{DIRTY}
SELECT 'churned' AS "column", 'not_null' AS check_name, 'error' AS severity, count(*) AS n
FROM dirty_customers WHERE churned IS NULL HAVING count(*) > 0
UNION ALL
SELECT 'churned', 'binary', 'error', count(*) FROM dirty_customers WHERE churned NOT IN (0, 1) HAVING count(*) > 0
UNION ALL
SELECT 'customer_id', 'unique', 'warning', count(*) - count(DISTINCT customer_id)
FROM dirty_customers HAVING count(*) > count(DISTINCT customer_id)""",
)
def validate_target(spark: SparkSession, sf: str) -> DataFrame:
    found = validation.check_target(frame(spark, sf, "dirty_customers"))
    return found.drop("message")


@query(
    "coerce_types",
    f"""{DIRTY}
SELECT customer_id, CAST(tenure_months AS DOUBLE) AS tenure_months, monthly_charges, total_charges,
  {TICKETS} AS num_support_tickets, avg_monthly_gb, CAST(senior_citizen AS DOUBLE) AS senior_citizen,
  CAST(paperless_billing AS DOUBLE) AS paperless_billing, CAST(has_tech_support AS DOUBLE) AS has_tech_support,
  contract_type, internet_service, payment_method
FROM dirty_customers""",
)
def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    return validation.coerce_types(frame(spark, sf, "dirty_customers")).drop("churned")


def _violations_sql() -> str:
    cells = []
    for name, (low, high, optional) in RANGES.items():
        value = "tix" if name == "num_support_tickets" else name
        if not optional:
            cells.append(f"CASE WHEN {name} IS NULL THEN '{name}:missing' END")
        if name == "num_support_tickets":
            cells.append(f"CASE WHEN {name} IS NOT NULL AND tix IS NULL THEN '{name}:type' END")
        if name in ("tenure_months", "num_support_tickets"):
            cells.append(f"CASE WHEN {value} <> floor({value}) THEN '{name}:integer' END")
        cells.append(f"CASE WHEN {value} < {low} OR {value} > {high} THEN '{name}:range' END")
    for name in BINARIES:
        cells.append(f"CASE WHEN {name} NOT IN (0, 1) THEN '{name}:binary' END")
    for name, domain in DOMAINS.items():
        words = ", ".join(f"'{w}'" for w in domain)
        cells.append(f"CASE WHEN {name} IS NULL THEN '{name}:missing' END")
        cells.append(f"CASE WHEN {name} NOT IN ({words}) THEN '{name}:category' END")
    return f"concat_ws(',', {', '.join(cells)})"


@query(
    "quarantine_rows",
    f"""{DIRTY}, d AS (SELECT *, {TICKETS} AS tix FROM dirty_customers),
v AS (SELECT customer_id, {_violations_sql()} AS violations FROM d)
SELECT customer_id, violations, violations = '' AS accepted FROM v""",
)
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    checked = validation.quarantine(frame(spark, sf, "dirty_customers"))
    return tidy(checked.select("customer_id", "violations", "accepted"))


@query(
    "engineer_features",
    f"""{CLEAN}, p AS (SELECT quantile_cont(monthly_charges, 0.5) AS price FROM customer_features)
SELECT customer_id,
  round(coalesce(total_charges, CAST(tenure_months AS DOUBLE) * monthly_charges), 6) AS total_charges,
  round(num_support_tickets / (tenure_months / CAST(12 AS DOUBLE) + 1), 6) AS tickets_per_tenure_year,
  round(monthly_charges / greatest(price, CAST(1e-6 AS DOUBLE)), 6) AS charge_to_market_ratio,
  CAST(coalesce(tenure_months < 6, false) AS DOUBLE) AS is_new_customer
FROM customer_features, p""",
)
def engineer_features(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features")
    out = features.engineer(customers, exact_median(customers, "monthly_charges"))
    return tidy(out.select("customer_id", "total_charges", *features.ENGINEERED_NUMERIC, *features.ENGINEERED_BINARY))


def _logit_sql(c: float, price: float) -> str:
    return f"""(-2.05 - 0.55 * {c}) + 1.30 * (contract_type = 'month_to_month')::INT
  - 0.90 * (contract_type = 'two_year')::INT + (-0.035 + 0.035 * {c}) * tenure_months
  + (0.020 + 0.040 * {c}) * (monthly_charges - {price}) + 0.35 * num_support_tickets
  + (0.55 - 0.55 * {c}) * (payment_method = 'electronic_check')::INT
  + (0.45 - 1.25 * {c}) * (internet_service = 'fiber_optic')::INT
  + 1.20 * {c} * (internet_service = 'dsl')::INT - 0.50 * has_tech_support
  + 0.30 * senior_citizen + 0.20 * paperless_billing"""


@query(
    "logit_score",
    f"""{CLEAN}, s AS (SELECT customer_id, CAST({_logit_sql(0.0, 65.0)} AS DOUBLE) AS a,
  CAST({_logit_sql(0.4, 65.0)} AS DOUBLE) AS b FROM customer_features)
SELECT customer_id, round(1 / (1 + exp(-a)), 6) AS baseline, round(1 / (1 + exp(-b)), 6) AS shifted FROM s""",
)
def logit_score(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features")
    return tidy(
        customers.select(
            "customer_id",
            sigmoid(synthetic.churn_logit(0.0)).alias("baseline"),
            sigmoid(synthetic.churn_logit(0.4)).alias("shifted"),
        )
    )


@query(
    "batch_score",
    f"""{CLEAN}, s AS (SELECT customer_id, 1 / (1 + exp(-CAST({_logit_sql(0.0, 65.0)} AS DOUBLE))) AS p
FROM customer_features)
SELECT customer_id, round(p, 6) AS churn_probability, CAST(p >= 0.35 AS INT) AS churn_prediction FROM s""",
)
def batch_score(spark: SparkSession, sf: str) -> DataFrame:
    scored = frame(spark, sf, "customer_features").withColumn("p", sigmoid(synthetic.churn_logit()))
    return scored.select(
        "customer_id",
        F.bround("p", 6).alias("churn_probability"),
        decide_class(F.col("p"), 0.35).alias("churn_prediction"),
    )


@query(
    "stratified_split",
    f"""{CLEAN}, r AS (SELECT customer_id, churned,
  row_number() OVER (PARTITION BY churned ORDER BY {u('42', 'customer_id')}, customer_id) AS rn,
  count(*) OVER (PARTITION BY churned) AS n FROM customer_features)
SELECT customer_id, churned, CASE WHEN rn <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM r""",
)
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features").select("customer_id", "churned")
    return sampling.stratified_split(customers, "customer_id", "churned")


@query(
    "stratified_folds",
    f"""{CLEAN}
SELECT customer_id, churned, CAST(ntile(5) OVER (PARTITION BY churned
  ORDER BY {u('42', 'customer_id')}, customer_id) - 1 AS INT) AS fold FROM customer_features""",
)
def stratified_folds(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features").select("customer_id", "churned")
    return sampling.stratified_folds(customers, "customer_id", "churned")


@query(
    "reference_sample",
    f"""{CLEAN}
SELECT customer_id, contract_type, churned FROM customer_features
ORDER BY {u('42', 'customer_id')}, customer_id LIMIT 500""",
)
def reference_sample(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features").select("customer_id", "contract_type", "churned")
    return sampling.exact_sample(customers, "customer_id", 500, 42)


DIGEST_COLUMNS = ["customer_id", *CHURN.features, "churned"]


@query(
    "dataset_digest",
    f"""{CLEAN}, t AS (SELECT md5(concat({', '.join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')" for c in DIGEST_COLUMNS)})) AS h
FROM customer_features)
SELECT count(*) AS n_rows, concat_ws('-', CAST(sum(CAST(('0x' || substr(h, 1, 16)) AS UBIGINT)) AS VARCHAR), CAST(sum(CAST(('0x' || substr(h, 17, 16)) AS UBIGINT)) AS VARCHAR)) AS digest FROM t""",
)
def customer_digest(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features").select(*DIGEST_COLUMNS)
    return dataset_digest(customers).select("n_rows", "digest")


@query(
    "base_rates",
    f"""{CLEAN}, r AS (SELECT *, row_number() OVER (PARTITION BY churned ORDER BY {u('42', 'customer_id')}, customer_id) AS rn,
  count(*) OVER (PARTITION BY churned) AS n,
  CAST(1 / (1 + exp(-CAST({_logit_sql(0.0, 65.0)} AS DOUBLE))) >= 0.35 AS INT) AS flagged FROM customer_features)
SELECT CASE WHEN rn <= round(n * 0.2) THEN 'test' ELSE 'train' END AS split, count(*) AS n,
  round(avg(churned), 4) AS churn_rate, round(avg(flagged), 4) AS predicted_rate FROM r GROUP BY 1""",
)
def base_rates(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features").withColumn(
        "flagged", decide_class(sigmoid(synthetic.churn_logit()), 0.35)
    )
    split = sampling.stratified_split(customers, "customer_id", "churned")
    return tidy(
        split.groupBy("split").agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("churned").alias("churn_rate"),
            F.avg("flagged").alias("predicted_rate"),
        ),
        4,
    )


def _poisson_steps(rate: float, terms: int = 30) -> str:
    steps, term, total = [], exp(-rate), 0.0
    for k in range(terms):
        total += term
        if total >= 1 - 1e-15:
            break
        steps.append(repr(total))
        term *= rate / (k + 1)
    return "[" + ", ".join(f"CAST({s} AS DOUBLE)" for s in steps) + "]"


@query(
    "inject_drift",
    f"""{CLEAN}
SELECT customer_id, round(monthly_charges * 1.24, 6) AS monthly_charges,
  CASE WHEN contract_type <> 'month_to_month' AND {u('42-contract_type', 'customer_id')} < CAST(0.16 AS DOUBLE) / 0.45
    THEN 'month_to_month' ELSE contract_type END AS contract_type,
  CASE WHEN internet_service <> 'fiber_optic' AND {u('42-internet_service', 'customer_id')} < CAST(0.12 AS DOUBLE) / 0.56
    THEN 'fiber_optic' ELSE internet_service END AS internet_service,
  CAST(num_support_tickets + len(list_filter({_poisson_steps(1.2)},
    lambda s: s <= {u('42-tickets', 'customer_id')})) AS INT) AS num_support_tickets
FROM customer_features""",
)
def inject_drift(spark: SparkSession, sf: str) -> DataFrame:
    shifted = synthetic.inject_drift(
        frame(spark, sf, "customer_features"), synthetic.DriftProfile.of_strength(0.8)
    )
    return tidy(
        shifted.select(
            "customer_id", "monthly_charges", "contract_type", "internet_service", "num_support_tickets"
        )
    )


@query(
    "numeric_summary",
    CLEAN
    + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
        f"round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END), 6) AS missing_fraction FROM customer_features"
        for c in RANGES
    ),
)
def numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    return tidy(drift.numeric_summary(frame(spark, sf, "customer_features"), CHURN.with_role("numeric")))


@query(
    "category_shares",
    CLEAN
    + "\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS category, "
        f"round(count(*) / CAST(sum(count(*)) OVER () AS DOUBLE), 4) AS share "
        f"FROM customer_features WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in (*DOMAINS, *BINARIES)
    ),
)
def category_shares(spark: SparkSession, sf: str) -> DataFrame:
    return drift.category_shares(
        frame(spark, sf, "customer_features"), CHURN.with_role("categorical"), CHURN.with_role("binary")
    )


@query(
    "permute_column",
    f"""{CLEAN}, a AS (SELECT customer_id, monthly_charges,
  row_number() OVER (ORDER BY {u('7-take', 'customer_id')}, customer_id) AS r FROM customer_features),
b AS (SELECT monthly_charges AS given,
  row_number() OVER (ORDER BY {u('7-give', 'customer_id')}, customer_id) AS r FROM customer_features)
SELECT customer_id, monthly_charges, given AS permuted FROM a JOIN b USING (r)""",
)
def permute_column(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features").select("customer_id", "monthly_charges")
    return sampling.permute_column(customers, "customer_id", "monthly_charges", 7, "permuted")


@query(
    "topup_training",
    f"""{CLEAN}, f AS (SELECT customer_id, churned FROM customer_features WHERE has_tech_support = 0),
t AS (SELECT customer_id, churned FROM customer_features WHERE has_tech_support = 1),
need AS (SELECT greatest(0, 600 - count(*)) AS k FROM f),
r AS (SELECT *, row_number() OVER (ORDER BY {u('42', 'customer_id')}, customer_id) AS rn FROM t)
SELECT customer_id, churned, 'fresh' AS origin FROM f
UNION ALL SELECT customer_id, churned, 'reference' FROM r, need WHERE rn <= k""",
)
def topup_training(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features")
    keep = ["customer_id", "churned"]
    fresh = customers.where("has_tech_support = 0").select(*keep)
    reference = customers.where("has_tech_support = 1").select(*keep)
    return sampling.top_up(fresh, reference, "customer_id", 600)


@query("gen_population")
def gen_population(spark: SparkSession, sf: str) -> DataFrame:
    """One synthetic customer per order."""
    return synthetic.population(frame(spark, sf, "orders"), "o_orderkey", 42)


def _importance_oracle() -> str:
    """Rank, swap and score every (feature, repeat) copy; AUC by comparing average ranks."""
    own = {f: f"CASE WHEN feature = '{f}' THEN g.{f} ELSE t.{f} END AS {f}" for f in CHURN.features}
    give = "md5('42-give|' || feature || '|' || CAST(rep AS VARCHAR) || '|' || CAST(customer_id AS VARCHAR))"
    draw = f"(CAST(('0x' || substr({give}, 1, 13))::BIGINT AS DOUBLE) / CAST(4503599627370496 AS DOUBLE))"
    auc = """SELECT {keys}(sum(CASE WHEN churned = 1 THEN rk END) - sum(churned) * (sum(churned) + 1) / 2.0)
      / (sum(churned) * CAST(sum(1 - churned) AS DOUBLE)) AS auc FROM (
      SELECT *, rank() OVER ({part} ORDER BY p) + (count(*) OVER ({tie}) - 1) / 2.0 AS rk FROM {source}) {group}"""
    scored = f"least(greatest(round(1 / (1 + exp(-CAST({_logit_sql(0.0, 65.0)} AS DOUBLE))), 9), 1e-7), 1 - CAST(1e-7 AS DOUBLE)) AS p"
    names = ", ".join(f"'{f}'" for f in CHURN.features)
    base = auc.format(keys="", part="", tie="PARTITION BY p", source="bs", group="")
    each = auc.format(
        keys="feature, rep, ",
        part="PARTITION BY feature, rep",
        tie="PARTITION BY feature, rep, p",
        source="ps",
        group="GROUP BY feature, rep",
    )
    return f"""{CLEAN}, s AS (SELECT * FROM customer_features),
copies AS (SELECT * FROM (SELECT unnest([{names}]) AS feature), (SELECT unnest(range(0, 5)) AS rep)),
t AS (SELECT *, row_number() OVER (ORDER BY {u('42-take', 'customer_id')}, customer_id) AS r FROM s),
g AS (SELECT *, row_number() OVER (PARTITION BY feature, rep ORDER BY {draw}, customer_id) AS r FROM s, copies),
perm AS (SELECT g.feature, g.rep, t.customer_id, t.churned, {', '.join(own.values())} FROM t JOIN g ON g.r = t.r),
bs AS (SELECT churned, {scored} FROM s), ps AS (SELECT feature, rep, churned, {scored} FROM perm),
b AS ({base}), e AS ({each})
SELECT feature, round(avg(b.auc - e.auc), 6) AS importance_mean, round(stddev_pop(b.auc - e.auc), 6) AS importance_std FROM e, b GROUP BY 1"""


@query("permutation_importance", _importance_oracle())
def permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    customers = frame(spark, sf, "customer_features")

    def score(df: DataFrame) -> DataFrame:
        # Rounded, so that scores equal on paper are ties in any order of addition.
        return df.withColumn("probability_1", F.round(sigmoid(synthetic.churn_logit()), 9))

    found = importance_of(customers, score, "customer_id", "churned", CHURN.features)
    return tidy(found)


CSV_COLUMNS = ["customer_id", "tenure_months", "monthly_charges", "payment_method"]


@query(
    "csv_scan",
    f"""{CLEAN} SELECT customer_id, CASE WHEN customer_id % 10 = 0 THEN 'surplus' WHEN customer_id % 7 = 0 THEN 'short' ELSE 'good' END AS kind,
  CASE WHEN customer_id % 10 = 0 THEN 6 WHEN customer_id % 7 = 0 THEN 3 ELSE 4 END AS n_cells,
  CASE WHEN customer_id % 10 <> 0 AND customer_id % 7 = 0 OR customer_id % 13 = 0 THEN '~'
    WHEN customer_id % 11 = 0 THEN 'cash, "later"' ELSE payment_method END AS payment_method
FROM customer_features""",
)
def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Customers written as CSV lines, some with cells too many or too few, and read back."""
    method = (
        F.when(F.col("customer_id") % 13 == 0, "n/a")
        .when(F.col("customer_id") % 11 == 0, '"cash, ""later"""')
        .otherwise(F.col("payment_method"))
    )
    cells = F.concat_ws(",", *CSV_COLUMNS[:3])
    line = (
        F.when(F.col("customer_id") % 10 == 0, F.concat_ws(",", cells, method, F.lit("more"), F.lit("")))
        .when(F.col("customer_id") % 7 == 0, cells)
        .otherwise(F.concat_ws(",", cells, method))
    )

    def headed(batches):
        first = True
        for batch in batches:
            yield pd.DataFrame({"line": [",".join(CSV_COLUMNS)]}) if first else batch.iloc[:0]
            yield batch
            first = False

    path = f"{work_dir(spark, 'csv')}/customers"
    frame(spark, sf, "customer_features").select(line.alias("line")).mapInPandas(headed, "line string").write.text(path)
    width = F.lit(len(CSV_COLUMNS))
    found = tables.scan_csv(spark, path).withColumn("n_cells", F.coalesce("n_cells", width))
    kind = F.when(F.col("n_cells") > width, "surplus").when(F.col("n_cells") < width, "short").otherwise("good")
    return found.select(
        F.col("customer_id").cast("long").alias("customer_id"),
        kind.alias("kind"),
        F.col("n_cells").cast("int").alias("n_cells"),
        F.coalesce("payment_method", F.lit("~")).alias("payment_method"),
    )
