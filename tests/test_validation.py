import pytest
from pyspark.sql import functions as F

from tidewatch.contract import CHURN
from tidewatch.operators import validation
from tidewatch.sources.synthetic import generate_customers


@pytest.fixture(scope="module")
def customers(spark):
    return generate_customers(spark, 400, 2).persist()


def put(column, value, kind):
    return lambda df: df.withColumn(column, F.when(F.col(CHURN.key) == "C0000003", F.lit(value).cast(kind)).otherwise(F.col(column).cast(kind)))


MUTATIONS = [
    (lambda df: df.drop("tenure_months"), ("tenure_months", "required_column")),
    (put("monthly_charges", -5.0, "double"), ("monthly_charges", "range")),
    (put("tenure_months", 500, "int"), ("tenure_months", "range")),
    (put("contract_type", "weekly", "string"), ("contract_type", "categories")),
    (put("senior_citizen", 2, "int"), ("senior_citizen", "binary")),
    (put("num_support_tickets", "many", "string"), ("num_support_tickets", "dtype")),
    (put("payment_method", None, "string"), ("payment_method", "not_null")),
    (lambda df: df.withColumn("avg_monthly_gb", F.when(F.substring(CHURN.key, -1, 1) >= "5", F.col("avg_monthly_gb"))), ("avg_monthly_gb", "missing_fraction")),
    (lambda df: df.withColumn("churned", F.lit(0)), ("churned", "class_balance")),
    (put("churned", 3, "int"), ("churned", "binary")),
    (put("monthly_charges", float("nan"), "double"), ("monthly_charges", "not_null")),
]


@pytest.mark.parametrize("mutate, expected", MUTATIONS, ids=[f"{c}-{k}" for _, (c, k) in MUTATIONS])
def test_each_mutation_is_found_and_nothing_else(spark, customers, mutate, expected):
    issues = validation.validate(mutate(customers)).collect()
    assert {(i["column"], i["check_name"]) for i in issues} == {expected}


def test_clean_data_passes_and_too_few_rows_do_not(spark, customers):
    assert validation.assert_valid(customers) == []
    with pytest.raises(validation.ContractViolation) as error:
        validation.assert_valid(customers.limit(5), min_rows=10, require_target=False)
    assert error.value.errors[0]["check_name"] == "min_rows"


def test_repeated_ids_are_a_warning(spark, customers):
    repeated = customers.unionAll(customers.where(F.col(CHURN.key) < "C0000003"))
    warnings = validation.assert_valid(repeated)
    assert [(w["check_name"], w["n"]) for w in warnings] == [("unique", 3)]
    summary = validation.summarize_issues(validation.validate(repeated)).first()
    assert (summary["passed"], summary["n_errors"], summary["n_warnings"]) == (True, 0, 1)


def test_number_parsing_edges(spark):
    from tidewatch.functions.columns import parse_number

    texts = {"1": 1.0, " 12 ": 12.0, "1e3": 1000.0, "-.5": -0.5, "1d": None, "3f": None, "0x10": None, "": None,
             "NaN": None, "inf": float("inf"), "many": None, "1_000": None, "True": None}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["v"] for r in df.select("t", parse_number("t").alias("v")).collect()} == texts


def test_rows_are_quarantined_with_reasons(spark, customers):
    bad = put("tenure_months", 500, "int")(customers)
    bad = put("contract_type", "weekly", "string")(bad)
    accepted, rejected = validation.split_quarantined(validation.quarantine(bad))
    assert accepted.count() == 399 and accepted.columns == bad.columns
    assert rejected.first()["violations"] == ["tenure_months:range", "contract_type:category"]
    strict = validation.quarantine(customers.withColumn("plan", F.lit(1)), forbid_extra=True)
    assert strict.first()["violations"] == ["plan:unknown"]
