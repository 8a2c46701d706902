"""Readers and writers of the tables the library keeps: CSV input, snapshots and the logs.

Paths may be on any Hadoop file system. Tables are append-only; readers pass an explicit
schema, so nothing is inferred and an absent table reads as an empty one.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.contract import CHURN, Contract
from tidewatch.operators.decisions import ATTEMPT_SCHEMA, retrain_outcomes
from tidewatch.operators.predictionlog import FEEDBACK_SCHEMA, LOG_SCHEMA, conflicting_ids, latest_labels
from tidewatch.operators.registry import ALIAS_SCHEMA, TAG_SCHEMA, VERSION_SCHEMA
from tidewatch.sources.synthetic import DriftProfile, generate_customers

# Words a CSV cell may hold instead of a value. The category ``none`` is not
# one of them.
MISSING_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

CYCLE_SCHEMA = (
    "model_name string, cycle_ts timestamp, status string, model_version string, run_id string, "
    "window_size long, drift_share double, dataset_drift boolean, drifted_features array<string>, "
    "prediction_psi double, n_labeled long, live map<string,double>, below array<string>, "
    "retrain_reasons array<string>, triggered boolean, allowed boolean, evaluated boolean, "
    "outcome string, payload string"
)
BASELINE_SCHEMA = f"{CHURN.key} string, " + ", ".join(
    f"{f.name} {f.spark_type.simpleString()}" for f in CHURN.fields
) + f", {CHURN.target} int"
EVALUATION_SCHEMA = f"churn_probability double, {CHURN.target} int"
LOG_COLUMNS = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
LABELED_SCHEMA = f"{LOG_SCHEMA}, actual int, feedback_at timestamp"
LEDGER_SCHEMA = (
    "source string, batch_id long, n_received long, n_logged long, first_day date, last_day date, written_at timestamp"
)
RUN_SCHEMA = "run_id string, key string, value string, logged_at timestamp"


def path_exists(spark: SparkSession, path: str) -> bool:
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def remove_folders(spark: SparkSession, pattern: str) -> None:
    """Delete the folders that a glob pattern names."""
    location = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    for found in files.globStatus(location) or ():
        files.delete(found.getPath(), True)


RAW = "_corrupt_record"


class SurplusCells(ValueError):
    """A CSV file has rows with more cells than its header."""


def scan_csv(spark: SparkSession, path: str) -> DataFrame:
    """A headed CSV as text columns, with ``raw`` and ``n_cells`` of rows that do not fit it.

    ``raw`` is the line of a row with more or fewer cells than the header, and NULL for all
    others; ``n_cells`` is their number. Missing words are NULL. Types are applied by
    ``coerce_types`` after validation, so a bad cell is reported instead of being lost here.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    names = spark.read.option("header", True).option("nullValue", "").csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, RAW]])
    read = spark.read.schema(schema).option("header", True).option("enforceSchema", True)
    read = read.option("escape", '"').option("columnPruning", False)  # a cut row has all of its cells counted
    rows = read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW).csv(path)
    commas = F.regexp_count(RAW, F.lit(r',(?=(?:[^"]*"[^"]*")*[^"]*$)'))  # outside of quotes
    return rows.select(
        *[F.when(~F.col(f"`{c}`").isin(*MISSING_WORDS), F.col(f"`{c}`")).alias(c) for c in names],
        # The reader refuses a query of its raw line alone, so a cell comes along, at no length.
        F.concat(F.col(RAW), F.substring(F.coalesce(F.col(f"`{names[0]}`"), F.lit("")), 1, 0)).alias("raw"),
        F.when(F.col(RAW).isNotNull(), commas + 1).alias("n_cells"),
    )


def split_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a headed CSV: bad are those with more cells than the header.

    Cells that a row lacks at its end are missing values, as everywhere else.
    """
    scanned = scan_csv(spark, path)
    width = len(scanned.columns) - 2
    surplus = F.coalesce(F.col("n_cells") > width, F.lit(False))
    return scanned.where(~surplus).drop("raw", "n_cells"), scanned.where(surplus).select("raw", "n_cells")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a headed CSV as text columns; a row with surplus cells is an error."""
    good, bad = split_csv(spark, path)
    found = bad.agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("first")).first()
    if found["n"]:
        raise SurplusCells(f"{found['n']} rows have more cells than the header, one is {found['first']!r}")
    return good


def load_source(
    spark: SparkSession,
    source: str = "synthetic",
    csv_path: str | None = None,
    n: int = 6000,
    seed: int = 42,
    profile: DriftProfile = DriftProfile(),
) -> DataFrame:
    """Customers from a CSV file or from the synthetic population."""
    if source == "csv":
        if not csv_path:
            raise ValueError("a csv source needs a path")
        return read_csv(spark, csv_path)
    if source != "synthetic":
        raise ValueError(f"unknown source: {source}")
    return generate_customers(spark, n, seed, profile)


def write_snapshot(df: DataFrame, base: str, run_id: str) -> str:
    """Write an immutable snapshot; a second write under one run id is an error."""
    path = f"{base.rstrip('/')}/snapshot={run_id}"
    df.write.mode("errorifexists").parquet(path)
    return path


class DuplicatePrediction(ValueError):
    """A batch repeats a prediction id, or one already in the log."""


@dataclass(frozen=True)
class Workspace:
    """Locations of one deployment's tables under a base folder."""

    base: str

    def path(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *parts])

    def read(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        location = self.path(name)
        if not path_exists(spark, location):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(location)

    def append(self, df: DataFrame, name: str) -> None:
        df.write.mode("append").parquet(self.path(name))

    # Day-partitioned tables: a batch is a folder within each day it has rows of, so recent
    # windows read few files and a batch that is run again replaces what it wrote before.
    def dated(self, spark: SparkSession, name: str, schema: str) -> DataFrame:
        return self.read(spark, name, f"{schema}, created_date date, batch string")

    def replace_batch(self, rows: DataFrame, name: str, batch: str) -> None:
        """Write the rows of a batch by day, in place of those of an earlier attempt."""
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError(f"not a batch name: {batch!r}")
        remove_folders(rows.sparkSession, self.path(name, "created_date=*", f"batch={batch}"))
        dated = rows.withColumn("created_date", F.to_date("created_at")).withColumn("batch", F.lit(batch))
        dated.write.mode("append").partitionBy("created_date", "batch").parquet(self.path(name))

    def predictions(self, spark: SparkSession) -> DataFrame:
        return self.dated(spark, "predictions", LOG_SCHEMA).drop("batch")

    def append_predictions(self, batch: DataFrame) -> None:
        """Append a batch or nothing: any id repeated or known rejects all of it."""
        spark = batch.sparkSession
        bad = conflicting_ids(batch, self.predictions(spark)).agg(
            F.count(F.lit(1)).alias("n"), F.min("prediction_id").alias("first")
        ).first()
        if bad["n"]:
            raise DuplicatePrediction(f"{bad['n']} ids are repeated or known, the first is {bad['first']}")
        self.replace_batch(batch.select(*LOG_COLUMNS), "predictions", f"load-{uuid.uuid4().hex}")

    def log_batches(self, spark: SparkSession) -> DataFrame:
        """The ledger of streamed batches, one row each."""
        return self.read(spark, "log_batches", f"{LEDGER_SCHEMA}, batch string")

    def labeled(self, spark: SparkSession) -> DataFrame:
        """Predictions with their last label, kept up to date by days; see ``refresh_days``."""
        return self.read(spark, "labeled", f"{LABELED_SCHEMA}, created_date date")

    def refresh_days(self, spark: SparkSession, days: list) -> None:
        """Rewrite the given days of ``labeled`` from the changes of those days alone.

        The changes are never rewritten in place, so a refresh that is lost is run again.
        """
        if not days:
            return
        changes = self.dated(spark, "label_changes", LABELED_SCHEMA).where(F.col("created_date").isin(days))
        others = [c for c in LOG_COLUMNS if c != "prediction_id"] + ["created_date"]
        last = latest_labels(changes, others)
        writer = last.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("created_date").parquet(self.path("labeled"))

    def feedback(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "feedback", FEEDBACK_SCHEMA)

    # What the monitor compares with, one folder per model and version.
    def save_baseline(
        self, reference: DataFrame, evaluation: DataFrame, model: str, version: int
    ) -> None:
        tail = f"model_name={model}/model_version={version}"
        reference.write.mode("errorifexists").parquet(self.path("baseline", tail))
        evaluation.write.mode("errorifexists").parquet(self.path("evaluation", tail))

    def load_baseline(self, spark: SparkSession, model: str, version: int) -> tuple[DataFrame, DataFrame]:
        tail = f"model_name={model}/model_version={version}"
        return (
            spark.read.schema(BASELINE_SCHEMA).parquet(self.path("baseline", tail)),
            spark.read.schema(EVALUATION_SCHEMA).parquet(self.path("evaluation", tail)),
        )

    def versions(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "model_versions", VERSION_SCHEMA)

    def alias_events(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "alias_events", ALIAS_SCHEMA)

    def tags(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "version_tags", TAG_SCHEMA)

    def cycles(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "monitor_cycles", CYCLE_SCHEMA)

    def retrainings(self, spark: SparkSession) -> DataFrame:
        """Every attempt to retrain with its outcome."""
        return retrain_outcomes(self.read(spark, "retrainings", ATTEMPT_SCHEMA))

    def runs(self, spark: SparkSession) -> DataFrame:
        return self.read(spark, "training_runs", RUN_SCHEMA)

    def model_path(self, model: str, version: int) -> str:
        return self.path("models", model, str(version))


def coerced_for_contract(df: DataFrame, contract: Contract = CHURN) -> DataFrame:
    """Contract columns in their storage types (after validation)."""
    cells = [F.col(f.name).try_cast(f.spark_type).alias(f.name) for f in contract.fields]
    key = [F.col(contract.key).cast("string").alias(contract.key)] if contract.key in df.columns else []
    target = (
        [F.col(contract.target).cast("int").alias(contract.target)]
        if contract.target in df.columns
        else []
    )
    return df.select(*key, *cells, *target)
