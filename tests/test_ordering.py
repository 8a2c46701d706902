"""Global order without a single-task window, checked against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import ordering, quantiles, sampling


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.normal(0, 1, 3000), np.repeat(0.25, 2000), rng.integers(0, 5, 1000)])
    return pd.DataFrame({"id": range(len(values)), "g": rng.choice(["a", "b"], len(values)), "value": values})


@pytest.mark.parametrize("slices", [1, 4, 64])
def test_running_totals_match_a_plain_cumulative_sum(spark, numbers, slices):
    counts = spark.createDataFrame(numbers).groupBy("g", "value").agg(F.count("*").alias("n"))
    got = ordering.running_totals(counts, "value", ["n"], ["g"], slices).toPandas()
    want = numbers.groupby(["g", "value"]).size().rename("n").reset_index().sort_values(["g", "value"])
    want["n_before"] = want.groupby("g").n.cumsum() - want.n
    got = got.sort_values(["g", "value"]).reset_index(drop=True)
    assert got.n_before.tolist() == want.n_before.tolist()
    assert got.n_all.tolist() == want.groupby("g").n.transform("sum").tolist()


def test_running_totals_keep_a_null_group(spark):
    df = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("a", 1.0, 5)], "g string, v double, n int")
    rows = {(r.g, r.v): (r.n_before, r.n_all) for r in ordering.running_totals(df, "v", ["n"], ["g"], 16).collect()}
    assert rows == {(None, 1.0): (0, 5), (None, 2.0): (2, 5), ("a", 1.0): (0, 5)}


def test_exact_quantiles_equal_numpy(spark, numbers):
    q = [0.1, 0.25, 0.5, 0.9]
    df = spark.createDataFrame(numbers)
    for slices in (1, None):
        got = quantiles.exact_quantiles(df, ["value"], q, slices).first()["quantiles"]
        assert got == pytest.approx(np.quantile(numbers.value, q), abs=1e-12)
    small = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "x double")
    assert small.select(quantiles.exact_median(small, "x").alias("m")).first()["m"] == 2.5


def test_hash_positions_are_gap_free_and_independent_of_partitions(spark):
    df = spark.range(5000)
    one = {r.id: r.pos for r in ordering.hash_positions(df.coalesce(1), ["id"], "s", "pos").collect()}
    many = {r.id: r.pos for r in ordering.hash_positions(df.repartition(13), ["id"], "s", "pos").collect()}
    assert one == many and sorted(one.values()) == list(range(1, 5001))


def test_split_and_folds_have_exact_class_counts(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    split = sampling.stratified_split(df, "id", "y").groupBy("y", "split").count().collect()
    assert {(r["y"], r["split"]): r["count"] for r in split} == {
        (0, "test"): 180, (0, "train"): 722, (1, "test"): 20, (1, "train"): 81,
    }
    folds = sampling.stratified_folds(df, "id", "y", 5).groupBy("y", "fold").count().collect()
    assert sorted(r["count"] for r in folds) == [20, 20, 20, 20, 21] + [180, 180, 180, 181, 181]


def test_tiny_class_stays_in_training(spark):
    df = spark.createDataFrame([(i, int(i < 2)) for i in range(20)], "id int, y int")
    parts = sampling.stratified_split(df, "id", "y").where("y = 1").collect()
    assert [r["split"] for r in parts] == ["train", "train"]


def test_exact_sample_and_permutation(spark):
    df = spark.range(500).withColumn("v", F.col("id") * 2)
    assert sampling.exact_sample(df, "id", 40, 1).count() == 40
    assert sampling.exact_sample(df, "id", 900, 1).count() == 500
    moved = sampling.permute_column(df, "id", "v", 3).toPandas()
    assert sorted(moved.v) == [2 * i for i in range(500)]
    assert (moved.v != 2 * moved.id).sum() > 450


@pytest.mark.parametrize(
    "n, fraction, minimum, pool, want",
    [(400, 0.25, 100, 0, (300, 100, 0)), (100, 0.25, 300, 500, (75, 25, 225)), (100, 0.25, 300, 50, (75, 25, 50))],
)
def test_holdout_and_top_up_sizes(spark, n, fraction, minimum, pool, want):
    log = spark.range(n).select(
        F.col("id").cast("string").alias("prediction_id"), F.timestamp_seconds("id").alias("created_at")
    )
    split = sampling.time_holdout(log.orderBy(F.rand(1)), fraction)
    counts = {r["part"]: r["count"] for r in split.groupBy("part").count().collect()}
    oldest_held = split.where("part = 'holdout'").agg(F.min("created_at")).first()[0]
    assert split.where((F.col("part") == "train") & (F.col("created_at") > oldest_held)).count() == 0
    fresh = split.where("part = 'train'").select("prediction_id")
    reference = spark.range(pool).select(F.concat(F.lit("r"), "id").alias("prediction_id"))
    topped = sampling.top_up(fresh, reference, "prediction_id", minimum)
    assert (counts["train"], counts["holdout"], topped.where("origin = 'reference'").count()) == want


def test_holdout_splits_rows_that_share_one_instant(spark):
    log = spark.range(90).select(F.col("id").cast("string").alias("prediction_id"), F.timestamp_seconds(F.lit(7)).alias("created_at"))
    parts = sampling.time_holdout(log, 1 / 3).groupBy("part").count().collect()
    assert {r["part"]: r["count"] for r in parts} == {"train": 60, "holdout": 30}
