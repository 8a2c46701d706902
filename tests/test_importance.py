"""Permutation importance: what moves for each copy is one value, not the row."""

from pyspark.sql import functions as F

from tidewatch.operators.importance import permutation_importance, permuted_copies


def test_copies_move_one_value_and_rank_the_rows_once(spark):
    rows = spark.range(60).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 2).cast("int").alias("y"),
        F.col("id").cast("int").alias("a"), (F.col("id") * 0.5).alias("b"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("c"), "id")).alias("c"), (F.col("id") + 100).cast("int").alias("d"),
    )
    features = ["a", "b", "c", "d"]
    copies = permuted_copies(rows, "k", features, 3, 5)
    assert set(copies.columns) == {"feature", "repeat", *rows.columns}
    plan = copies._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert not any("feature" in line or "repeat" in line for line in joins) and "_given" not in plan
    kept = copies.collect()
    assert len(kept) == 4 * 3 * 60
    own = {r["k"]: r.asDict() for r in rows.collect()}
    order = lambda values: sorted(values, key=lambda v: (v is None, v))
    for f in features:
        for i in range(3):
            copy = [r for r in kept if (r["feature"], r["repeat"]) == (f, i)]
            assert order(r[f] for r in copy) == order(r[f] for r in own.values())
            assert any(r[f] != own[r["k"]][f] for r in copy)
            others = [c for c in rows.columns if c != f]
            assert all(r[c] == own[r["k"]][c] for r in copy for c in others)


def test_scores_all_alike_before_the_values_move(spark):
    """Cut points from the rows as they are deal badly here, and the areas are still right."""
    rows = spark.range(200).select(
        F.col("id"), (F.col("id") % 2).cast("int").alias("y"), F.col("id").cast("double").alias("a"), (-F.col("id")).cast("double").alias("b")
    )
    score = lambda df: df.withColumn("probability_1", 0.5 + (F.col("a") + F.col("b")) / 1000)
    found = {r["feature"]: r for r in permutation_importance(rows, score, "id", "y", ["a", "b"], repeats=2).collect()}
    copies = score(permuted_copies(rows, "id", ["a", "b"], 2, 42)).collect()
    for f in ("a", "b"):
        drops = []
        for i in range(2):
            p = [(r["probability_1"], r["y"]) for r in copies if (r["feature"], r["repeat"]) == (f, i)]
            won = sum((x > z) + (x == z) / 2 for x, u in p if u for z, v in p if not v)
            drops.append(0.5 - won / (100 * 100))
        assert abs(found[f]["importance_mean"] - sum(drops) / 2) < 1e-9
