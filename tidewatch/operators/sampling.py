"""Reproducible splits, folds, samples and permutations keyed by row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import uniform
from tidewatch.operators.ordering import cutoffs_passed, hash_positions, running_totals


def exact_sample(df: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement: those of the smallest draws.

    The draw that ends the sample is found from counts, so taking the rows is a filter.
    ``key`` names a row.
    """

    def first_row_left(_: Column) -> Column:
        return F.array(F.lit(max(0, n) + 1))

    return cutoffs_passed(df, "_past", [key], seed, first_row_left).where("_past = 0").drop("_past")


def bernoulli_sample(df: DataFrame, key: str, rate: float, salt: str) -> DataFrame:
    """Keep each row independently with probability ``rate``.

    The salt must differ from the salts that generated the row's attributes, otherwise the
    kept rows are a biased part of the population.
    """
    return df.where(uniform(salt, key) < F.lit(float(rate)))


def stratified_split(
    df: DataFrame, key: str, label: str, test_size: float = 0.2, seed: int | str = 42
) -> DataFrame:
    """Add ``split`` ('train' / 'test') with exact test counts per class (half-even rounding)."""

    def first_train_row(size: Column) -> Column:
        return F.array(F.bround(size * F.lit(test_size)).cast("long") + 1)

    marked = cutoffs_passed(df, "_part", [key], seed, first_train_row, by=label)
    return marked.withColumn(
        "split", F.when(F.col("_part") == 0, F.lit("test")).otherwise("train")
    ).drop("_part")


def stratified_folds(
    df: DataFrame, key: str, label: str, folds: int = 5, seed: int | str = 42
) -> DataFrame:
    """Add ``fold`` in 0..folds-1; class counts per fold differ by at most one row.

    Folds are consecutive ranges of a random order, the first ``size % folds`` of them one
    row longer, so only the folds - 1 boundaries have to be found.
    """
    if folds < 2:
        raise ValueError("folds must be at least 2")

    def first_rows(size: Column) -> Column:
        base, extra = F.floor(size / folds), size % folds
        return F.transform(
            F.sequence(F.lit(1), F.lit(folds - 1)), lambda i: i * base + F.least(i, extra) + 1
        )

    return cutoffs_passed(df, "fold", [key], seed, first_rows, by=label)


def permute_column(
    df: DataFrame, key: str, column: str, seed: int | str, output: str | None = None
) -> DataFrame:
    """Replace ``column`` by a random rearrangement of its own values.

    Row at rank r of one random order receives the value at rank r of another.
    """
    takers = hash_positions(df, [key], f"{seed}-take", "_rank")
    givers = hash_positions(df.select(key, column), [key], f"{seed}-give", "_rank").select(
        "_rank", F.col(column).alias("_given")
    )
    name = output or column
    return (
        takers.join(givers, "_rank")
        .drop("_rank", *([column] if name == column else []))
        .withColumnRenamed("_given", name)
    )


def top_up(
    fresh: DataFrame, reference: DataFrame, key: str, min_rows: int, seed: int | str = 42
) -> DataFrame:
    """Append sampled reference rows until there are ``min_rows``, as far as they reach.

    Adds ``origin`` ('fresh' / 'reference'). How many rows are missing is a scalar subquery,
    so nothing has to be counted on the driver first.
    """
    short = fresh.agg(F.greatest(F.lit(0), F.lit(min_rows) - F.count(F.lit(1)))).scalar()

    def first_unused_row(_: Column) -> Column:
        return F.array(F.col("_g").cast("long") + 1)

    pool = reference.withColumn("_quota", short)
    chosen = cutoffs_passed(pool, "_past", [key], seed, first_unused_row, by="_quota").where(
        F.col("_past") == 0
    )
    tagged = fresh.withColumn("origin", F.lit("fresh"))
    return tagged.unionByName(chosen.withColumn("origin", F.lit("reference")).select(*tagged.columns))


def time_holdout(
    labeled: DataFrame, fraction: float = 0.25, ts: str = "created_at", key: str = "prediction_id"
) -> DataFrame:
    """Add ``part``: the newest ``max(1, round(n * fraction))`` rows are the holdout.

    The boundary instant comes from counts per distinct instant; rows that share it are
    divided by their hash draw. Both steps reduce to a few numbers, so labelling the rows
    is a map without a shuffle and one very common instant does no harm.
    """
    counts = labeled.groupBy(ts).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp"))), "_at", ["n"])
    held = F.greatest(F.lit(1), F.bround(F.col("n_all") * F.lit(fraction)).cast("long"))
    newer = F.col("n_all") - F.col("n_before") - F.col("n")
    boundary = (
        ranked.where((newer < held) & (held <= newer + F.col("n")))
        .agg(F.first(F.struct(F.col(ts).alias("at"), (held - newer).alias("quota"))))
        .scalar()
    )
    marked = labeled.withColumn("_cut", boundary).withColumn(
        "_quota", F.when(F.col(ts) == F.col("_cut.at"), F.col("_cut.quota"))
    )

    def first_train_row(_: Column) -> Column:
        return F.array(F.col("_g").cast("long") + 1)

    ties = marked.where(F.col("_quota").isNotNull())
    split = cutoffs_passed(marked, "_past", [key], "holdout", first_train_row, "_quota", ties=ties)
    newest = (F.col(ts) > F.col("_cut.at")) | (F.col("_quota").isNotNull() & (F.col("_past") == 0))
    return split.withColumn(
        "part", F.when(newest, F.lit("holdout")).otherwise("train")
    ).drop("_cut", "_quota", "_past")
