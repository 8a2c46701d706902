"""Permutation importance: how much ranking quality each raw feature carries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.columns import uniform
from tidewatch.operators.metrics import roc_auc
from tidewatch.operators.ordering import hash_positions
from tidewatch.operators.sampling import exact_sample
from tidewatch.session import written


def _pairs(features: Sequence[str], repeats: int) -> list[tuple[str, int]]:
    """(feature, repeat) of each copy, by its number."""
    return [(f, i) for f in features for i in range(repeats)]


def _named(copies: DataFrame, features: Sequence[str], repeats: int) -> DataFrame:
    """The copy's feature and repeat in place of its number."""
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.lit(i).alias("i")) for f, i in _pairs(features, repeats)])
    pair = F.get(pairs, F.col("_copy"))
    others = [c for c in copies.columns if c != "_copy"]
    return copies.select(pair["f"].alias("feature"), pair["i"].alias("repeat"), *others)


def _numbered_copies(
    rows: DataFrame, key: str, features: Sequence[str], repeats: int, seed: int | str
) -> DataFrame:
    """:func:`permuted_copies` by the number of the copy, in ``_copy``.

    What moves once for each copy is a draw and a single value, in a column of its type. The
    rows that take the values are ranked and moved once: their rank is the same in all copies.
    """
    pairs = _pairs(features, repeats)
    # Few bytes become many rows here, which adaptive execution would leave to a few tasks.
    rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)
    takers = hash_positions(rows, [key], f"{seed}-take", "_rank")
    kinds = [rows.schema[f].dataType for f in features]
    slots = [next(i for i, other in enumerate(kinds) if other == kind) for kind in kinds]
    given = [
        F.struct(
            F.lit(n).alias("_copy"), uniform(f"{seed}-give", F.lit(f), F.lit(i), F.col(key)).alias("_draw"),
            *[
                (F.col(f) if slots[features.index(f)] == slot else F.lit(None).cast(kinds[slot])).alias(f"_v{slot}")
                for slot in sorted(set(slots))
            ],
        )
        for n, (f, i) in enumerate(pairs)
    ]
    values = rows.select(key, F.inline(F.array(*given)))
    givers = hash_positions(values, [key], f"{seed}-give", "_rank", by=["_copy"], draw="_draw").drop(key)
    joined = takers.join(givers.hint("merge"), "_rank")  # neither side may be sent to all
    of = lambda f: F.col("_copy").between(features.index(f) * repeats, (features.index(f) + 1) * repeats - 1)
    return joined.select(
        "_copy",
        *[c for c in rows.columns if c not in features],
        *[F.when(of(f), F.col(f"_v{slot}")).otherwise(F.col(f)).alias(f) for f, slot in zip(features, slots, strict=True)],
    )


def permuted_copies(
    rows: DataFrame, key: str, features: Sequence[str], repeats: int, seed: int | str
) -> DataFrame:
    """One copy of the table per (feature, repeat), with that feature's values rearranged.

    The row at rank r of one random order takes the value of the row at rank r of another
    order, drawn separately for each copy.
    """
    return _named(_numbered_copies(rows, key, features, repeats, seed), features, repeats)


def permutation_importance(
    rows: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    key: str,
    label: str,
    features: Sequence[str],
    probability: str = "probability_1",
    repeats: int = 5,
    max_rows: int | None = None,
    seed: int | str = 42,
) -> DataFrame:
    """(feature, importance_mean, importance_std): drop of the ROC-AUC, largest first.

    ``score`` adds the probability column; it is applied once to all copies together.
    All rows take part unless ``max_rows`` asks for a sample; they are computed once.
    """
    sample = written(exact_sample(rows, key, max_rows, seed) if max_rows else rows, "importance")
    unchanged = score(sample)
    base = roc_auc(unchanged, probability, label).scalar()
    scored = score(_numbered_copies(sample, key, features, repeats, seed))
    per_copy = roc_auc(scored, probability, label, by=["_copy"], like=unchanged)
    drops = _named(per_copy, features, repeats).withColumn("drop", base - F.col("roc_auc"))
    return (
        drops.groupBy("feature")
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .orderBy(F.desc("importance_mean"), "feature")
    )
