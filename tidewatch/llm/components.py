"""Connected components of a graph given by its links, without gathering it anywhere.

Every node hooks to its smallest neighbour if that is smaller than itself; the pointers form
trees, which are flattened by pointer jumping, and the links between different trees make a
smaller graph for the next level. Each level at least halves the nodes that have links.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import kept


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) of links (a, b): every linked node that is not the smallest of its component."""
    current = kept(_ordered(links), "links")
    levels = []
    while not current.isEmpty():
        parents, moved = current.groupBy("a").agg(F.min("b").alias("p")), True
        parents = kept(parents, "parents")
        while moved:
            up = lambda p: parents.select(F.col("a").alias(p), F.col("p").alias(f"{p}p"))
            two = parents.join(up("p"), "p", "left").join(up("pp"), "pp", "left")  # two steps up at once
            jumped = kept(two.select("a", F.coalesce("ppp", "pp", "p").alias("p"), F.col("ppp").isNotNull().alias("m")), "jumped")
            moved = not jumped.where("m").isEmpty()
            parents = jumped.select("a", "p")
        levels.append(parents)
        ra, rb = parents.select("a", F.col("p").alias("ra")), parents.select(F.col("a").alias("b"), F.col("p").alias("rb"))
        mapped = current.join(ra, "a").join(rb, "b", "left")
        current = kept(_ordered(mapped.select(F.col("ra").alias("a"), F.coalesce("rb", "b").alias("b"))), "links")
    if not levels:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = levels[-1].select(F.col("a").alias("node"), F.col("p").alias("root"))
    for parents in levels[-2::-1]:
        above = labels.select(F.col("node").alias("p"), "root")
        here = parents.join(above, "p", "left").select(F.col("a").alias("node"), F.coalesce("root", "p").alias("root"))
        labels = here.unionByName(labels)
    return labels


def smallest_reachable(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label that rows and columns of a boolean matrix reach through it."""
    top = np.iinfo(np.int64).max
    left, right = left.copy(), right.copy()
    while True:
        new_left = np.minimum(left, np.where(linked, right[None, :], top).min(axis=1, initial=top))
        new_right = np.minimum(right, np.where(linked, new_left[:, None], top).min(axis=0, initial=top))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right
