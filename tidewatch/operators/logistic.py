"""Penalised logistic regressions of many groups and penalties, fitted together.

A Newton step needs the loss, its gradient and its second derivatives, which are sums over
rows. One pass over the rows gives them for every (group, penalty) pair, so the number of
jobs is the number of steps and not the number of models. Tasks add up their rows in numpy;
their sums are added in tasks again before the driver, which solves one system of ``inputs``
equations for each model, sees them: it gets ``groups x penalties`` blocks from about the
square root of the number of tasks.

The loss is the sum over rows plus half the penalty times the squared coefficients; the
intercept is free. Rows without label or inputs take no part; a group without rows gets
coefficients of zero, which is a probability of one half.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOLERANCE = 1e-8  # largest gradient of a row, on average, at which a model is done
STEPS = 100
_SUMS = "fit_group int, slot int, sums array<double>"


def _matrix(cells: pa.ListArray) -> np.ndarray:
    """Rows of inputs with a one for the intercept behind them."""
    values = cells.flatten().to_numpy(zero_copy_only=False).reshape(len(cells), -1)
    return np.column_stack([values, np.ones(len(cells))])


def _probability(z: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -z))


def _batch(sums: dict[int, np.ndarray], slot: int) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.float64())]
    columns = list(sums), [slot] * len(sums), [s.ravel() for s in sums.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], names=["fit_group", "slot", "sums"]
    )


def _add(sums: dict[int, np.ndarray], group: int, more: np.ndarray) -> None:
    sums[group] = sums[group] + more if group in sums else more


def derivatives(rows: DataFrame, weights: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Loss, gradient and second derivatives of each group's models, without the penalty.

    ``rows`` is (fit_group int, y double, x array<double>); ``weights`` holds a (penalties,
    inputs + 1) array per group. The result holds a (penalties, 1 + d + d * d) array per group.
    """
    slots = ceil(sqrt(rows.rdd.getNumPartitions()))

    def over_rows(batches):
        sums = {}
        for batch in batches:
            groups, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x = _matrix(batch.column(2))
            for group in np.unique(groups):
                if int(group) not in weights:
                    continue
                mine = groups == group
                xs, ys = x[mine], y[mine][:, None]
                z = xs @ weights[int(group)].T
                p = _probability(z)
                loss = (np.logaddexp(0.0, z) - ys * z).sum(axis=0)[:, None]
                spread = p * (1.0 - p)
                second = np.stack([(xs * s[:, None]).T @ xs for s in spread.T])
                _add(sums, int(group), np.hstack([loss, (p - ys).T @ xs, second.reshape(len(second), -1)]))
        yield _batch(sums, TaskContext.get().partitionId() % slots)

    def over_sums(batches):
        sums = {}
        for batch in batches:
            for group, cells in zip(batch.column(0).to_pylist(), batch.column(2)):
                _add(sums, group, cells.values.to_numpy())
        yield _batch(sums, 0)

    partial = rows.select("fit_group", "y", "x").mapInArrow(over_rows, _SUMS)
    found = {}
    for row in partial.repartition(slots, "slot").mapInArrow(over_sums, _SUMS).collect():
        _add(found, row["fit_group"], np.array(row["sums"]))
    return {g: s.reshape(len(weights[g]), -1) for g, s in found.items()}


class _Fit:
    """The state of one model: the best coefficients so far and the step that is tried."""

    def __init__(self, width: int, penalty: float):
        self.penalty = np.append(np.full(width, float(penalty)), 0.0)
        self.best = self.trial = np.zeros(width + 1)
        self.loss, self.done = np.inf, False

    def update(self, sums: np.ndarray, n: int) -> None:
        d = len(self.trial)
        loss = sums[0] + 0.5 * (self.penalty * self.trial**2).sum()
        if loss > self.loss + 1e-9 * abs(self.loss):
            self.trial = (self.best + self.trial) / 2  # the step went too far
            return
        self.best, self.loss = self.trial, loss
        gradient = sums[1 : d + 1] + self.penalty * self.best
        second = sums[d + 1 :].reshape(d, d) + np.diag(self.penalty + 1e-10)
        self.done = np.abs(gradient).max() <= TOLERANCE * n
        self.trial = self.best if self.done else self.best - np.linalg.solve(second, gradient)


def prepare(rows: DataFrame, group: Column, label: Column, inputs: Column) -> DataFrame:
    """Rows in the form that the other functions take; ``inputs`` is an array of doubles."""
    shaped = rows.select(
        group.cast("int").alias("fit_group"), label.cast("double").alias("y"), inputs.alias("x")
    )
    return shaped.where("fit_group IS NOT NULL AND y IS NOT NULL AND x IS NOT NULL")


def fit_logistic(rows: DataFrame, penalties: Sequence[float]) -> dict[int, np.ndarray]:
    """Coefficients, the intercept last, of every group: a row for each penalty.

    ``rows`` comes from :func:`prepare` and is read once per Newton step, so it should be
    persisted or written. Each model takes full steps while its loss falls and halves them
    otherwise; models that are done stay as they are.
    """
    shape = rows.groupBy("fit_group").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d")).collect()
    fits = {r["fit_group"]: [_Fit(r["d"], p) for p in penalties] for r in shape}
    sizes = {r["fit_group"]: r["n"] for r in shape}
    for _ in range(STEPS):
        open_ = {g: np.stack([f.trial for f in fs]) for g, fs in fits.items() if not all(f.done for f in fs)}
        if not open_:
            break
        for group, sums in derivatives(rows, open_).items():
            for fit, own in zip(fits[group], sums):
                if not fit.done:
                    fit.update(own, sizes[group])
    return {g: np.stack([f.best for f in fs]) for g, fs in fits.items()}


def score_logistic(
    rows: DataFrame, weights: dict[int, np.ndarray], candidates: Sequence[int]
) -> DataFrame:
    """(candidate, fit_group, p, y): each row scored by all models of its group.

    ``candidates`` names the models in the order of their penalties.
    """

    def score(batches):
        names = np.array(candidates, np.int32)
        for batch in batches:
            groups, y = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            x = _matrix(batch.column(2))
            p = np.full((len(y), len(names)), 0.5)
            for group in np.unique(groups):
                if int(group) in weights:
                    mine = groups == group
                    p[mine] = _probability(x[mine] @ weights[int(group)].T)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.tile(names, len(y))),
                    pa.array(np.repeat(groups, len(names)).astype(np.int32)),
                    pa.array(p.ravel()),
                    pa.array(np.repeat(y, len(names))),
                ],
                names=["candidate", "fit_group", "p", "y"],
            )

    return rows.select("fit_group", "y", "x").mapInArrow(
        score, "candidate int, fit_group int, p double, y double"
    )
