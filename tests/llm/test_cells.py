"""Near-duplicate vectors in blocks that tasks read past each other."""

import tracemalloc

import numpy as np
import pytest

from tidewatch.llm import cells


def brute_force(x, w, threshold=0.95):
    """Links (copies count) and smallest reachable number of every row."""
    x = np.float32(x).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= threshold
    n = linked @ w - 1
    least = np.arange(len(x))
    while True:
        new = np.minimum(least, np.where(linked, least[None, :], len(x)).min(axis=1))
        if (new == least).all():
            return n, least
        least = new


def test_centroids_are_fitted_without_all_products_at_once():
    x = cells.unit(np.random.default_rng(3).normal(size=(20_000, 4)))
    tracemalloc.start()
    centres = cells.fit_centroids(x, 512)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(centres) == 512 and np.allclose(np.linalg.norm(centres, axis=1), 1)
    assert peak < 8 * len(x) * len(centres) / 2  # products of all rows and all centroids took 8 bytes each


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_of_groups_and_files(spark, monkeypatch, kind):
    """Several groups of held blocks, several files, cells in many blocks, visitors in several crowds."""
    for name, value in (("CELL_ROWS", 100), ("MEMBERS", 16), ("VISITORS", 24), ("CELLS", 3), ("SHARD", 40 * 90), ("HELD", 40 * 300)):
        monkeypatch.setattr(cells, name, value)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 4)) @ rng.normal(size=(4, 40)) + 0.02 * rng.normal(size=(900, 40))
    x = np.r_[x, x[:1] + 0.05 * rng.normal(size=(120, 40)), rng.normal(size=(300, 40))] * rng.choice([1e-3, 1, 1e30], (1320, 1))
    x = np.float32(x).astype(float)
    w = np.where(np.arange(len(x)) % 50 == 7, 3, 1)
    n_links, least = brute_force(x, w)
    rows = [(i + 10_000 * k, v) for i, v in enumerate(x.tolist()) for k in range(w[i])]
    made = {}

    def settled(df, name, keep=cells.settled):
        made[name] = keep(df, name)
        return made[name]

    monkeypatch.setattr(cells, "settled", settled)
    got = cells.near_duplicates(spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>")).toPandas().sort_values("vec_id")
    stored = made["stored"].toPandas()
    assert stored["rows"].sum() == len(x) and stored["rows"].max() <= 16  # every vector is written once
    assert stored["file"].nunique() > 10 and (stored.groupby("home")["rows"].sum() > 64).any()
    at = got.vec_id.to_numpy() % 10_000
    assert (got.n_links.to_numpy() == n_links[at]).all() and (got.component_id.to_numpy() == least[at]).all()
    assert (got.kept == (got.vec_id == got.component_id)).all()


def test_visits_do_not_depend_on_company():
    """Whether a vector visits a cell comes out the same alone and among others, however close the call."""
    rng = np.random.default_rng(4)
    centres = cells.unit(rng.normal(size=(30, 12)))
    space = cells.Space(centres, np.linalg.qr(rng.normal(size=(12, 12)))[0], 0.95)
    u = cells.unit(rng.normal(size=(400, 12)))
    raw = u.astype(np.float32)
    home, _ = cells.nearest(u, centres)
    best = (cells.unit(raw.astype(float)) * centres[home]).sum(axis=1)
    apart = np.sqrt(2 - 2 * (centres[home] * centres[(home + 1) % 30]).sum(axis=1))
    near = (cells.unit(raw.astype(float)) * centres[(home + 1) % 30]).sum(axis=1)
    best[:200] = (near + space.border * apart + cells.ROUNDING)[:200]  # calls that are as close as can be
    x = space.form(raw)
    all_ = space.visiting(x, raw, best, home, np.arange(30))
    for r in range(0, 400, 7):
        one = space.visiting(x[r : r + 1], raw[r : r + 1], best[r : r + 1], home[r : r + 1], np.arange(30)[::-1])
        assert (one[::-1, 0] == all_[:, r]).all()
    assert all_.any() and not all_[home, np.arange(400)].any()
