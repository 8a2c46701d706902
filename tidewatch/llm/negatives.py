"""Hard negatives of anchors: rows of another label that score just below a positive.

Vectors become floor(256 x) per component. Both steps, an anchor's best rows of its own label
and the best rows of other labels inside a window below a positive's score, are threshold
joins of the anchors with all rows. Rows are dealt evenly into shards, and a shard holds an
inverted index per piece of ``PIECE`` rows:

* dimensions are ordered by their mass in the piece, and a row's trailing dimensions are left
  out of the index as long as their length times that of any anchor is below every threshold
  of the turn: such dimensions alone cannot make a link;
* rows are ordered by the number of dimensions they have in the index, so the postings of a
  dimension are the first rows, and partial scores are added up in groups of dimensions;
* after a group a row's score is at most its partial score plus the product of the lengths
  of what remains of both vectors; rows below the threshold are pruned, and the rest are
  scored again in whole numbers.

Thresholds start near the top. Windows that are full, or whose threshold has reached their
lower end, are done; the others are searched again with a lower threshold, the last of which
is the window's lower end, so results are exact. Inside a shard a window's threshold grows
to its k-th best score. Anchors are written in blocks to the shared folder, and a shard reads
one block at a time.

Rows with a null id, a null label, a null vector or a null or non-finite component take no
part; a shorter vector counts as having zeros at its end. Rows that repeat an id are rows of
their own, except that a row with an anchor's id is not its positive. Equal scores are
ordered by id. Scores are held in longs: those beyond 2^62 are cut to that. Other columns,
whatever their names, are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, open_file, partitions_for, write_whole
from tidewatch.llm.kdtree import matrix, scaled, usable
from tidewatch.session import work_dir

SHARD_ROWS = 1 << 15
LEAST_ROWS = 1 << 11  # of a shard, before there is one for every task
PIECE = 4096
ANCHORS = 256  # of a block
GROUP = 8  # dimensions added up between two looks at the bounds
SLACK = 1e-9
EXACT = 1 << 53
MOST = 1 << 62
LEAST = -MOST
TURNS = (0.5, 0.25)  # of the product of lengths: thresholds for positives before there is none
DEPTHS = (0.125, 0.5)  # of a window, from its upper end, before the whole window


class Index:
    """Inverted index of a piece for thresholds of at least ``limit`` times an anchor's length."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, limit: float):
        self.dims = np.argsort(-(x * x).sum(axis=0), kind="stable")
        x = x[:, self.dims]
        tail = np.sqrt(np.cumsum((x * x)[:, ::-1], axis=1)[:, ::-1])  # length from a dimension on
        held = (tail * (1 + SLACK) >= limit).sum(axis=1) if limit > 0 else np.full(len(x), x.shape[1])
        order = np.argsort(-held, kind="stable")
        self.ids, self.labels, self.x, self.held = ids[order], labels[order], x[order], held[order]
        self.tail = np.c_[tail[order], np.zeros(len(x))]
        self.most = float(np.abs(x).max(initial=0.0))
        self.live = int((held > 0).sum()) if limit > 0 else len(x)  # others cannot reach a threshold

    def candidates(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(anchor, row) pairs that may score at least the anchor's threshold."""
        q = anchors[:, self.dims]
        after = np.c_[np.sqrt(np.cumsum((q * q)[:, ::-1], axis=1)[:, ::-1]), np.zeros(len(q))]
        size = np.abs(after[:, 0]) * self.tail[:, 0].max(initial=0.0) * SLACK + 1e-6
        floor = least.astype(float) - size
        sums = np.zeros((len(q), self.live))
        rows = np.arange(self.live)
        for a in range(0, q.shape[1], GROUP):
            b = min(a + GROUP, q.shape[1])
            posted = int(np.searchsorted(-self.held, -a, side="left"))  # rows with dimension a in the index
            part = int(np.searchsorted(rows, posted))  # those that are left of them
            if not part:
                break
            sums[:, :part] += q[:, a:b] @ self.x[rows[:part], a:b].T
            # What an anchor and a row have from the next dimension on bounds what can be added.
            done = np.where(np.arange(len(rows)) < part, b, np.minimum(-(-self.held[rows] // GROUP) * GROUP, b))
            good = (sums + after[:, done] * self.tail[rows, done] >= floor[:, None]).any(axis=0)
            if good.sum() < 0.7 * len(rows):
                rows, sums = rows[good], sums[:, good]
        done = np.minimum(-(-self.held[rows] // GROUP) * GROUP, q.shape[1])
        pair, column = np.nonzero(sums + after[:, done] * self.tail[rows, done] >= floor[:, None])
        return pair, rows[column]

    def scores(self, anchors: np.ndarray, pair: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Inner products in whole numbers."""
        q = anchors[:, self.dims]
        if self.most * np.abs(q).sum(axis=1).max(initial=0.0) < EXACT:
            if len(pair) * 16 > len(q) * len(self.x):
                return (q @ self.x.T)[pair, row].astype(np.int64)
            out = np.empty(len(pair), np.int64)
            for at in range(0, len(pair), 1 << 16):
                part = slice(at, at + (1 << 16))
                out[part] = np.einsum("ij,ij->i", q[pair[part]], self.x[row[part]])
            return out
        whole = lambda v: [int(c) for c in v]
        products = (sum(u * v for u, v in zip(whole(q[i]), whole(self.x[j]))) for i, j in zip(pair, row))
        return np.array([max(LEAST + 1, min(MOST, p)) for p in products], np.int64)


def best_in_windows(shard: pd.DataFrame, blocks, width: int, limit: float, k: int, same: bool) -> pd.DataFrame:
    """(anchor, window, id, score): the k best rows of a shard in every window of every anchor.

    A block holds anchors (key, id, label, x) and windows (owner, number, low, high).
    """
    ids, labels = shard["vec_id"].to_numpy(), shard["label"].to_numpy()
    x = matrix(pa.ListArray.from_pandas(shard["x"]), width) if width else np.zeros((len(shard), 0))
    pieces = [Index(ids[a : a + PIECE], labels[a : a + PIECE], x[a : a + PIECE], limit) for a in range(0, len(ids), PIECE)]
    out = []
    for block in blocks():
        low = block["low"].copy()
        best = [np.zeros(0, np.int64) for _ in range(3)]  # window, score, id
        for piece in pieces:
            least = np.full(len(block["key"]), MOST)
            np.minimum.at(least, block["owner"], low)
            pair, row = piece.candidates(block["x"], least)
            alike = piece.labels[row] == block["label"][pair]
            take = alike & (piece.ids[row] != block["id"][pair]) if same else ~alike
            pair, row = pair[take], row[take]
            score = piece.scores(block["x"], pair, row)
            first, last = np.searchsorted(pair, block["owner"]), np.searchsorted(pair, block["owner"], side="right")
            new = [best]
            for w in range(len(low)):  # at most k times the anchors of a block
                s = score[first[w] : last[w]]
                inside = np.flatnonzero((s >= low[w]) & (s <= block["high"][w]))
                if len(inside) > k:  # the k best and what ties with the k-th
                    inside = inside[s[inside] >= np.partition(s[inside], len(inside) - k)[len(inside) - k]]
                if len(inside):
                    new.append([np.full(len(inside), w), s[inside], piece.ids[row[first[w] : last[w]][inside]]])
            window, score, found = (np.concatenate([n[c] for n in new]) for c in range(3))
            order = np.lexsort((found, -score, window))
            window, score, found = window[order], score[order], found[order]
            begin = np.searchsorted(window, window)
            good = np.arange(len(window)) - begin < k
            best = [window[good], score[good], found[good]]
            full = np.flatnonzero(np.arange(len(window)) - begin == k - 1)
            low[window[full]] = np.maximum(low[window[full]], score[full])
        window, score, found = best
        out.append(pd.DataFrame({
            "anchor": block["key"][block["owner"][window]], "number": block["number"][window], "vec_id": found, "score": score,
        }))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("anchor", "number", "vec_id", "score")})


def threshold_join(rows: DataFrame, shards: int, windows: DataFrame, width: int, limit: float, k: int, same: bool) -> DataFrame:
    """(anchor, number, vec_id, score): the k best rows of every shard in every window.

    ``windows`` are (at, vec_id, label, x, number, low, high), a row for every window.
    """
    spark = rows.sparkSession
    uri = work_dir(spark, "anchors")
    count = windows.agg(F.approx_count_distinct("at")).first()[0]
    blocks = max(1, -(-count // ANCHORS))

    def save(key, group):
        group = group.sort_values(["at", "number"])
        first = group.drop_duplicates("at")
        made = {
            "key": first["at"].to_numpy(np.int64),
            "id": first["vec_id"].to_numpy(np.int64),
            "label": first["label"].to_numpy(np.int64),
            "x": matrix(pa.ListArray.from_pandas(first["x"]), width) if width else np.zeros((len(first), 0)),
            "owner": np.searchsorted(first["at"].to_numpy(), group["at"].to_numpy()),
            "number": group["number"].to_numpy(np.int32),
            "low": group["low"].to_numpy(np.int64),
            "high": group["high"].to_numpy(np.int64),
        }
        raw = io.BytesIO()
        np.savez(raw, **made)
        write_whole(uri, f"block-{key[0]:08d}.npz", [raw.getvalue()])
        return pd.DataFrame({"block": [key[0]]})

    spread = windows.withColumn("block", F.pmod(F.xxhash64("at"), F.lit(blocks)).cast("int"))
    written = kept(spread.groupBy("block").applyInPandas(save, "block int"), "blocks")
    names = [f"block-{r.block:08d}.npz" for r in written.toLocalIterator()]

    def read():
        for name in names:
            with open_file(uri, name) as file:
                yield dict(np.load(io.BytesIO(file.read())))

    def search(group: pd.DataFrame) -> pd.DataFrame:
        return best_in_windows(group, read, width, limit, k, same)

    shard = F.pmod(F.xxhash64("at", F.lit("shard")), F.lit(shards)).cast("int")
    # A number of partitions that is asked for stays: shards are small in bytes and long in work.
    dealt = rows.withColumn("shard", shard).repartition(shards, "shard").groupBy("shard")
    return kept(dealt.applyInPandas(search, "anchor long, number int, vec_id long, score long"), "found")


def best(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("anchor", "number").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k)


def filled(rows: DataFrame, shards: int, windows: DataFrame, lows: list[Column], width: int, k: int, same: bool) -> DataFrame:
    """The k best rows (anchor, number, vec_id, score, rank) of windows, with ever lower thresholds.

    ``windows`` have an ``end`` as their lowest threshold; ``lows`` are the thresholds of the
    turns before it.
    """
    out, todo = None, windows
    for turn in [*lows, F.col("end")]:
        asked = todo.withColumn("low", F.greatest(turn.cast("long"), F.col("end")))
        # Least threshold per unit of an anchor's length; none where thresholds are not positive.
        limit = asked.agg(F.min(F.when(F.col("low") > 0, F.col("low") / F.col("norm")).otherwise(0.0))).first()[0]
        if limit is None:
            break
        got = kept(best(threshold_join(rows, shards, asked, width, limit, k, same), k), "best")
        full = got.groupBy("anchor", "number").agg(F.max("rank").alias("_n"))
        state = asked.join(full.select(F.col("anchor").alias("at"), "number", "_n"), ["at", "number"], "left")
        done = (F.coalesce("_n", F.lit(0)) >= k) | (F.col("low") == F.col("end"))
        marked = kept(state.withColumn("_done", done), "windows")
        ready = marked.where("_done").select(F.col("at").alias("anchor"), "number")
        part = got.join(ready, ["anchor", "number"], "left_semi")
        out = part if out is None else out.unionByName(part)
        todo = marked.where(~F.col("_done")).drop("_n", "_done", "low")
    return out


def hard_negatives(
    vectors: DataFrame,
    label: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    For every anchor and each of its best ``positives`` rows of the same label, the best
    ``negatives`` rows of other labels whose score is between the two percentages of the
    positive's. ``label`` and ``is_anchor`` are columns over ``vectors``.
    """
    spark = vectors.sparkSession
    chosen = vectors.where(usable() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        scaled().alias("x"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"),
    )
    rows = kept(chosen.where(F.col("label").isNotNull()).withColumn("at", F.monotonically_increasing_id()), "vectors")
    norm = F.expr("sqrt(aggregate(x, 0D, (s, v) -> s + v * v))")
    facts = rows.agg(F.count(F.lit(1)), F.max(F.size("x")), F.max(norm)).first()
    n, width, longest = facts[0], facts[1] or 0, facts[2] or 0.0
    shards = max(1, -(-n // SHARD_ROWS), min(partitions_for(spark), -(-n // LEAST_ROWS)))
    points = rows.select("at", "vec_id", "label", "x")
    anchors = rows.where("asked").select("at", "vec_id", "label", "x", norm.alias("norm"))
    open_ = anchors.select("*", F.lit(0).alias("number"), F.lit(MOST).alias("high"), F.lit(LEAST).alias("end"))
    reach = F.least(F.col("norm") * longest, F.lit(float(MOST)))
    own = filled(points, shards, open_, [F.floor(reach * t) for t in TURNS], width, positives, True)
    if own is None:
        return spark.createDataFrame([], RESULT)
    own = own.select(
        F.col("anchor").alias("at"), F.col("rank").cast("int").alias("number"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    exact = F.col("positive_score").cast("decimal(19,0)")
    asked = own.join(anchors, "at").withColumns({
        "end": F.ceil(exact * window[0] / 100).cast("long"), "high": F.floor(exact * window[1] / 100).cast("long"),
    }).where(F.col("end") <= F.col("high"))
    asked = kept(asked, "asked")
    depth = F.col("high") - F.col("end")
    lows = [F.col("high") - F.ceil(depth * d) for d in DEPTHS]
    mined = filled(points, shards, asked.drop("positive_id", "positive_score"), lows, width, negatives, False)
    if mined is None:
        return spark.createDataFrame([], RESULT)
    found = mined.withColumnsRenamed({"anchor": "at", "vec_id": "negative_id", "score": "negative_score"})
    pairs = asked.select("at", "number", F.col("vec_id").alias("anchor_id"), "positive_id", "positive_score")
    return found.join(pairs, ["at", "number"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
