"""Near-duplicate texts by SetSketch registers.

A text is the set of its word shingles. Register i keeps the smallest value of an exponential
draw per shingle, stored as a truncated logarithm with base b; registers of unions are
register-wise maxima, so sketches merge, and equal registers become likelier with the Jaccard
similarity. Texts with equal sets are one node. Bands of registers are hashed to buckets.
A bucket's hubs are its nodes with the least digests, and every node is paired with a few of
the hubs of its buckets; the joint likelihood of the registers of a pair and of the two known set sizes gives an estimate
that discards clear misses, and the rest is decided on the full sets. Links make components;
a bucket that still spans several components is taken again with other hubs, and what
remains after some rounds is compared across components in blocks. So a large group of
copies costs a few pairs per member, and no link between two groups is lost.

Texts without words, null texts and rows without id have size 0 or link with nothing;
repeated rows are copies; an empty table gives no rows.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, partitions_for, text_or_empty
from tidewatch.llm.components import components

BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
REGISTERS, PER_BAND = 128, 4
HUBS, ROUNDS = 3, 2
PER_ROW = 8  # estimates per row of a bucket that a last comparison may take
BLOCK = 1024
SLACK = 0.25  # estimates this much below the threshold are misses (7 standard deviations; at 0.15 one link in 21,500 was lost)
CACHED_WORDS = 300_000
CACHED_TEXTS = 2_000
GRID = np.linspace(0.0, 1.0, 101)
A, B = (
    np.random.default_rng(s).integers(1, 1 << 32, REGISTERS, dtype=np.uint64).astype(np.uint32) | np.uint32(1) for s in (5, 6)
)
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD)


def shingles(text: str, size: int, known: dict[bytes, int]) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text."""
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    got = list(map(known.get, words))
    if None in got:
        for i, h in enumerate(got):
            if h is None:
                got[i] = h = xxhash.xxh3_64_intdigest(words[i])
                if len(known) < CACHED_WORDS:
                    known[words[i]] = h
    h = np.array(got, np.uint64)
    n = min(size, len(h))
    mixed = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        mixed = (mixed ^ h[k : len(h) - n + 1 + k]) * np.uint64(ODD[0])
        mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(ODD[2])
    mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def sketch(items: np.ndarray) -> np.ndarray:
    """Registers of a set of 64-bit hashes."""
    low = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    lo, hi = items.astype(np.uint32), (items >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(items), 1024):
        draw = lo[at : at + 1024, None] * A
        draw ^= hi[at : at + 1024, None] * B
        np.minimum(low, draw.min(axis=0), out=low)
    least = -np.log1p(-(low + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP).astype(np.uint16)


def likeliest(above: np.ndarray, below: np.ndarray, m: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Jaccard similarity of largest likelihood, given the number of registers in which the
    first of two sets of sizes m and n is above and below the second."""
    u, v = (m / (m + n))[:, None], (n / (m + n))[:, None]
    most = np.minimum(m, n) / np.maximum(m, n)
    j = GRID * most[:, None]
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    same = REGISTERS - above - below
    safe = lambda x: np.log(np.maximum(x, 1e-12))
    value = above[:, None] * safe(up) + below[:, None] * safe(down) + same[:, None] * safe(1 - up - down)
    return j[np.arange(len(j)), value.argmax(axis=1)]


def registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n, node, sketch) of every document; equal sets have equal nodes."""

    def make(batches):
        known: dict[bytes, int] = {}
        seen: dict[int, tuple] = {}
        for batch in batches:
            out = []
            for text in batch.column(1).to_pylist():
                key = xxhash.xxh3_128_intdigest(text.encode("utf-8", "replace"))
                got = seen.get(key)
                if got is None:
                    items = shingles(text, size, known)
                    node = np.uint64(xxhash.xxh3_64_intdigest(items.tobytes())).view(np.int64)
                    got = (len(items), int(node), sketch(items).tobytes() if len(items) else b"")
                    if len(seen) >= CACHED_TEXTS:
                        seen.clear()
                    seen[key] = got
                out.append(got)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0)]
                + [pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                names=["doc_id", "n", "node", "sketch"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty()).mapInArrow(
        make, "doc_id long, n long, node long, sketch binary"
    )


def banded(nodes: DataFrame) -> DataFrame:
    """(bucket, band, node) for every band of a node's registers."""

    def split(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                r = registers(part.column(1)).astype(np.uint64).reshape(part.num_rows, -1, PER_BAND)
                key = np.broadcast_to(np.arange(r.shape[1], dtype=np.uint64), r.shape[:2]).copy()
                for i in range(PER_BAND):
                    key = (key ^ r[:, :, i]) * np.uint64(ODD[0])
                    key ^= key >> np.uint64(31)
                key *= np.uint64(ODD[1])
                node = np.repeat(part.column(0).to_numpy(), r.shape[1])
                band = np.tile(np.arange(r.shape[1], dtype=np.int32), len(r))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.ravel().view(np.int64)), pa.array(band), pa.array(node)], names=["bucket", "band", "node"]
                )

    return nodes.select("node", "sketch").mapInArrow(split, "bucket long, band int, node long")


def estimated(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) that the sketches do not rule out."""
    side = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    joined = joined.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * int(100 * threshold))

    def keep(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = registers(batch.column(2)), registers(batch.column(3))
                m, n = (batch.column(c).to_numpy().astype(float) for c in (4, 5))
                near = np.flatnonzero((x == y).sum(axis=1) >= (threshold - SLACK) * REGISTERS)
                x, y = x[near], y[near]
                good = near[likeliest((x > y).sum(axis=1), (x < y).sum(axis=1), m[near], n[near]) >= threshold - SLACK]
                yield batch.select(["a", "b"]).take(pa.array(good))

    return joined.select("a", "b", "sa", "sb", "na", "nb").mapInArrow(keep, "a long, b long")


def full_sets(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, items) of the wanted nodes, from their texts."""
    asked = wanted.join(nodes.select("node", "doc_id"), "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty()).join(asked, "doc_id")

    def full(batches):
        known: dict[bytes, int] = {}
        for batch in batches:
            sets = [shingles(t, size, known) for t in batch.column(1).to_pylist()]
            # A repeated id may come with another text.
            same = [
                int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)) == node
                for s, node in zip(sets, batch.column(2).to_pylist())
            ]
            made = pa.RecordBatch.from_arrays([batch.column(2), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "items"])
            yield made.filter(pa.array(same, pa.bool_()))

    made = texts.select("doc_id", "text", "node").mapInArrow(full, "node long, items binary")
    return made.dropDuplicates(["node"])


def common(x: np.ndarray, y: np.ndarray) -> int:
    at = np.searchsorted(y, x)
    return int((y[np.minimum(at, len(y) - 1)] == x).sum())


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose full sets are as similar as asked."""
    side = lambda c: sets.select(F.col("node").alias(c), F.col("items").alias(f"s{c}"))

    def check(batches):
        percent = int(round(100 * threshold))
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = common(x, y)
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def across(unsettled: DataFrame, nodes: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links between different components in a bucket, enough to join what belongs together.

    A bucket is compared in blocks; a pair is tested in the first bucket that both share, and
    only while its components are still apart. Nothing but links leaves a task.
    """
    blocks = unsettled.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("k"))
    own = F.pmod(F.xxhash64("node", F.lit("block")), F.col("k"))
    dealt = (
        unsettled.join(blocks, "bucket")
        .withColumn("own", own)
        .select("bucket", "band", "node", "root", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)).alias("other"))
        .select("bucket", "band", "node", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        .join(nodes.select("node", "n", "sketch"), "node")
        .join(sets, "node")
    )

    def cross(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        _, i, j = key
        percent = int(round(100 * threshold))
        group = group.sort_values("node")
        left = np.flatnonzero((group["own"] == i).to_numpy())
        right = np.flatnonzero((group["own"] == j).to_numpy())
        band, node = int(group["band"].iat[0]), group["node"].to_numpy()
        x = np.frombuffer(b"".join(group["sketch"]), np.uint16).reshape(len(group), REGISTERS // PER_BAND, PER_BAND)
        n = group["n"].to_numpy().astype(float)
        items = [np.frombuffer(s, np.uint64) for s in group["items"]]
        roots, part = np.unique(group["root"].to_numpy(), return_inverse=True)
        out = []
        for r in left if len(roots) > 1 else ():
            cols = right[right > r] if i == j else right
            cols = cols[part[cols] != part[r]]
            cols = cols[np.minimum(n[r], n[cols]) * 100 >= percent * np.maximum(n[r], n[cols])]
            if not len(cols):
                continue
            if band:  # shared in an earlier band: tested there
                cols = cols[~(x[cols, :band] == x[r, :band]).all(axis=2).any(axis=1)]
            a, b = x[r].ravel(), x[cols].reshape(len(cols), REGISTERS)
            same = (a == b).sum(axis=1)
            near = same >= (threshold - SLACK) * REGISTERS  # equal registers alone rule out most pairs
            cols, b = cols[near], b[near]
            if not len(cols):
                continue
            est = likeliest((a > b).sum(axis=1), (a < b).sum(axis=1), np.full(len(cols), n[r]), n[cols])
            order = np.argsort(-est, kind="stable")
            for c in cols[order[: int((est >= threshold - SLACK).sum())]]:
                if part[c] != part[r]:
                    both = common(items[r], items[c])
                    if 100 * both >= percent * (len(items[r]) + len(items[c]) - both):
                        part[part == part[c]] = part[r]
                        out.append((node[r], node[c]))
        return pd.DataFrame({"a": [min(p) for p in out], "b": [max(p) for p in out]}, dtype="int64")

    dealt = dealt.repartition(partitions_for(unsettled.sparkSession), "bucket", "i", "j")
    return dealt.groupBy("bucket", "i", "j").applyInPandas(cross, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of (doc_id, text)."""
    every = kept(sketched(docs, size), "sketches")
    nodes = kept(
        every.where("n > 0 AND doc_id IS NOT NULL")
        .groupBy("node")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")),
        "nodes",
    )
    bands = kept(banded(nodes), "bands")
    open_buckets = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("bucket")
    shared = kept(bands.join(open_buckets, "bucket"), "shared")
    sets = kept(full_sets(shared.select("node").distinct(), docs, nodes, size), "sets")
    rows = shared.count()
    links, turn = None, 0
    unsettled, last = shared.withColumn("root", F.col("node")), False
    while True:
        if last:
            new = kept(across(unsettled, nodes, sets, threshold), "links")
        else:
            drawn = [F.struct(F.xxhash64("node", F.lit(turn * HUBS + h)).alias("d"), "node", "root") for h in range(HUBS)]
            hubs = unsettled.groupBy("bucket").agg(*[F.min(d).alias(f"h{h}") for h, d in enumerate(drawn)])
            # Of the hubs of its buckets a node meets at most HUBS, those with the least digests.
            met = unsettled.join(hubs, "bucket").groupBy("node").agg(
                *[F.min(F.when(F.col(f"h{h}.root") != F.col("root"), F.col(f"h{h}"))).alias(f"h{h}") for h in range(HUBS)]
            )
            pairs = (
                met.select("node", F.explode(F.array(*[f"h{h}.node" for h in range(HUBS)])).alias("hub"))
                .where("hub IS NOT NULL")
                .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
                .distinct()
            )
            likely = kept(estimated(pairs, nodes, threshold), "likely")
            new = kept(verified(likely, sets, threshold), "links")
        links = new if links is None else links.unionByName(new)
        roots = components(links)
        if last:
            break
        labelled = shared.join(roots, "node", "left").select("bucket", "band", "node", F.coalesce("root", "node").alias("root"))
        parts = labelled.groupBy("bucket", "root").agg(F.count(F.lit(1)).cast("double").alias("c"))
        several = kept(
            parts.groupBy("bucket")
            .agg(F.sum("c").alias("k"), F.sum(F.col("c") * F.col("c")).alias("s"), F.count(F.lit(1)).alias("roots"))
            .where("roots > 1")
            .select("bucket", ((F.col("k") * F.col("k") - F.col("s")) / 2).alias("work")),
            "several",
        )
        work = several.agg(F.sum("work")).first()[0]
        if not work:
            break
        unsettled = kept(labelled.join(several.select("bucket"), "bucket"), "unsettled")
        turn += 1
        # Comparing across components costs no more than the rows there are, or hubs no longer help.
        last = work <= PER_ROW * rows or turn == ROUNDS
    named = nodes.select("node", "doc_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("least"))
    info = named.join(least, "root").select("node", "least")
    linked = every.withColumn("node", F.when(F.col("n") > 0, F.col("node")))
    joined = linked.join(info, "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
