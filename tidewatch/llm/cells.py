"""Near-duplicate vectors by spherical k-means cells and blocked cosine products.

Equal vectors are one node with a weight. Centroids are fitted on a bounded sample of nodes;
every node belongs to the cell of its nearest centroid and visits the cells whose border is
within half the link distance. The distances of two linked nodes to the border between their
cells add up to no more than the link distance, so one of them visits the other's cell and
every link is found. Members of a cell meet each other and its
visitors in blocks, as matrix products. Members within half the link
angle of their centroid, its core, are linked with each other by the triangle inequality and
are not compared: blocks of the core meet only blocks of other members and of visitors, so a
tight group is not dealt against itself. Blocks give sums of weights and the smallest node that is reached, never lists of
pairs, so a dense cell costs products but no rows.

Vectors are written once, in blocks of one cell each; a task holds the blocks of some cells and
reads all others past them, so a vector that visits many cells is not copied for each. A product
starts with a bound in single precision: the components along the axes of most spread, and the
lengths of what is left. Only rows and columns that may reach the threshold meet in double precision.

Vectors that are null, zero, or hold null or non-finite components, and rows without id,
link with nothing; shorter vectors have zeros at their end; repeated rows are copies; an
empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import open_file, partitions_for, settled, write_whole
from tidewatch.llm.components import components, smallest_reachable
from tidewatch.llm.kdtree import matrix, usable
from tidewatch.session import work_dir

CELL_ROWS = 512
MOST_CELLS = 4096
SAMPLE = 20_000  # nodes that fit the centroids, in expectation
ROUNDS = 12
MEMBERS = 1024  # members of a cell in a block
VISITORS = 4096
ROUNDING = 1e-7  # above the rounding error of a distance between centroids
AXES = 31  # axes of most spread that a bound takes
SHARD = 1 << 19  # components in a file of blocks
HELD = 1 << 23  # components that a task holds
CHUNK = 1024  # rows that meet all centroids at once
CELLS = 256  # centroids that meet a file's rows at once


def unit(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and cosine of every row's nearest centroid, for a few rows at a time."""
    home, best = np.empty(len(x), np.int64), np.empty(len(x), centres.dtype)
    for at in range(0, len(x), CHUNK):
        near = x[at : at + CHUNK] @ centres.T
        home[at : at + CHUNK] = near.argmax(axis=1)
        best[at : at + CHUNK] = near.max(axis=1)
    return home, best


def fit_centroids(x: np.ndarray, cells: int, seed: int = 11) -> np.ndarray:
    """Spherical k-means: nearest centroid by cosine, centroid = normed sum."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(ROUNDS):
        home, best = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1)
        empty = norms < 1e-9
        sums[~empty] /= norms[~empty, None]
        if empty.any():  # move unused centroids to the worst-placed vectors
            worst = np.argsort(best, kind="stable")[: int(empty.sum())]
            sums[empty] = x[worst]
        centres = sums
    return centres


def units_of(home: int, core: bool, visits: list[int], mixed: int, rim: np.ndarray, cores: np.ndarray, crowds: np.ndarray):
    """(cell, i, j, left, right) of the pairs of blocks that a node is part of.

    The member blocks of a cell are its ``rim`` blocks and then its ``cores`` blocks; a pair
    has i <= j <= rim blocks, or i of the rim and j of the core, or i of any member and
    -1 - j of its ``crowds`` blocks of visitors.
    """
    edge = rim[home]
    if core:
        own = edge + mixed % cores[home]
        units = [(home, j, own, False, True) for j in range(edge)]
    else:
        own = mixed % edge
        units = [(home, min(own, j), max(own, j), own <= j, own >= j) for j in range(edge)]
        units += [(home, own, edge + j, True, False) for j in range(cores[home])]
    units += [(home, own, -1 - g, True, False) for g in range(crowds[home])]
    for c in visits:
        if crowds[c]:
            units += [(c, i, -1 - mixed % crowds[c], False, True) for i in range(rim[c] + cores[c])]
    return units


class Space:
    """Centroids, the axes of most spread, and what they tell of vectors."""

    def __init__(self, centres: np.ndarray, axes: np.ndarray, threshold: float):
        self.centres, self.axes, self.threshold = centres, axes.astype(np.float32), threshold
        self.spun = (centres @ axes).astype(np.float32)
        self.border = np.sqrt(2 - 2 * threshold) / 2
        self.slack = 1e-5 + 2.4e-7 * len(axes)  # above the errors of single precision

    def form(self, raw: np.ndarray) -> np.ndarray:
        """Unit vectors along the axes, in single precision, after the length of what the first axes leave."""
        out = np.empty((len(raw), 1 + len(self.axes)), np.float32)
        with np.errstate(over="ignore", invalid="ignore", under="ignore"):
            x = (raw / np.abs(raw).max(axis=1, keepdims=True)).astype(np.float32, copy=False) @ self.axes
        np.divide(x, np.sqrt(np.einsum("ij,ij->i", x, x))[:, None], out=out[:, 1:])
        rest = out[:, 1 + AXES :]
        out[:, 0] = np.sqrt(np.einsum("ij,ij->i", rest, rest))
        return out

    def visiting(self, x: np.ndarray, raw: np.ndarray, best: np.ndarray, home: np.ndarray, to: np.ndarray) -> np.ndarray:
        """Which of the cells ``to`` (rows) every vector (columns) visits.

        Close calls are decided row by row in double precision, so that they come out the same
        whatever vectors and cells are asked for together.
        """
        homes, at = np.unique(home, return_inverse=True)
        apart = np.sqrt(np.maximum(2 - 2 * self.centres[to] @ self.centres[homes].T, 0))
        beyond = best.astype(np.float32) - (self.border * apart + ROUNDING).astype(np.float32)[:, at]
        beyond -= self.spun[to] @ x[:, 1:].T
        out = beyond <= 0
        r, c = np.nonzero(np.abs(beyond) <= 2 * self.slack)
        for k in range(0, len(r), 1 << 16):
            i, j = r[k : k + (1 << 16)], c[k : k + (1 << 16)]
            there, here = self.centres[to[i]], self.centres[home[j]]
            apart = np.sqrt(np.maximum(2 - 2 * (there * here).sum(axis=1), 0))
            near = (unit(raw[j].astype(np.float64)) * there).sum(axis=1)
            out[i, j] = best[j] - near <= self.border * apart + ROUNDING
        out[to[:, None] == home[None, :]] = False
        return out


class Blocks:
    """Rows of some blocks: node, weight, cosine to the centroid, vector."""

    def __init__(self, space: Space, parts: list[tuple[bytes, int, int, bool]], width: int, kind: str):
        """``parts``: (bytes, rows, home, core) of every block."""
        sizes = np.array([p[1] for p in parts])
        self.ends = np.cumsum(sizes)
        self.node, self.w = np.empty(self.ends[-1], np.int64), np.empty(self.ends[-1], np.int64)
        self.best, self.raw = np.empty(self.ends[-1]), np.empty((self.ends[-1], width), kind)
        for (data, n, _, _), end in zip(parts, self.ends.tolist()):
            rows = slice(end - n, end)
            for column, at, of in ((self.node, 0, np.int64), (self.w, 8 * n, np.int64), (self.best, 16 * n, np.float64)):
                column[rows] = np.frombuffer(data, of, n, at)
            self.raw[rows] = np.frombuffer(data, kind, n * width, 24 * n).reshape(n, width)
        self.home = np.repeat(np.array([p[2] for p in parts], np.int64), sizes)
        self.x = space.form(self.raw)
        self.short = np.ascontiguousarray(self.x[:, : 1 + AXES])
        self.n = np.zeros(len(self.node), np.int64)

    def rows(self, k: int) -> np.ndarray:
        return np.arange(self.ends[k - 1] if k else 0, self.ends[k])

    @staticmethod
    def packed(node: np.ndarray, w: np.ndarray, best: np.ndarray, raw: np.ndarray) -> bytes:
        return b"".join(a.tobytes() for a in (node, w, best, raw))


def meet(space: Space, left: Blocks, a: np.ndarray, right: Blocks, b: np.ndarray, cell: int | None, twice: bool) -> list:
    """Count the links of rows ``a`` and ``b``; (nodes, smallest nodes reached) of what they join.

    ``cell``: where ``b`` are visitors, the cell of ``a``. ``twice``: the rows meet themselves.
    """
    bound = left.short[a] @ right.short[b].T
    least = space.threshold - space.slack
    if not bound.size or bound.max() < least:
        return []
    bound = bound >= least
    a, b = a[bound.any(axis=1)], b[bound.any(axis=0)]
    linked = unit(left.raw[a].astype(np.float64)) @ unit(right.raw[b].astype(np.float64)).T >= space.threshold
    if cell is None:
        linked &= left.node[a][:, None] != right.node[b][None, :]
    else:
        # Found in the guest's cell too: count it in the cell with the smaller number.
        homes = right.home[b]
        others = np.unique(homes[linked.any(axis=0) & (homes < cell)])
        if len(others):
            mutual = space.visiting(left.x[a], left.raw[a], left.best[a], left.home[a], others)
            for other, back in zip(others, mutual):
                linked[np.ix_(back, homes == other)] = False
    rows, cols = linked.any(axis=1), linked.any(axis=0)
    linked, a, b = linked[np.ix_(rows, cols)], a[rows], b[cols]
    if not len(a):
        return []
    left.n[a] += linked @ right.w[b]
    if not twice:
        right.n[b] += left.w[a] @ linked
    x, y = left.node[a], right.node[b]
    root_x, root_y = smallest_reachable(linked, x, y)
    return [(x, root_x)] if twice else [(x, root_x), (y, root_y)]


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of (vec_id, embedding)."""
    spark = vectors.sparkSession
    nonzero = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumn(
        "node", F.when(usable() & nonzero & F.col("vec_id").isNotNull(), F.xxhash64("embedding"))
    )
    single = rows.schema["embedding"].dataType.simpleString() == "array<float>"
    kind = "<f4" if single else "<f8"
    nodes = settled(
        rows.where("node is not null")
        .groupBy("node", "embedding")
        .agg(F.count(F.lit(1)).alias("w"), F.min("vec_id").alias("first"))
        .select("node", "w", "first", (F.col("embedding") if single else F.transform("embedding", lambda x: x.cast("double"))).alias("x")),
        "vectors",
    )
    n, width = nodes.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    cells = min(MOST_CELLS, -(-n // CELL_ROWS))

    def learn(batches):
        parts = [(b.column(0).to_numpy(), matrix(b.column(1), width)) for b in batches if b.num_rows]
        order = np.argsort(np.concatenate([p[0] for p in parts])) if parts else []
        x = unit(np.concatenate([p[1] for p in parts])[order]) if parts else np.eye(1, width)
        centres = fit_centroids(x, cells)
        shares = np.bincount(nearest(x, centres)[0], minlength=len(centres)) / len(x)
        axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
        yield pa.RecordBatch.from_pydict({k: [v.tobytes()] for k, v in (("centres", centres), ("shares", shares), ("axes", axes))})

    draw = F.pmod(F.xxhash64("node", F.lit("kmeans")), F.lit(1 << 30)) / float(1 << 30)
    sampled = nodes.where(draw < min(1.0, SAMPLE / n)).select("node", "x").repartition(1)
    [fitted] = sampled.mapInArrow(learn, "centres binary, shares binary, axes binary").collect()
    centres, axes = (np.frombuffer(fitted[k]).reshape(-1, width) for k in ("centres", "axes"))
    shares = np.frombuffer(fitted["shares"])
    cells = len(centres)
    sent = spark.sparkContext.broadcast(Space(centres, axes, threshold))  # at most MOST_CELLS vectors
    half = np.sqrt((1 + threshold) / 2) + 1e-9
    tasks = partitions_for(spark)
    buckets = 4 * tasks  # cells that follow each other; one that is larger than a bucket is dealt to several
    before = np.cumsum(shares) - shares

    def place(batches):
        centres = sent.value.centres
        rough = centres.astype(np.float32)
        for batch in batches:
            x = unit(matrix(batch.column(2), width))
            home = nearest(x.astype(np.float32), rough)[0]
            best = np.concatenate([(x[k : k + CHUNK] * centres[home[k : k + CHUNK]]).sum(axis=1) for k in range(0, len(x), CHUNK)] or [[]])
            mixed = (batch.column(0).to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) / float(1 << 31)
            at = before[home] + shares[home] * np.where(shares[home] * buckets > 2, mixed, 0.5)
            yield pa.RecordBatch.from_arrays(
                [pa.array((at * buckets).astype(np.int32)), *batch.columns, pa.array(home.astype(np.int32)), pa.array(best), pa.array(best >= half)],
                names=["bucket", "node", "w", "x", "home", "best", "core"],
            )

    element = "float" if single else "double"
    placed = (
        nodes.select("node", "w", "x")
        .mapInArrow(place, f"bucket int, node long, w long, x array<{element}>, home int, best double, core boolean")
        .repartition(tasks, "bucket")
        .sortWithinPartitions("home", "core", "node")
    )
    uri = work_dir(spark, "blocks")
    shard_rows, held_rows = max(1, SHARD // width), max(1, HELD // width)

    def store(batches):
        """Blocks of one cell, core or not, one after the other in files of some rows."""
        part, made, waiting, count = TaskContext.get().partitionId(), 0, [], 0

        def shard(rows: pa.Table):
            nonlocal made
            node, w, home, best = (rows.column(c).to_numpy() for c in ("node", "w", "home", "best"))
            core = rows.column("core").to_numpy()
            raw = matrix(rows.column("x").combine_chunks(), width).astype(kind)
            turns = np.flatnonzero(np.r_[True, (home[1:] != home[:-1]) | (core[1:] != core[:-1]), True])
            cuts = [(k, min(k + MEMBERS, e)) for s, e in zip(turns[:-1].tolist(), turns[1:].tolist()) for k in range(s, e, MEMBERS)]
            name = f"blocks-{part:06d}-{made:06d}"
            write_whole(uri, name, (Blocks.packed(node[s:e], w[s:e], best[s:e], raw[s:e]) for s, e in cuts))
            made += 1
            begin = [s for s, _ in cuts]
            return pa.RecordBatch.from_pydict(
                {
                    "file": [name] * len(cuts), "at": [s * (24 + raw.itemsize * width) for s in begin], "rows": [e - s for s, e in cuts],
                    "home": home[begin], "core": core[begin], "cw": np.add.reduceat(w, begin), "cr": np.minimum.reduceat(node, begin),
                }
            )

        for batch in batches:
            waiting.append(batch)
            count += batch.num_rows
            while count >= shard_rows:
                rows = pa.Table.from_batches(waiting)
                yield shard(rows.slice(0, shard_rows))
                waiting, count = rows.slice(shard_rows).to_batches(), count - shard_rows
        if count:
            yield shard(pa.Table.from_batches(waiting))

    # One row per block.
    stored = settled(placed.mapInArrow(store, "file string, at long, rows long, home int, core boolean, cw long, cr long"), "stored")
    index = stored.toPandas().sort_values(["home", "core", "file", "at"], ignore_index=True)
    rim, cores = (np.bincount(index["home"][index["core"] == of], minlength=cells) for of in (False, True))
    index["own"] = index.groupby(["home", "core"]).cumcount()  # its number among the blocks of the rim, or of the core
    index["group"] = (index["rows"].cumsum() - index["rows"]) // held_rows
    whole = index[index["core"]].groupby("home").agg(cw=("cw", "sum"), cr=("cr", "min"))
    whole = dict(zip(whole.index.tolist(), zip(whole["cw"].tolist(), whole["cr"].tolist())))
    index = index.drop(columns=["cw", "cr"])
    files = index.sort_values(["file", "at"], ignore_index=True)
    of_group, of_file = (np.r_[np.flatnonzero(c != c.shift()), len(c)] for c in (index["group"], files["file"]))
    groups = len(of_group) - 1
    segments = min(len(of_file) - 1, -(-4 * tasks // groups))
    told = spark.sparkContext.broadcast((index, files, rim, cores, whole))
    nobody = np.zeros(cells, np.int64)
    record = 24 + np.dtype(kind).itemsize * width

    def compare(batches):
        space, (index, files, rim, cores, whole) = sent.value, told.value

        def read(part):
            """The blocks of some rows of the index, in their order."""
            out, opened = [], {}
            for name, at, n, home, core in zip(*(part[c].tolist() for c in ("file", "at", "rows", "home", "core"))):
                if name not in opened:
                    opened[name] = open_file(uri, name)
                out.append((opened[name].read_at(n * record, at), n, home, core))
            for file in opened.values():
                file.close()
            return Blocks(space, out, width, kind)

        def links(group: int, segment: int):
            part = index.iloc[of_group[group] : of_group[group + 1]]
            held = read(part)
            blocks = {(h, o + rim[h] * c): k for k, (h, o, c) in enumerate(zip(*(part[c].tolist() for c in ("home", "own", "core"))))}
            of_cell = defaultdict(list)
            for (home, _), k in blocks.items():
                of_cell[home].append(k)
            there = np.array(sorted(of_cell), np.int64)
            for file in range(segment, len(of_file) - 1, segments):
                part = files.iloc[of_file[file] : of_file[file + 1]]
                met = read(part)
                found = []
                for few in np.split(there, range(CELLS, len(there), CELLS)):
                    for cell, guests in zip(few.tolist(), space.visiting(met.x, met.raw, met.best, met.home, few)):
                        guests = np.flatnonzero(guests)
                        for at in range(0, len(guests), VISITORS):
                            for k in of_cell[cell]:
                                found += meet(space, held, held.rows(k), met, guests[at : at + VISITORS], cell, False)
                for k, (home, core, own) in enumerate(zip(*(part[c].tolist() for c in ("home", "core", "own")))):
                    b = met.rows(k)
                    for _, i, j, _, right in units_of(home, core, [], own, rim, cores, nobody):
                        if right and (home, i) in blocks:
                            found += meet(space, held, held.rows(blocks[home, i]), met, b, None, i == j)
                    if core and (home, own + rim[home]) in blocks:
                        met.n[b] += whole[home][0] - met.w[b]
                        found.append((met.node[b], np.full(len(b), whole[home][1])))
                yield from told_of(found, met)
            yield from told_of([], held)

        def told_of(found, counted):
            """Sums of weights, and every pair of a node and a smaller one that it reaches once."""
            some = np.flatnonzero(counted.n)
            pairs = np.concatenate([np.stack(f, axis=1) for f in found] or [np.empty((0, 2), np.int64)])
            pairs = np.unique(pairs[pairs[:, 0] != pairs[:, 1]], axis=0)
            node = np.r_[counted.node[some], pairs[:, 0]]
            n, root = np.r_[counted.n[some], np.zeros(len(pairs), np.int64)], np.r_[counted.node[some], pairs[:, 1]]
            if len(node):
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n), pa.array(root)], names=["node", "n", "root"])

        for batch in batches:
            for group, segment in zip(*(batch.column(c).to_pylist() for c in range(2))):
                yield from links(group, segment)

    # Every group of held blocks meets all files, in segments.
    work = spark.range(groups * segments).select(
        F.expr(f"cast(id div {segments} as int)").alias("group"), F.expr(f"cast(id % {segments} as int)").alias("segment")
    )
    links = settled(work.repartition(groups * segments).mapInArrow(compare, "node long, n long, root long"), "found")
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    labelled = settled(
        nodes.select("node", "w", "first")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .select("node", "first", (F.col("w") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("root", "node").alias("root")),
        "labelled",
    )
    smallest = labelled.groupBy("root").agg(F.min("first").alias("least"))
    info = labelled.join(smallest, "root").select("node", "n", "least")
    return rows.join(info, "node", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"),
        F.col("vec_id").eqNullSafe(F.coalesce("least", "vec_id")).alias("kept"),
    )
