"""Packing documents into sequences of bounded length, best fit first.

Documents are cut into pieces of at most ``capacity`` ids; all pieces but a document's first
are full. The pieces are then placed in bulk-synchronous steps. Lengths and gaps are whole
numbers up to ``capacity``, so all pieces of a length are one range of ranks and all
sequences with the same gap are ranges of numbers, however many there are. A step takes the
longest pieces that are left, sweeps the gaps upwards from their length, and gives each gap
as many of the ranked pieces as it holds: the piece with rank r gets place r, so no two
pieces claim one place. What is left opens new sequences, the gaps are updated, and the next
step follows. The plan is a table over ranks whose size depends on ``capacity`` alone; ranks
are counted where the pieces are, and every piece looks up its place in the plan.

A null text is empty (one piece holding the end id); repeated ids are separate documents; an
empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, text_or_empty
from tidewatch.llm.subwords import shared_subwords

CAPACITY = 2048
TEXTS = 200


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of a document."""
    head = length % capacity
    starts = ([0] if head else []) + list(range(head, length, capacity))
    return list(zip(starts, [*starts[1:], length]))


def plan_best_fit(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Places of all pieces: rows (length, first rank, count, first sequence, per sequence, offset).

    The piece with rank ``first rank + i`` goes to sequence ``first + i // per`` at
    ``offset + i % per * length``.
    """
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> ranges of sequences
    plan, opened = [], 0

    def place(length: int, rank: int, left: int, gap: int, first: int, many: int) -> int:
        """Fill up to ``many`` sequences of a gap from ``first`` on; returns the pieces placed."""
        per = gap // length
        n = min(left, per * many)
        plan.append((length, rank, n, first, per, capacity - gap))
        full, part = divmod(n, per)
        if full and gap - per * length:
            gaps[gap - per * length].append((first, full))
        if part:
            gaps[gap - part * length].append((first + full, 1))
        used = full + bool(part)
        if used < many:
            gaps[gap].append((first + used, many - used))
        return n

    for length in sorted((n for n in counts if counts[n]), reverse=True):
        rank, left = 0, counts[length]
        for gap in range(length, capacity):
            ranges, gaps[gap] = gaps.get(gap, []), []
            for k, (first, many) in enumerate(ranges):
                if not left:
                    gaps[gap].extend(ranges[k:])
                    break
                n = place(length, rank, left, gap, first, many)
                rank, left = rank + n, left - n
            if not left:
                break
        if left:
            many = -(-left // (capacity // length))
            place(length, rank, left, capacity, opened, many)
            opened += many
    return np.array(plan, np.int64).reshape(-1, 6)


def pieces_of(docs: DataFrame, path: str, drops_space: bool, end_id: int, capacity: int) -> DataFrame:
    """Pieces of all documents with a rank among the pieces of the same length and task."""

    def tokenize(batches):
        part, seen, subwords = TaskContext.get().partitionId(), defaultdict(int), shared_subwords(path, drops_space)
        end = np.array([end_id], np.uint32 if end_id > np.iinfo(subwords.kind).max else subwords.kind)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                rows = batch.slice(at, TEXTS)
                out = defaultdict(list)
                for doc_id, ids in zip(rows.column(0).to_pylist(), subwords.encode(rows.column(1).to_pylist())):
                    ids = np.append(ids, end).astype("<u4")
                    raw = ids.tobytes()
                    for k, (a, b) in enumerate(cut(len(ids), capacity)):
                        out["doc_id"].append(doc_id)
                        out["piece"].append(k)
                        out["start"].append(a)
                        out["length"].append(b - a)
                        out["ids_crc32"].append(zlib.crc32(raw[4 * a : 4 * b]))
                        out["part"].append(part)
                        out["seen"].append(seen[b - a])
                        seen[b - a] += 1
                yield pa.RecordBatch.from_pydict(dict(out), schema=schema)

    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32())]
        + [(c, pa.int64()) for c in ("start", "length", "ids_crc32", "part", "seen")]
    )
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty()).mapInArrow(
        tokenize, "doc_id long, piece int, start long, length long, ids_crc32 long, part long, seen long"
    )


def pack_documents(
    docs: DataFrame, path: str, drops_space: bool = False, end_id: int = 0, capacity: int = CAPACITY
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    pieces = kept(pieces_of(docs, path, drops_space, end_id, capacity), "pieces")
    per_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_part.select(
        "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip")
    )
    # One row per length, at most `capacity` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = plan_best_fit(counts, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]

    def assign(batches):
        # (length, rank) as one number: ranks stay below 2^48.
        keys = (plan[:, 0] << 48) + plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            row = plan[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            i = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(row[:, 3] + i // row[:, 4]), pa.array(row[:, 5] + i % row[:, 4] * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    ranked = pieces.join(offsets, ["length", "part"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("skip") + F.col("seen")).alias("rank")
    )
    return ranked.mapInArrow(
        assign,
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
