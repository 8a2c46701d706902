"""Exact de-duplication by polynomial fingerprints put together from those of chunks.

The fingerprint of a string is the polynomial of its bytes, each plus one, at a fixed base
modulo 2^61 - 1. That of ``a + b`` is that of ``a`` shifted by the length of ``b``, plus that
of ``b``, so the chunks of a text are hashed side by side and combined afterwards, however
long the text is. Texts of equal length and fingerprint are then compared chunk by chunk: an
aggregate streams over the chunks at each place of each fingerprint and keeps the least and
the greatest, which are combined before the shuffle, so that a text with very many copies is
shuffled once per task. Where they differ the fingerprints collide, and all texts get a
further fingerprint at another base until none do; the result is exact.

Texts are equal when identical after lower-casing A-Z only; a null text is empty, and empty
texts are equal to each other. Of equal texts the row with the largest id stays; a null id is
smaller than all others, and of rows that repeat an id and a text one stays. Very long texts
are never held in more than one task, and compared in chunks. Other columns, whatever their
names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import join_groups, kept, text_or_empty

MODULUS = (1 << 61) - 1
BASE = 0x0B4E_8F21_6D35_C7A9
CHUNK = 1 << 16  # bytes
TOGETHER = 1 << 22  # bytes hashed by one call
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def base_of(turn: int) -> int:
    """Base of the fingerprint that is added in a turn."""
    return (BASE * (2 * turn + 1) + turn) % MODULUS


def combined(first: int, second: int, length: int, base: int = BASE) -> int:
    """Fingerprint of two strings one after the other; ``length`` is that of the second."""
    return (first * pow(base, length, MODULUS) + second) % MODULUS


class Polynomial:
    """Fingerprints of chunks at one base."""

    def __init__(self, base: int):
        self.base = base
        powers = [1]
        for _ in range(CHUNK - 1):
            powers.append(powers[-1] * base % MODULUS)
        whole = np.array(powers, np.int64)
        self.low, self.high = whole & ((1 << 31) - 1), whole >> 31

    def of_chunks(self, raw: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of chunks that lie one after the other; each has 1 to ``CHUNK`` bytes."""
        if not len(sizes):
            return np.zeros(0, np.int64)
        ends = np.cumsum(sizes)
        power = np.repeat(ends - 1, sizes) - np.arange(len(raw))
        value = raw.astype(np.int64) + 1
        low = np.add.reduceat(value * self.low[power], ends - sizes)  # below 2^55
        high = np.add.reduceat(value * self.high[power], ends - sizes)
        # 2^61 is 1, so of high * 2^31 the bits above 2^30 come back at the bottom.
        total = (high >> 30) + ((high & ((1 << 30) - 1)) << 31) + low
        total = (total & MODULUS) + (total >> 61)
        return np.where(total >= MODULUS, total - MODULUS, total)

    def of_texts(self, texts: list[bytes]) -> list[int]:
        sizes, owner = [], []
        for i, text in enumerate(texts):
            whole, rest = divmod(len(text), CHUNK)
            cut = [CHUNK] * whole + [rest] * (rest > 0)
            sizes += cut
            owner += [i] * len(cut)
        found = self.of_chunks(np.frombuffer(b"".join(texts), np.uint8), np.array(sizes, np.int64))
        out, seen = [0] * len(texts), [False] * len(texts)
        for i, size, value in zip(owner, sizes, found.tolist()):
            out[i] = combined(out[i], value, size, self.base) if seen[i] else value
            seen[i] = True
        return out


def in_portions(columns: tuple[list, list[bytes]]) -> Iterator[tuple[list, list[bytes]]]:
    """Rows of a batch, at most ``TOGETHER`` bytes of text or one text at once."""
    ids, texts, held = [], [], 0
    for i, text in zip(*columns):
        if texts and held + len(text) > TOGETHER:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(i)
        texts.append(text)
        held += len(text)
    if texts:
        yield ids, texts


def marked(batches, bases: list[int]):
    """(ids, lower-cased texts, fingerprints as bytes) of portions of (id, text) rows."""
    makers = [Polynomial(b) for b in bases]
    for batch in batches:
        lowered = [t.translate(LOWER) for t in batch.column(1).to_pylist()]
        for ids, texts in in_portions((batch.column(0).to_pylist(), lowered)):
            values = np.array([m.of_texts(texts) for m in makers], ">i8").T
            yield ids, texts, [row.tobytes() for row in np.ascontiguousarray(values)]


def collisions(texts: DataFrame, bases: list[int]) -> DataFrame:
    """Places of fingerprints at which the chunks of texts of the same length differ."""

    def chunks(batches):
        for _, texts, prints in marked(batches, bases):
            n, mark, at, part = [], [], [], []
            for text, fp in zip(texts, prints):
                for start in range(0, len(text), CHUNK):
                    n.append(len(text))
                    mark.append(fp)
                    at.append(start)
                    part.append(text[start : start + CHUNK])
            yield pa.RecordBatch.from_arrays(
                [pa.array(n, pa.int64()), pa.array(mark, pa.binary()), pa.array(at, pa.int64()), pa.array(part, pa.binary())],
                names=["n_bytes", "print", "start", "chunk"],
            )

    pieces = texts.mapInArrow(chunks, "n_bytes long, print binary, start long, chunk binary")
    spread = pieces.groupBy("n_bytes", "print", "start").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    return spread.where(F.col("least") != F.col("most"))


def fingerprinted(texts: DataFrame, bases: list[int]) -> DataFrame:
    """(doc_id, n_bytes, print, text_sha256) of every row."""

    def rows(batches):
        for ids, texts, prints in marked(batches, bases):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(prints, pa.binary()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                ],
                names=["doc_id", "n_bytes", "print", "text_sha256"],
            )

    return texts.mapInArrow(rows, "doc_id long, n_bytes long, print binary, text_sha256 string")


def exact_duplicates(docs: DataFrame, bases: list[int] | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, n_bytes, print) of every row."""
    bases = list(bases or [base_of(0)])
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    while not collisions(texts, bases).isEmpty():
        bases.append(base_of(len(bases)))
    rows = kept(fingerprinted(texts, bases).withColumn("row", F.monotonically_increasing_id()), "prints")
    groups = rows.groupBy("n_bytes", "print").agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("keeper")
    )
    joined = join_groups(rows, groups, ["n_bytes", "print"], "group_size", rows.count())
    return joined.select(
        "doc_id",
        F.col("keeper.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keeper.row")).alias("kept"),
        "text_sha256",
        "n_bytes",
        "print",
    )
