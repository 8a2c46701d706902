"""Token ids in files of fixed-width bit fields, readable at any document.

A file holds blocks of ids, each id in the fewest bits that hold every id of the vocabulary,
then an index (document ids, first id of each document, byte offset of each block) and a
fixed trailer that points to the index. Blocks are unpacked with whole-array operations, and
any document is found through the block offsets without reading what precedes it.

Documents are dealt into files by ranges of their id and written in ascending order; rows
with the same id are ordered by a digest of their text. Null texts are empty, null ids come
first, and an empty table gives no files.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, open_file, partitions_for, text_or_empty, write_whole
from tidewatch.llm.subwords import shared_subwords
from tidewatch.session import work_dir

MAGIC = b"BITIDS01"
TRAILER = "<8sIIQQQ"  # magic, bits, ids per block, documents, ids, index offset
BLOCK = 4096
TEXTS = 200  # texts tokenized together


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive fields of ``bits`` bits, lowest bit first."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    field = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(field.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(raw: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(raw, f"<u{bits // 8}", count).astype(np.uint32)
    field = np.unpackbits(np.frombuffer(raw, np.uint8), count=count * bits, bitorder="little")
    return field.reshape(count, bits).astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class Writer:
    """Yields the bytes of a file as documents are added; holds one block and the index."""

    def __init__(self, bits: int):
        self.bits, self.size, self.count = bits, 0, 0
        self.rest = np.zeros(0, np.uint32)
        self.doc_ids: list[int | None] = []
        self.starts: list[int] = []
        self.offsets: list[int] = []

    def _block(self, ids: np.ndarray) -> bytes:
        self.offsets.append(self.size)
        raw = pack(ids, self.bits)
        self.size += len(raw)
        return raw

    def add(self, docs: Iterable[tuple[int | None, np.ndarray]]) -> Iterator[bytes]:
        parts = [self.rest]
        for doc_id, ids in docs:
            self.doc_ids.append(doc_id)
            self.starts.append(self.count)
            self.count += len(ids)
            parts.append(ids)
        ids = np.concatenate(parts)
        whole = len(ids) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            yield self._block(ids[at : at + BLOCK])
        self.rest = ids[whole:]

    def close(self) -> Iterator[bytes]:
        if len(self.rest):
            yield self._block(self.rest)
        index = self.size
        yield np.array([d or 0 for d in self.doc_ids], "<i8").tobytes()
        yield np.array([d is None for d in self.doc_ids], np.uint8).tobytes()
        yield np.array([*self.starts, self.count], "<u8").tobytes()
        yield np.array([*self.offsets, index], "<u8").tobytes()
        yield struct.pack(TRAILER, MAGIC, self.bits, BLOCK, len(self.doc_ids), self.count, index)


class Reader:
    def __init__(self, file):
        self.file = file
        end = file.size() - struct.calcsize(TRAILER)
        magic, self.bits, self.block, docs, self.count, index = struct.unpack(TRAILER, self._at(end, struct.calcsize(TRAILER)))
        if magic != MAGIC:
            raise ValueError("not a file of packed ids")
        raw = self._at(index, end - index)
        blocks = -(-self.count // self.block)
        ids = np.frombuffer(raw, "<i8", docs)
        missing = np.frombuffer(raw, np.uint8, docs, 8 * docs)
        self.doc_ids = [None if gone else int(i) for i, gone in zip(ids, missing)]
        self.starts = np.frombuffer(raw, "<u8", docs + 1, 9 * docs).astype(np.int64)
        self.offsets = np.frombuffer(raw, "<u8", blocks + 1, 9 * docs + 8 * (docs + 1)).astype(np.int64)

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(int(offset))
        return self.file.read(int(size))

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids from ``start`` to ``end``, reading only the blocks that hold them."""
        if end <= start:
            return np.zeros(0, np.uint32)
        first, last = start // self.block, (end - 1) // self.block
        raw = self._at(self.offsets[first], self.offsets[last + 1] - self.offsets[first])
        have = min(self.count, (last + 1) * self.block) - first * self.block
        if self.block * self.bits % 8 == 0:
            ids = unpack(raw, self.bits, have)
        else:
            ids = np.concatenate(
                [
                    unpack(
                        raw[self.offsets[b] - self.offsets[first] : self.offsets[b + 1] - self.offsets[first]],
                        self.bits,
                        min(self.block, self.count - b * self.block),
                    )
                    for b in range(first, last + 1)
                ]
            )
        return ids[start - first * self.block : end - first * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(self.starts[i], self.starts[i + 1])

    def digests(self, step: int = 1 << 18) -> list[int]:
        """CRC32 of every document's ids as 32-bit little-endian integers, in one sweep."""
        out, doc, crc = [], 0, 0
        for at in range(0, self.count, step):
            end = min(self.count, at + step)
            ids = memoryview(self.ids(at, end).astype("<u4").tobytes())
            while doc < len(self.doc_ids) and self.starts[doc] < end:
                a, b = max(at, self.starts[doc]), min(end, self.starts[doc + 1])
                crc = zlib.crc32(ids[4 * (a - at) : 4 * (b - at)], crc)
                if self.starts[doc + 1] > end:
                    break
                out.append(crc)
                doc, crc = doc + 1, 0
        return out + [0] * (len(self.doc_ids) - len(out))


def write_ids(
    docs: DataFrame, path: str, drops_space: bool, end_id: int, uri: str | None = None
) -> tuple[DataFrame, str]:
    """Encode ``docs`` (doc_id, text) into files of packed ids; returns the list of files and their folder."""
    spark = docs.sparkSession
    uri = uri or work_dir(spark, "ids")
    dealt = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty())
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange(partitions_for(spark), "doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .drop("tie")
    )

    def write(batches):
        shard, subwords, writer = TaskContext.get().partitionId(), None, None

        def chunks():
            nonlocal subwords, writer
            end = None
            for batch in batches:
                if subwords is None:
                    subwords = shared_subwords(path, drops_space)
                    end = np.array([end_id], np.uint32 if end_id > np.iinfo(subwords.kind).max else subwords.kind)
                    writer = Writer(bits_for(max(subwords.size, end_id + 1)))
                for at in range(0, batch.num_rows, TEXTS):
                    part = batch.slice(at, TEXTS)
                    encoded = subwords.encode(part.column(1).to_pylist())
                    yield from writer.add(
                        (doc_id, np.append(ids, end).astype(np.uint32))
                        for doc_id, ids in zip(part.column(0).to_pylist(), encoded)
                    )
            if writer is not None:
                yield from writer.close()

        stream = chunks()
        first = next(stream, None)
        if first is not None:
            name = f"ids-{shard:06d}.bin"
            write_whole(uri, name, (c for part in ([first], stream) for c in part))
            yield pa.RecordBatch.from_pydict(
                {"shard": [shard], "file": [name], "n_docs": [len(writer.doc_ids)], "n_ids": [writer.count]}
            )

    files = kept(dealt.mapInArrow(write, "shard long, file string, n_docs long, n_ids long"), "idfiles")
    return files, uri


def read_ids(files: DataFrame, uri: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, file) of every document, from the files."""
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)  # one row per file
    placed = files.select(
        "shard", "file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    ).repartition(partitions_for(files.sparkSession), "shard")

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with open_file(uri, row["file"]) as file:
                    reader = Reader(file)
                    starts = reader.starts
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(reader.doc_ids, pa.int64()),
                            pa.array(starts[:-1] + row["base"], pa.int64()),
                            pa.array(np.diff(starts), pa.int64()),
                            pa.array(reader.digests(), pa.int64()),
                            pa.array([row["file"]] * len(reader.doc_ids), pa.string()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32", "file"],
                    )

    return placed.mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long, file string"
    )
