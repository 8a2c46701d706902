"""Exact ranked lexical search over norm buckets of impact vectors.

A document is a vector of term impacts, an item a vector of term weights, and the score their
inner product. Only the terms of the items matter, so vectors are reduced to those. Vectors
are range-partitioned by length and read in descending order, in buckets. For an item whose
k-th best score is known,

* a bucket is passed over when the length of the item's vector times the greatest length in
  the bucket is below that score (Cauchy-Schwarz), or when the item's product with the
  bucket's coordinate-wise maximum is;
* inside a bucket, coordinates are added up from the one with the largest possible share,
  until those that remain cannot lift an unseen document to the score; documents whose sum
  and remaining bound, the lesser of the coordinate maxima and the product of remaining
  lengths, stay below it are dropped;
* survivors are scored again in whole numbers from their full vectors.

The score to reach comes from the documents of greatest length, and grows bucket by bucket
within a task. Every task hands on its k best rows for each item.

Items are taken in blocks of about ``BLOCK_TERMS`` terms, so that what is sent to the tasks
has a bound; each block meets all documents. Terms are maximal matches of ``TERM`` in the
whole text, lower-cased for A-Z only; a null or empty text has none and such a document is
never returned, nor is one without any term of an item. Very long texts are counted whole.
Rows that repeat an id are documents (or items) of their own. Equal scores are ordered by
ascending doc_id, a null id last. Other columns, whatever their names, are ignored. An empty
table on either side gives no rows.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, partitions_for, text_or_empty

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BUCKET = 4096  # documents of a bucket
BLOCK_TERMS = 1 << 18  # terms of a block of items, with repeats between items
NO_ID = (1 << 63) - 1  # orders a null id last
SLACK = 1 + 1e-9  # on bounds in floating point

# Byte by byte: bytes of longer characters and digits stay, A-Z is lowered, the rest parts terms.
SPLIT = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(SPLIT).split()


def as_bytes(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, text_or_empty().cast("binary").alias("text"))


def item_vectors(items: DataFrame) -> DataFrame:
    """(item, item_id, terms, times) of every row of the items."""

    def count(batches):
        for batch in batches:
            counts = [Counter(terms_of(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("item"),
                    batch.column("item_id"),
                    pa.array([list(c) for c in counts], pa.list_(pa.binary())),
                    pa.array([list(c.values()) for c in counts], pa.list_(pa.int64())),
                ],
                names=["item", "item_id", "terms", "times"],
            )

    rows = as_bytes(items.select(F.col("item_id").cast("long").alias("item_id"), "text"), "item_id")
    numbered = rows.withColumn("item", F.monotonically_increasing_id())
    return kept(numbered.mapInArrow(count, "item long, item_id long, terms array<binary>, times array<long>"), "items")


def term_counts(texts: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs) of documents with a term: all terms counted, those of the items kept."""

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids, sizes, flat, times, ends = [], [], [], [], [0]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = terms_of(text)
                    if not words:
                        continue
                    counts = Counter(words)
                    known = counts.keys() & number.keys()
                    ids.append(doc)
                    sizes.append(len(words))
                    flat += [number[t] for t in known]
                    times += [counts[t] for t in known]
                    ends.append(len(flat))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64())),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return kept(texts.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<long>"), "terms")


class Bucket:
    """Impact vectors by row and, for every term, the rows that hold it."""

    def __init__(self, ids, norms, sizes, terms, impacts):
        self.ids, self.norms, self.terms, self.impacts = ids, norms, terms, impacts
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        self.longest = float(norms.max(initial=0.0))
        order = np.argsort(terms, kind="stable")
        self.rows = np.repeat(np.arange(len(ids)), sizes)[order]
        self.shares = impacts[order]
        self.known, first = np.unique(terms[order], return_index=True)
        self.first = np.r_[first, len(order)]
        self.peaks = np.maximum.reduceat(self.shares, first) if len(first) else np.zeros(0, np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray, least: int):
        """(scores, rows) of all documents that score at least ``least`` and more than 0."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        length = float(np.sqrt((weights.astype(float) ** 2).sum()))
        if length * self.longest * SLACK < least:
            return none
        at = np.searchsorted(self.known, terms)
        here = (at < len(self.known)) & (self.known[np.minimum(at, len(self.known) - 1)] == terms)
        at, weight = at[here], weights[here]
        share = weight * self.peaks[at]
        if not share.sum() or share.sum() < least:
            return none
        order = np.argsort(-share, kind="stable")
        at, weight, share = at[order], weight[order], share[order]
        left = share[::-1].cumsum()[::-1]  # what coordinates from here on can still add
        sums = np.zeros(len(self.ids), np.int64)
        used = 0
        while used < len(at) and left[used] >= least:
            a, b = self.first[at[used]], self.first[at[used] + 1]
            sums[self.rows[a:b]] += weight[used] * self.shares[a:b]
            used += 1
        if used == len(at):
            rows = np.flatnonzero(sums >= max(least, 1))
            return sums[rows], rows
        tail = float(np.sqrt((weight[used:].astype(float) ** 2).sum()))
        bound = np.minimum(float(left[used]), tail * self.norms * SLACK)
        rows = np.flatnonzero((sums > 0) & (sums + bound >= least))
        if not len(rows):
            return none
        dense[terms] = weights
        sizes = self.ends[rows] - self.begins[rows]
        stops = np.cumsum(sizes)
        flat = np.repeat(self.begins[rows] - (stops - sizes), sizes) + np.arange(stops[-1])
        exact = np.add.reduceat(dense[self.terms[flat]] * self.impacts[flat], stops - sizes)
        dense[terms] = 0
        good = exact >= max(least, 1)
        return exact[good], rows[good]


def best_of(vectors: DataFrame, asked: list[tuple], floor: dict[int, int], width: int, k: int) -> DataFrame:
    """(item, doc_id, score): of each task, the k best documents of every item that reach its floor."""

    def buckets(batches):
        parts, held = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                part = batch.slice(at, BUCKET)
                if parts and held + part.num_rows > BUCKET:
                    yield pa.Table.from_batches(parts)
                    parts, held = [], 0
                parts.append(part)
                held += part.num_rows
        if parts:
            yield pa.Table.from_batches(parts)

    def search(batches):
        best = {q: (np.zeros(0, np.int64), np.zeros(0, np.int64)) for q, _, _ in asked}
        least = {q: floor.get(q, 0) for q, _, _ in asked}
        dense = np.zeros(width, np.int64)
        for table in buckets(batches):
            table = table.combine_chunks()
            lists = [table.column(c).combine_chunks() for c in ("terms", "impacts")]
            lists = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in lists]
            bucket = Bucket(
                table.column("doc_id").fill_null(NO_ID).to_numpy(),
                table.column("norm").to_numpy(),
                np.diff(lists[0].offsets.to_numpy()).astype(np.int64),
                lists[0].flatten().to_numpy().astype(np.int64),
                lists[1].flatten().to_numpy(),
            )
            for q, terms, weights in asked:
                scores, rows = bucket.search(terms, weights, dense, least[q])
                if not len(scores):
                    continue
                scores, ids = np.r_[best[q][0], scores], np.r_[best[q][1], bucket.ids[rows]]
                order = np.lexsort((ids, -scores))[:k]
                best[q] = scores[order], ids[order]
                if len(order) == k:
                    least[q] = max(least[q], int(scores[order[-1]]))
        for q, (scores, ids) in best.items():
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(scores), q)),
                        pa.array(ids, mask=ids == NO_ID),
                        pa.array(scores),
                    ],
                    names=["item", "doc_id", "score"],
                )

    return vectors.mapInArrow(search, "item long, doc_id long, score long")


def ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return found.select("item", place.alias("rank"), "doc_id", "score").where(F.col("rank") <= k)


def search_block(texts: DataFrame, block: list, k: int) -> DataFrame:
    """(item, rank, doc_id, score) of a block of items, given as rows of ``item_vectors``."""
    spark = texts.sparkSession
    number = {t: i for i, t in enumerate(sorted({bytes(t) for row in block for t in row.terms}))}
    counted = term_counts(texts, number)
    total = counted.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n, everything = total.docs, max(total.terms, 1)
    held = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    rare = F.floor(1000 * F.log(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weight = np.zeros(len(number), np.int64)
    for row in held.select("term", rare.alias("w")).toLocalIterator():  # one row a term of the block
        weight[row.term] = row.w
    asked = []
    for row in block:
        terms = np.array([number[bytes(t)] for t in row.terms], np.int64)
        weights = weight[terms] * np.array(row.times, np.int64)
        asked.append((row.item, terms[weights > 0], weights[weights > 0]))
    asked = [a for a in asked if len(a[1])]
    scale = F.expr(f"75 + (25 * n * {n}L) div {everything}L")
    vectors = (
        counted.where(F.size("terms") > 0)
        .select("doc_id", "terms", "tfs", scale.alias("m"))
        .select("doc_id", "terms", F.expr("transform(tfs, t -> (1000000000L * t) div (1000 * t + 12 * m))").alias("impacts"))
        .select("*", F.expr("sqrt(aggregate(impacts, 0D, (s, x) -> s + double(x) * x))").alias("norm"))
    )
    # The k-th best score among the longest vectors is one that all results must reach.
    share = max(0.0, 1 - BUCKET / max(n, 1))
    cut = vectors.agg(F.percentile_approx("norm", F.lit(share), F.lit(10_000)).alias("cut")).first().cut or 0.0
    first = ranked(best_of(vectors.where(F.col("norm") >= cut), asked, {}, len(number), k), k)
    floor = {r.item: r.score for r in first.where(F.col("rank") == k).select("item", "score").toLocalIterator()}
    by_length = vectors.withColumn("deal", F.xxhash64("doc_id", "terms"))
    dealt = by_length.repartitionByRange(partitions_for(spark), F.desc("norm"), "deal").sortWithinPartitions(F.desc("norm"))
    return ranked(best_of(dealt.drop("deal"), asked, floor, len(number), k), k)


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents with a score above 0 for every item."""
    texts = as_bytes(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id")
    vectors = item_vectors(items)
    entries = vectors.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = -(-entries // BLOCK_TERMS) or 1
    found = None
    for b in range(blocks):
        block = vectors.where((F.pmod(F.xxhash64("item"), F.lit(blocks)) == b) & (F.size("terms") > 0)).collect()
        part = search_block(texts, block, k)
        found = part if found is None else found.unionByName(part)
    return found.join(vectors.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
