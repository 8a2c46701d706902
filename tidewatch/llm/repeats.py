"""Removing strings of 100 bytes or more that occur earlier in the corpus.

Every document is sampled at anchors: positions whose hash of 32 bytes is the least in some
stretch, so that each string of 100 bytes holds an anchor that depends on that string alone.
An anchor's context are the bytes within reach of a 100-byte string around it. Contexts that
are equal need no look at the text: all but the first are repeats as a whole. Where an
anchor has different contexts, one text of each is fetched, and run-length indexes over
slices of them find which strings start earlier. An anchor with few contexts is one slice. The
contexts of one with many are halved: strings that start near the anchor hold the bytes that
follow it, the others those before it, and only contexts that agree in these meet again, up to
HALVINGS times. Of what is too many even then, the strings that no earlier context of their slice
holds meet those of the other slices, by their hashes. Marks are joined per document, merged,
and cut out.

Hashes have 64 bits and are compared together with a second hash of the context. A document
is an id with a hash of the text: rows that repeat an id with another text are documents of
their own and not earlier than each other, and rows that repeat both get equal results. Null
ids are one id that comes before all others; a null text is empty; strings are bytes of
UTF-8, however long the text; carried columns get the prefix ``c_``, others are ignored
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import partitions_for, settled, text_or_empty
from tidewatch.llm.runindex import RunIndex

LENGTH = 100
GRAM = 32
STRETCH = LENGTH - GRAM + 1
LEFT = LENGTH - GRAM  # bytes of a context before its anchor
CHUNK = 1 << 20  # bytes hashed together
INDEXED = 1 << 18  # bytes of an index
MOST = 1024  # contexts in a slice of an anchor, in expectation
HALVINGS = 3
NO_ID = -(1 << 63)
PRIME = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(PRIME, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def scramble(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(33))


def sliding(h: np.ndarray, width: int, pick) -> np.ndarray:
    """Least (or largest) value of every ``width`` consecutive ones."""
    size = 1
    while size * 2 <= width:
        h = pick(h[:-size], h[size:])
        size *= 2
    return pick(h[: len(h) - (width - size)], h[width - size :]) if width > size else h


class Hasher:
    """Hashes of any substring of a byte array, from running sums."""

    def __init__(self, raw: np.ndarray, up: np.ndarray, down: np.ndarray):
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: len(raw)], out=self.sums[1:])
        self.down = down

    def between(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return scramble((self.sums[end] - self.sums[start]) * self.down[start])


def anchors(texts: list[bytes], up: np.ndarray, down: np.ndarray):
    """(text number, position, reach left, reach right, gram hash, context hash) of all anchors."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes) - sizes
    n = len(raw) - GRAM + 1
    hasher = Hasher(raw, up, down)
    at = np.arange(n)
    gram = hasher.between(at, at + GRAM)
    doc = np.repeat(np.arange(len(texts)), sizes)
    gram[doc[:n] != doc[GRAM - 1 :]] = np.uint64((1 << 64) - 1)  # crosses a border
    padded = np.concatenate([np.full(STRETCH - 1, (1 << 64) - 1, np.uint64), gram, np.full(STRETCH - 1, (1 << 64) - 1, np.uint64)])
    least = sliding(padded, STRETCH, np.minimum)
    most = sliding(least, STRETCH, np.maximum)
    p = np.flatnonzero((most == gram) & (gram != np.uint64((1 << 64) - 1)))
    d = doc[p]
    left = np.minimum(LEFT, p - starts[d])
    right = np.minimum(LENGTH, starts[d] + sizes[d] - p)
    whole = left + right >= LENGTH
    p, d, left, right = p[whole], d[whole], left[whole], right[whole]
    context = hasher.between(p - left, p + right) ^ scramble((left * 256 + right).astype(np.uint64))
    return d, p - starts[d], left, right, gram[p], context


def repeated(own: np.ndarray, value: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which entries have one of the same owner and value at a smaller place."""
    order = np.lexsort((place, value, own))
    a, b = order[:-1], order[1:]
    start = np.r_[True, (own[a] != own[b]) | (value[a] != value[b])]
    least = place[order][start][np.cumsum(start) - 1]
    out = np.zeros(len(own), bool)
    out[order] = place[order] > least
    return out


def sampled(docs: DataFrame) -> DataFrame:
    """(gram, context, doc, own, pos, reach, again) of every anchor; reach = 256 * left + right.

    ``again`` says that the document has the context at an earlier place too.
    """

    def sample(batches):
        up, down = powers(PRIME, 1 << 16), powers(INVERSE, 1 << 16)

        def emit(ids, hashes, texts):
            nonlocal up, down
            total = sum(map(len, texts))
            if total >= len(up):
                up, down = powers(PRIME, 2 * total), powers(INVERSE, 2 * total)
            d, pos, left, right, gram, context = anchors(texts, up, down)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(gram.view(np.int64)),
                    pa.array(context.view(np.int64)),
                    pa.array(np.array(ids, np.int64)[d]),
                    pa.array(np.array(hashes, np.int64)[d]),
                    pa.array(pos.astype(np.int32)),
                    pa.array((left * 256 + right).astype(np.int32)),
                    pa.array(repeated(d, context, pos)),
                ],
                names=["gram", "context", "doc", "own", "pos", "reach", "again"],
            )

        ids, hashes, texts, held = [], [], [], 0
        for batch in batches:
            for doc, own, raw in zip(*(batch.column(c).to_pylist() for c in ("doc", "own", "text"))):
                if len(raw) >= LENGTH:
                    ids.append(doc)
                    hashes.append(own)
                    texts.append(raw)
                    held += len(raw)
                    if held >= CHUNK:
                        yield emit(ids, hashes, texts)
                        ids, hashes, texts, held = [], [], [], 0
        if ids:
            yield emit(ids, hashes, texts)

    return docs.mapInArrow(sample, "gram long, context long, doc long, own long, pos int, reach int, again boolean")


def fetched(asked: DataFrame, docs: DataFrame) -> DataFrame:
    """Asked contexts (gram, doc, own, pos, reach) with their bytes, grouped by document to read each text once."""
    wanted = asked.groupBy("doc", "own").agg(F.collect_list(F.struct("gram", "pos", "reach", "m")).alias("asked"))
    joined = docs.join(wanted, ["doc", "own"]).select("doc", "own", "text", "asked")

    def cut(batches):
        for batch in batches:
            lists = batch.column(3)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            pos, reach = (flat.field(c).to_numpy().astype(np.int64) for c in ("pos", "reach"))
            left, right = reach >> 8, reach & 255
            row = np.repeat(np.arange(batch.num_rows), sizes)
            texts = batch.column(2).to_pylist()
            pieces = [texts[r][a:b] for r, a, b in zip(row.tolist(), (pos - left).tolist(), (pos + right).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    flat.field("gram"), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)),
                    flat.field("pos"), pa.array(left.astype(np.int32)), pa.array(pieces, pa.binary()), flat.field("m"),
                ],
                names=["gram", "doc", "own", "pos", "left", "bytes", "m"],
            )

    return joined.mapInArrow(cut, "gram long, doc long, own long, pos int, left int, bytes binary, m long")


def halved(contexts: DataFrame) -> DataFrame:
    """Contexts twice, for the first and the second half of their strings; ``gram`` is what all strings of a half hold.

    A string starts ``low`` to ``high`` bytes before the anchor. A context without a string of a
    half is not part of it; the others are cut to what the strings of the half cover.
    """

    def split(batches):
        up, down = powers(PRIME, 1 << 16), powers(INVERSE, 1 << 16)
        for batch in batches:
            texts = batch.column("bytes").to_pylist()
            raw = np.frombuffer(b"".join(texts), np.uint8)
            if len(raw) >= len(up):
                up, down = powers(PRIME, 2 * len(raw)), powers(INVERSE, 2 * len(raw))
            hasher = Hasher(raw, up, down)
            sizes = np.array([len(t) for t in texts], np.int64)
            begins = np.cumsum(sizes) - sizes
            left, low, high = (batch.column(c).to_numpy().astype(np.int64) for c in ("left", "low", "high"))
            middle = (low + high) // 2
            for least, most in ((low, middle), (middle + 1, high)):
                rows = np.flatnonzero((least <= most) & (left >= least) & (left + LENGTH - most <= sizes))
                a, b, at, begin = least[rows], most[rows], left[rows], begins[rows]
                common = hasher.between(begin + at - a, begin + at + LENGTH - b) ^ scramble((a * 256 + b + (1 << 20)).astype(np.uint64))
                first, last = at - np.minimum(at, b), np.minimum(sizes[rows], at + LENGTH - a)
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(common.view(np.int64)), *(batch.column(c).take(taken) for c in ("doc", "own", "pos")),
                        pa.array((at - first).astype(np.int32)),
                        pa.array([texts[r][i:j] for r, i, j in zip(rows.tolist(), first.tolist(), last.tolist())], pa.binary()),
                        pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
                    ],
                    names=["gram", "doc", "own", "pos", "left", "bytes", "low", "high"],
                )

    return contexts.mapInArrow(split, "gram long, doc long, own long, pos int, left int, bytes binary, low int, high int")


def grouped(contexts: DataFrame) -> DataFrame:
    """Contexts in groups whose strings may meet; a group of more than MOST has been halved as often as it may be."""
    whole, groups = contexts.columns, []
    contexts = contexts.withColumns({"low": F.lit(0), "high": F.lit(LEFT)})
    for _ in range(HALVINGS):
        groups.append(contexts.where(F.col("m") <= MOST).select(whole))
        many = contexts.where(F.col("m") > MOST)
        if many.isEmpty():
            break
        halves = settled(halved(many), "halves")
        sizes = halves.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        contexts = settled(halves.join(sizes, "gram"), "groups")
    else:
        groups.append(contexts.select(whole))
    out = groups[0]
    for more in groups[1:]:
        out = out.unionByName(more)
    return out


def indexed(contexts: DataFrame) -> DataFrame:
    """What the indexes of all slices of contexts tell, as rows of two kinds.

    With a null ``h``, (doc, own, start, end) is a mark: strings that start earlier in another
    context of the slice. The other rows are the strings (gram, h, doc, own, start) without a
    mark, of anchors that have more than one slice.
    """

    def resolve(rows):
        grams, docs, hashes, places, lefts, sliced, texts = (list(c) for c in zip(*rows))
        sizes = np.array([len(t) for t in texts])
        begins = np.cumsum(sizes + 1) - sizes - 1
        raw = np.frombuffer(b"\x00".join(texts) + b"\x00", np.uint8)
        text = raw.astype(np.int64)
        text[begins + sizes] = 256 + np.arange(len(texts))  # all different
        index = RunIndex(text, LENGTH + LEFT + 8)
        grams, docs, hashes = (np.array(c, np.int64) for c in (grams, docs, hashes))
        ids, doc_rank = np.unique(docs, return_inverse=True)
        own = np.repeat(np.arange(len(texts)), sizes + 1)
        inside = np.arange(len(text)) - begins[own]
        offset = inside + (np.array(places, np.int64) - np.array(lefts, np.int64))[own]
        order = np.lexsort((hashes, docs))
        other = np.r_[True, (docs[order][1:] != docs[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])]
        if other.sum() == len(ids):  # no id has two texts: one number gives the order
            hit = index.earlier((doc_rank.astype(np.int64)[own] << 32) + offset, LENGTH)
        else:
            member = np.empty(len(docs), np.int64)
            member[order] = np.cumsum(other)
            group = index.groups(LENGTH)
            hit = index.earlier(doc_rank.astype(np.int64)[own], LENGTH) | repeated(member[own], group, offset)
        edge = np.diff(np.r_[0, hit.astype(np.int8), 0])
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
        first = np.flatnonzero(np.array(sliced)[own] & ~hit & (inside <= sizes[own] - LENGTH))
        strings = np.zeros(0, np.uint64)
        if len(first):
            strings = Hasher(raw, powers(PRIME, len(raw)), powers(INVERSE, len(raw))).between(first, first + LENGTH)
        at, known = np.r_[a, first], np.r_[np.ones(len(a), bool), np.zeros(len(first), bool)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(grams[own[at]]),
                pa.array(np.r_[np.zeros(len(a), np.int64), strings.view(np.int64)], mask=known),
                pa.array(docs[own[at]]),
                pa.array(hashes[own[at]]),
                pa.array(offset[at].astype(np.int32)),
                pa.array((offset[np.r_[b, first]] + LENGTH).astype(np.int32)),
            ],
            names=["gram", "h", "doc", "own", "start", "end"],
        )

    def run(batches):
        rows, held, last = [], 0, None
        for batch in batches:
            for slice_, *row in zip(*(batch.column(c).to_pylist() for c in ("slice", *names))):
                if held >= INDEXED and (row[0], slice_) != last:
                    yield resolve(rows)
                    rows, held = [], 0
                rows.append(row)
                held += len(row[-1]) + 1
                last = row[0], slice_
        if rows:
            yield resolve(rows)

    names = ("gram", "doc", "own", "pos", "left", "sliced", "bytes")
    slices = F.ceil(F.col("m") / MOST)
    dealt = contexts.select(
        "*", (slices > 1).alias("sliced"), F.pmod(F.xxhash64("doc", "own", "pos"), slices).alias("slice")
    ).select("slice", *names)
    near = dealt.repartition(partitions_for(contexts.sparkSession), "gram", "slice").sortWithinPartitions("gram", "slice")
    return near.mapInArrow(run, "gram long, h long, doc long, own long, start int, end int")


def across(strings: DataFrame) -> DataFrame:
    """Marks of strings that start earlier in another slice of their anchor; strings meet by their hash."""
    # A slice gives each string once, so no string has many rows: one shuffle serves both minima.
    inside = strings.withColumn("s0", F.min("start").over(W.partitionBy("gram", "h", "doc", "own")))
    least = inside.withColumn("d0", F.min("doc").over(W.partitionBy("gram", "h")))
    return least.where("doc > d0 OR start > s0").select("doc", "own", "start", (F.col("start") + LENGTH).alias("end"))


def marks(docs: DataFrame) -> DataFrame:
    """(doc, own, start, end): byte ranges to remove, possibly overlapping, of (doc, own, text)."""
    found = sampled(docs)
    over = W.partitionBy("gram")
    decided = settled(
        found.select(
            "*",
            F.min("doc").over(W.partitionBy("gram", "context")).alias("d0"),
            F.min("context").over(over).alias("low"),
            F.max("context").over(over).alias("high"),
        )
        .withColumn("later", F.col("again") | (F.col("doc") > F.col("d0")))
        .where(F.col("later") | (F.col("low") != F.col("high")))
        .select("gram", "doc", "own", "pos", "reach", "later"),
        "anchors",
    )
    left, right = F.floor(F.col("reach") / 256).cast("int"), F.pmod("reach", F.lit(256))
    whole = decided.where("later").select(
        "doc", "own", (F.col("pos") - left).alias("start"), (F.col("pos") + right).alias("end")
    )
    open_ = decided.where("NOT later").select("gram", "doc", "own", "pos", "reach")
    many = open_.groupBy("gram").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    contexts = settled(fetched(open_.join(many, "gram"), docs), "contexts")
    told = settled(indexed(grouped(contexts)), "indexed")
    within = told.where("h IS NULL").select("doc", "own", "start", "end")
    strings = told.where("h IS NOT NULL").select("gram", "h", "doc", "own", "start")
    return whole.unionByName(within).unionByName(across(strings))


def merged(spans: pa.ListArray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the united spans of every text, in order."""
    counts = np.diff(spans.offsets.to_numpy())
    flat = spans.flatten()
    row = np.repeat(np.arange(len(counts)), counts).astype(np.int64)
    start, end = (flat.field(c).to_numpy().astype(np.int64) for c in ("start", "end"))
    order = np.argsort((row << 32) + start, kind="stable")
    row, start = row[order], start[order]
    reach = np.maximum.accumulate((row << 32) + np.minimum(end[order], sizes[row])) if len(row) else row
    first = np.flatnonzero(np.r_[True, (row[1:] << 32) + start[1:] > reach[:-1]]) if len(row) else row
    last = np.r_[first[1:], len(row)] - 1
    return row[first], start[first], reach[last] & ((1 << 32) - 1) if len(row) else reach


def remove_repeats(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text) and ``carry`` of every document."""
    carry = carry or []
    shaped = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("own"),
        text_or_empty().cast("binary").alias("text"),
        "doc_id",
        *[F.col(f"`{c}`").alias(f"c_{c}") for c in carry],
    )
    spans = settled(marks(shaped.select("doc", "own", "text")), "marks").groupBy("doc", "own").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    joined = shaped.join(spans, ["doc", "own"], "left").select("doc_id", *[f"c_{c}" for c in carry], "text", "spans")

    def cut(batches):
        for batch in batches:
            texts, spans = batch.column("text").to_pylist(), batch.column("spans")
            sizes = np.array([len(t) for t in texts], np.int64)
            row, start, end = merged(spans, sizes)
            removed = np.bincount(row, end - start, len(texts)).astype(np.int64)
            bounds = np.searchsorted(row, np.arange(len(texts) + 1))
            rest = []
            for raw, a, b in zip(texts, bounds.tolist(), bounds[1:].tolist()):
                if b > a:
                    edges = [0, *np.c_[start[a:b], end[a:b]].ravel().tolist(), len(raw)]
                    raw = b"".join([raw[i:j] for i, j in zip(edges[::2], edges[1::2])])
                rest.append(raw)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-2],
                    pa.array(sizes),
                    pa.array(removed),
                    pa.array(np.diff(bounds)),
                    pa.array([hashlib.sha256(r).hexdigest() for r in rest], pa.string()),
                    pa.array([r.decode("utf-8", "ignore") for r in rest], pa.string()),
                ],
                names=[*batch.schema.names[:-2], "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[:-2])
    return joined.mapInArrow(
        cut, f"{kinds}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    )
