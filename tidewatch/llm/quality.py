"""Document quality from supervised subword embeddings.

A word stands for itself, for its character n-grams and for whether it repeats the word
before it; each feature is hashed to a row of an embedding table. A document is the mean of
its feature vectors, and a softmax layer over that mean gives the class. Table and layer are
trained together by stochastic gradient descent over mini-batches.

The model is fitted in one task on a sample of labelled documents whose expected size is
bounded by a parameter; every document is scored where it lies. Because the document vector
is a mean, the score needs one number per word (the sum over its features of embedding times
class difference) and the number of features, so scoring is a dictionary look-up per word.

A text that is null or has no words is scored by the trained bias alone; with no labels or one
class only, every score is the share of label 1 (0.5 without labels). Null labels are left
out; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, text_or_empty

BUCKETS = 1 << 16
DIMENSIONS = 8
GRAMS = (3, 4)
STEPS = 900  # mini-batches of the training, however large the sample
BATCH = 32
RATE = 2.0
SAMPLE = 4000  # labelled documents that fit the model, in expectation
CACHED_WORDS = 300_000
TEXTS = 500


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def sampled_labels(labels: DataFrame, label: str, sample: int) -> DataFrame:
    """(doc_id, y) of at most about ``sample`` rows outside the held-out fifth, one per document."""
    rows = (
        labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("y"))
    )
    share = min(1.0, sample / max(1, rows.count()))
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(draw < share)


def features(word: str) -> list[int]:
    """Buckets of a word and of its character n-grams."""
    marked = f"<{word}>"
    out = [zlib.crc32(marked.encode("utf-8", "replace"))]
    for n in GRAMS:
        if len(marked) > n:
            out.extend(
                zlib.crc32(marked[i : i + n].encode("utf-8", "replace"), n) for i in range(len(marked) - n + 1)
            )
    return [f % BUCKETS for f in out]


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of a text with their counts."""
    words = text.lower().split()
    counts = Counter(words)
    total: Counter[int] = Counter()
    for word, n in counts.items():
        for f in features(word):
            total[f] += n
    again = sum(a == b for a, b in zip(words, words[1:]))
    if again:
        total[zlib.crc32(b"again") % BUCKETS] += again * 4
    return np.fromiter(total.keys(), np.int32, len(total)), np.fromiter(total.values(), np.float32, len(total))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 7) -> np.ndarray:
    """Per bucket, embedding times the difference of the class vectors; the last entry is the bias."""
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    share = float(labels.mean()) if len(labels) else 0.5
    bias = np.log(np.array([max(1 - share, 1e-3), max(share, 1e-3)], np.float32))
    target = np.eye(2, dtype=np.float32)[labels]
    full = [k for k, (ids, _) in enumerate(bags) if len(ids)]
    epochs = -(-STEPS // max(1, -(-len(full) // BATCH)))
    steps = max(1, epochs * -(-len(full) // BATCH))
    step = 0
    for _ in range(epochs if 0 < share < 1 and full else 0):
        order = rng.permutation(full)
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            ids = np.concatenate([bags[k][0] for k in chosen])
            sizes = np.array([len(bags[k][0]) for k in chosen])
            part = np.concatenate([bags[k][1] / bags[k][1].sum() for k in chosen]).astype(np.float32)
            starts = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(table[ids] * part[:, None], starts, axis=0)
            logits = mean @ layer + bias
            logits -= logits.max(axis=1, keepdims=True)
            odds = np.exp(logits)
            error = odds / odds.sum(axis=1, keepdims=True) - target[chosen]
            rate = RATE * (1 - step / steps)
            back = error @ layer.T
            layer -= rate * (mean.T @ error) / len(chosen)
            bias -= rate * 0.1 * error.mean(axis=0)
            row = np.repeat(np.arange(len(chosen)), sizes)
            for d in range(DIMENSIONS):
                table[:, d] -= rate * np.bincount(ids, part * back[row, d], BUCKETS).astype(np.float32)
            step += 1
    return np.append(table @ (layer[:, 1] - layer[:, 0]), [bias[1] - bias[0]]).astype(np.float64)


def fit(docs: DataFrame, labels: DataFrame, label: str, sample: int = SAMPLE) -> np.ndarray:
    """Weights of the model, fitted in one task on a bounded sample of labelled documents."""
    chosen = kept(sampled_labels(labels, label, sample), "sample")
    texts = docs.select("doc_id", text_or_empty()).join(F.broadcast(chosen), "doc_id")  # bounded by `sample`

    def bags(batches):
        for batch in batches:
            got = [bag(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([g[0].tobytes() for g in got], pa.binary()),
                    pa.array([g[1].tobytes() for g in got], pa.binary()),
                ],
                names=["doc_id", "y", "ids", "counts"],
            )

    def learn(batches):
        rows = []
        for batch in batches:
            for doc_id, y, ids, counts in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append((doc_id, y, np.frombuffer(ids, np.int32), np.frombuffer(counts, np.float32)))
        rows.sort(key=lambda r: (r[0], len(r[2])))
        weights = train([r[2:] for r in rows], np.array([r[1] for r in rows], np.int64))
        yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()]})

    bagged = texts.mapInArrow(bags, "doc_id long, y int, ids binary, counts binary")
    [row] = bagged.repartition(1).mapInArrow(learn, "weights binary").collect()
    return np.frombuffer(row["weights"])


def score(docs: DataFrame, weights: np.ndarray, carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns of every document and its ``score``."""
    carry = carry or ["doc_id"]
    sent = docs.sparkSession.sparkContext.broadcast(weights)  # one number per bucket
    again = zlib.crc32(b"again") % BUCKETS

    def apply(batches):
        weights, known = sent.value, {}
        bias = weights[-1]

        def learn(word: str) -> tuple[float, int]:
            ids = features(word)
            got = (float(weights[ids].sum()), len(ids))
            if len(known) < CACHED_WORDS:
                known[word] = got
            return got

        for batch in batches:
            scores = []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                words = text.lower().split()
                total, n, repeats, last = 0.0, 0, 0, None
                for word in words:
                    got = known.get(word) or learn(word)
                    total += got[0]
                    n += got[1]
                    repeats += word == last
                    last = word
                if repeats:
                    total, n = total + 4 * repeats * weights[again], n + 4 * repeats
                logit = bias + (total / n if n else 0.0)
                scores.append(1 / (1 + np.exp(-np.clip(logit, -50, 50))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "score"]
            )

    names = [f"`{c}`" for c in carry]
    shaped = docs.select(*names, text_or_empty().alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*names).schema)
    return shaped.mapInArrow(apply, f"{kinds}, score double")
