"""Hard negatives, ranked lexical search and exact de-duplication against plain calculations."""

import collections
import hashlib
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import fingerprints, lexical, negatives
from tidewatch.llm.common import join_groups

SCHEMA = "doc_id long, text string, n int, score string, item long, row int, print int, norm double"


def as_docs(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x", 2, 3, 4, 5.0) for i, t in rows], SCHEMA).repartition(3)


# --- exact de-duplication


def by_text(rows):
    """Rows (doc_id, keep_id, group_size, sha256) and, per text, how many rows are kept."""
    lowered = [(i, re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t in rows]
    groups = collections.defaultdict(list)
    for i, t in lowered:
        groups[t].append(-1 if i is None else i)
    digest = {t: hashlib.sha256(t.encode()).hexdigest() for t in groups}
    return collections.Counter((-1 if i is None else i, max(groups[t]), len(groups[t]), digest[t]) for i, t in lowered)


def found(df):
    rows = df.collect()
    none = lambda v: -1 if v is None else v
    kept = collections.Counter(r.text_sha256 for r in rows if r.kept)
    assert set(kept.values()) <= {1} and set(kept) == {r.text_sha256 for r in rows}
    assert all(none(r.doc_id) == none(r.keep_id) for r in rows if r.kept)
    return collections.Counter((none(r.doc_id), none(r.keep_id), r.group_size, r.text_sha256) for r in rows)


LONG = "Long text, " * 30_000  # six chunks
ROWS = [
    (1, "Some Text"), (2, "some text"), (3, "some  text"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, "SOME TEXT"),
    (8, "some text"), (8, "other"), (None, "other"), (None, "no id"), (None, "no id"), (9, LONG), (10, LONG.upper()),
    (11, LONG[:-1] + "!"), (12, "x" + LONG[1:]), (13, "日本" * 50_000), (14, "\x00"), (15, "\x00\x00"), (16, "ba"), (17, "ab"),
]


@pytest.mark.parametrize("bases", [None, [1], [0]])
def test_exact_duplicates(spark, bases):
    """At base 1 strings of the same bytes collide, at base 0 those with the same last byte."""
    got = fingerprints.exact_duplicates(as_docs(spark, ROWS), bases)
    assert found(got) == by_text(ROWS)


def test_exact_duplicates_of_one_text(spark):
    rows = [(i, "Copy" if i % 3 else "copy") for i in range(3000)] + [(-i, f"own {i}") for i in range(1, 200)]
    assert found(fingerprints.exact_duplicates(as_docs(spark, rows))) == by_text(rows)
    assert fingerprints.exact_duplicates(as_docs(spark, [])).count() == 0


def test_fingerprints_combine():
    rng = np.random.default_rng(1)
    maker = fingerprints.Polynomial(fingerprints.BASE)
    for size in (1, 7, 65_536, 65_537, 300_000):
        text = rng.integers(0, 256, size, dtype=np.uint8).tobytes()
        plain = 0
        for b in text:
            plain = (plain * fingerprints.BASE + b + 1) % fingerprints.MODULUS
        assert maker.of_texts([b"", text, b"a"]) == [0, plain, 98]
        cut = size // 3
        a, b = maker.of_texts([text[:cut], text[cut:]])
        assert fingerprints.combined(a, b, size - cut) == plain


def test_large_groups_join_apart_from_others(spark):
    rows = spark.createDataFrame([(k if k < 50 else 1000,) for k in range(400)], "k int")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("size"))
    for total in (400, 400 * 10_000):  # with and without groups that count as large
        got = join_groups(rows, groups, ["k"], "size", total).groupBy("k", "size").count().collect()
        assert {(r.k, r["size"], r["count"]) for r in got} == {(k, 1, 1) for k in range(50)} | {(1000, 350, 350)}


# --- ranked lexical search


def terms(text):
    return re.findall(lexical.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_score(docs, items, k):
    counts = [(i, collections.Counter(terms(t))) for i, t in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    n, total = len(counts), sum(s for *_, s in counts)
    df = collections.Counter(t for _, c, _ in counts for t in c)
    out = collections.Counter()
    for item, text in items:
        asked = collections.Counter(terms(text))
        scored = []
        for i, c, size in counts:
            m = 75 + 25 * size * n // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, times in asked.items() if t in c
            )
            if score:
                scored.append((-score, i is None, i if i is not None else 0))
        for rank, (score, missing, i) in enumerate(sorted(scored)[:k], 1):
            out[item, rank, None if missing else i, -score] += 1
    return out


def random_texts(rng, rows, words):
    p = 1 / np.arange(1, words + 1)
    size = lambda: int(rng.choice([0, 3, 30, 300]))
    return [" ".join(f"W{w}" if w % 5 else f"é{w}-w1" for w in rng.choice(words, size(), p=p / p.sum())) for _ in range(rows)]


@pytest.mark.parametrize("bucket", [4, 4096])
def test_lexical_search(spark, monkeypatch, bucket):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    rng = np.random.default_rng(bucket)
    texts = random_texts(rng, 300, 400)
    docs = [(i, t) for i, t in enumerate(texts)] + [(500 + i, texts[7]) for i in range(60)]
    docs += [(1, texts[9]), (1, texts[9]), (None, texts[12]), (None, texts[7]), (900, None), (901, ""), (902, "...")]
    docs += [(903, "w1 " * 20_000 + "rare Word"), (904, "RARE")]
    items = list(enumerate(random_texts(rng, 25, 400))) + [(3, "rare w1 w1"), (None, "word"), (50, None), (51, "absent"), (52, texts[7])]
    benchmark = as_docs(spark, items).withColumnRenamed("doc_id", "item_id")
    want = by_score(docs, items, 20)
    for block in (lexical.BLOCK_TERMS, 200):
        monkeypatch.setattr(lexical, "BLOCK_TERMS", block)
        got = lexical.rank_documents(as_docs(spark, docs), benchmark)
        assert collections.Counter(map(tuple, got.collect())) == want
        monkeypatch.undo()
        monkeypatch.setattr(lexical, "BUCKET", bucket)
    assert lexical.rank_documents(as_docs(spark, []), benchmark).count() == 0
    assert lexical.rank_documents(as_docs(spark, docs), benchmark.limit(0)).count() == 0


def test_buckets_lose_nothing_and_skip():
    """Bounds never drop a row that reaches the score, and a high score skips the bucket."""
    rng = np.random.default_rng(5)
    sizes = rng.integers(1, 12, 200)
    rows = [np.sort(rng.choice(60, s, replace=False)) for s in sizes]
    flat = np.concatenate(rows)
    impacts = rng.integers(1, 10**6, len(flat))
    norms = np.sqrt(np.add.reduceat(impacts.astype(float) ** 2, np.cumsum(sizes) - sizes))
    bucket = lexical.Bucket(np.arange(200), norms, sizes, flat, impacts)
    for _ in range(50):
        asked = np.sort(rng.choice(70, 9, replace=False))
        weights = rng.integers(1, 8000, 9)
        dense = np.zeros(70, np.int64)
        dense[asked] = weights
        exact = np.array([dense[r] @ impacts[e - s : e] for r, s, e in zip(rows, sizes, np.cumsum(sizes))])
        dense[:] = 0
        for least in (0, int(np.sort(exact)[-20]), int(np.sort(exact)[-3]), int(exact.max())):
            scores, at = bucket.search(asked, weights, dense, least)
            assert dict(zip(at.tolist(), scores.tolist())) == {i: s for i, s in enumerate(exact.tolist()) if s >= max(least, 1)}
        assert not len(bucket.search(asked, weights, dense, 1 << 60)[0])


# --- hard negatives


def by_windows(rows):
    good = [
        (i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(c))) for c in v])
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)
    ]
    out = collections.Counter()
    for a, label, x in good:
        if a % 100:
            continue
        score = [sum(p * q for p, q in zip(x, y)) for *_, y in good]
        positives = sorted((-s, j) for s, (j, m, _) in zip(score, good) if m == label and j != a)[:5]
        for ps, p in positives:
            inside = sorted((-s, j) for s, (j, m, _) in zip(score, good) if m != label and -30 * ps <= 100 * s <= -90 * ps)
            for rank, (s, j) in enumerate(inside[:10], 1):
                out[a, p, rank, j, -ps, -s] += 1
    return out


def mined(table):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.hard_negatives(table, label, F.col("vec_id") % 100 == 0)
    return collections.Counter(map(tuple, got.collect()))


@pytest.mark.parametrize("width, tight", [(8, 0.3), (64, 0.05), (64, 1.0)])
def test_hard_negatives(spark, monkeypatch, width, tight):
    for name, value in (("LEAST_ROWS", 150), ("PIECE", 90), ("ANCHORS", 3)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(width)
    centers = rng.normal(size=(12, width))
    x = centers[rng.integers(0, 12, 700)] + tight * rng.normal(size=(700, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(int(i), [float(c) for c in v], int(rng.integers(0, 4))) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[i % 9][1], i % 3) for i in range(80)]  # ties
    rows += [(2000, None, 1), (2001, rows[0][1], None), (2002, [float("nan")] * width, 1), (2003, [None] * width, 1), (None, rows[0][1], 1)]
    rows += [(2100, [0.0] * width, 1), (2200, [], 1), (2300, [1.0], 2), (2400, [-1.0, 0.5], 3), (2500, rows[4][1], 77)]
    schema = "vec_id long, embedding array<float>, label int, at int, x string, number int, score int, _n int"
    table = spark.createDataFrame([(*r, 1, "x", 2, 3, 4) for r in rows], schema).repartition(3)
    assert mined(table) == by_windows(rows)
    assert not mined(table.limit(0)) and not mined(table.where("vec_id % 100 > 0"))


def test_hard_negatives_beyond_exact_doubles(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(c)) for c in 1e5 * rng.normal(size=4)], int(i % 3)) for i in range(150)]
    assert mined(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")) == by_windows(rows)


def test_index_leaves_out_covered_dimensions_and_loses_nothing():
    rng = np.random.default_rng(3)
    x = np.floor(256 * rng.normal(size=(500, 20)) * np.linspace(1, 0.02, 20))
    q = np.floor(256 * rng.normal(size=(30, 20)) * np.linspace(1, 0.02, 20))
    lengths = np.linalg.norm(q, axis=1)
    for share in (0.0, 40.0, 200.0, 500.0):
        index = negatives.Index(np.arange(500), np.zeros(500, int), x, share)
        least = np.ceil(share * lengths).astype(np.int64) if share else np.full(30, negatives.LEAST)
        pair, row = index.candidates(q, least)
        got = set(zip(pair.tolist(), index.ids[row].tolist()))
        exact = q @ x.T
        assert got >= {(i, j) for i in range(30) for j in range(500) if exact[i, j] >= least[i]}
        assert (index.scores(q, pair, row) == exact[pair, index.ids[row]]).all()
        assert (index.held.sum() < 500 * 20) == (share > 0)
        if share >= 200:
            assert len(got) < 0.8 * exact.size
