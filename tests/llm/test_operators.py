"""Every operator against a plain calculation on a small table of awkward rows."""

import collections
import hashlib
import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidewatch.llm import cells, kdtree, mixing, packbits, packing, quality, repeats, setsketch, toxicity, warc
from tidewatch.llm.runindex import RunIndex
from tidewatch.llm.subwords import Subwords

BASE = " ".join(f"word{i % 97}x{i}" for i in range(120))
NEAR = BASE.replace("word5x5 ", "changed ")
TEXTS = [
    (1, BASE), (2, BASE), (3, NEAR), (4, None), (5, ""), (6, "one"), (7, "one"), (8, "two words"),
    (9, "ünïcode  ² tab\tnew\n\nline 'S don't " * 30), (10, "日本語 テキスト " * 40), (11, "a" * 5000),
    (12, "long words " * 4000), (13, " \n "), (13, "same id, other text"), (14, "x <|endoftext|> y"), (14, "x <|endoftext|> y"),
    (None, "no id"), (15, "prefix " + BASE[:300] + " suffix"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, length int, size string"


def as_docs(spark, rows):
    made = [(i, t, None, None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), 7, "clash") for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(made, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return as_docs(spark, TEXTS)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def clean(ids):
    return -1 if ids is None or ids != ids else int(ids)


def test_pieces_give_the_ids_of_the_whole_text():
    for name, drops in (("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)):
        coder = Subwords(public_tokenizers.path(name), drops, cached=50)
        for text in [t or "" for _, t in TEXTS] + ["Ab,c. D'll\r\n ¿qué?  «oui» x² 'tis"]:
            assert coder.encode([text])[0].tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("bits", [1, 5, 8, 16, 17, 32])
def test_bit_fields_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 999, dtype=np.uint64).astype(np.uint32)
    assert (packbits.unpack(packbits.pack(ids, bits), bits, len(ids)) == ids).all()


def test_packed_files(docs, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packbits.read_ids(*packbits.write_ids(docs, path, True, 1)).toPandas().sort_values("start")
    coder, place = Tokenizer.from_file(path), 0
    want = {(clean(i), zlib.crc32(np.array([*coder.encode(t or "", add_special_tokens=False).ids, 1], "<u4").tobytes())) for i, t in TEXTS}
    assert {(clean(r.doc_id), r.ids_crc32) for r in got.itertuples()} == want and len(got) == len(TEXTS)
    assert [clean(i) for i in got.doc_id] == sorted(clean(i) for i, _ in TEXTS)
    for r in got.itertuples():
        assert r.start == place
        place += r.n_tokens
    assert packbits.read_ids(*packbits.write_ids(nothing, path, True, 1)).count() == 0


def test_packing(docs, nothing):
    path = public_tokenizers.path("byte_bpe_50k.json")
    got = packing.pack_documents(docs, path).toPandas()
    coder = Tokenizer.from_file(path)
    want = collections.Counter()
    for i, t in TEXTS:
        ids = [*coder.encode(t or "", add_special_tokens=False).ids, 0]
        for k, (a, b) in enumerate(packing.cut(len(ids), 2048)):
            want[clean(i), k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert collections.Counter((clean(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got.itertuples()) == want
    for _, group in got.sort_values("offset").groupby("sequence_id"):
        assert (group.offset.to_numpy() == np.cumsum(group.length) - group.length).all() and group.length.sum() <= 2048
    assert packing.pack_documents(nothing, path).count() == 0


def test_plan_is_best_fit_decreasing():
    rng = np.random.default_rng(3)
    sizes = sorted(rng.integers(1, 101, 400).tolist(), reverse=True)
    gaps = []
    for s in sizes:
        fit = [g for g in gaps if g >= s]
        gaps.remove(min(fit)) if fit else None
        gaps.append((min(fit) if fit else 100) - s)
    plan = packing.plan_best_fit(collections.Counter(sizes), 100)
    used = collections.Counter()
    for length, _, n, first, per, _ in plan.tolist():
        for i in range(n):
            used[first + i // per] += length
    assert sorted(100 - v for v in used.values()) == sorted(gaps)


def test_vectors(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 8)).tolist()
    x += [[v + 0.01 * rng.normal() for v in x[k % 3]] for k in range(40)] + [x[0]] * 5
    rows = [(i, v, None) for i, v in enumerate(x)]
    rows += [(200, None, 1), (201, [0.0] * 8, 1), (202, [float("nan")] * 8, 1), (203, [None] * 8, 1), (204, [1.0], 1), (250, [], 1), (None, x[0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    full = {i: np.pad(np.float32(v).astype(float), (0, 8 - len(v))) for i, v, _ in rows if v is not None and i is not None and all(c is not None and c == c for c in v)}
    got = {r.vec_id: r for r in cells.near_duplicates(table).collect()}
    unit = {i: v / np.linalg.norm(v) for i, v in full.items() if v.any()}
    links = {i: {j for j in unit if j != i and unit[i] @ unit[j] >= 0.95} for i in unit}
    for i, *_ in rows:
        assert got[i].n_links == len(links.get(i, ()))
        reach, todo = {i}, [i]
        while todo:
            new = links.get(todo.pop(), set()) - reach
            reach |= new
            todo += new
        assert got[i].component_id == (min(reach) if i is not None else None) and got[i].kept == (got[i].component_id == i)
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in kdtree.top_k(table, F.col("vec_id") % 50 == 0).collect()}
    whole = {i: np.floor(256 * v) for i, v in full.items()}
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ whole[j]), j) for j in whole if j != q)[:5]
        assert [found[q, k + 1] for k in range(5)] == [(j, -s) for s, j in best]
    empty = spark.createDataFrame([], table.schema)
    assert cells.near_duplicates(empty).count() == 0 and kdtree.top_k(empty, F.lit(True)).count() == 0


def linked_by_brute_force(x, threshold=0.95):
    """Links and smallest reachable number of every row."""
    x = np.float32(x).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = x @ x.T >= threshold
    np.fill_diagonal(linked, False)
    least = np.arange(len(x))
    while True:
        new = np.minimum(least, np.where(linked, least[None, :], len(x)).min(axis=1))
        if (new == least).all():
            return linked.sum(axis=1), least
        least = new


@pytest.mark.parametrize("rank", [3, 6])
def test_links_across_cell_borders(spark, monkeypatch, rank):
    monkeypatch.setattr(cells, "CELL_ROWS", 150)
    rng = np.random.default_rng(rank)
    x = rng.normal(size=(1800, rank)) @ rng.normal(size=(rank, 64)) + 0.01 * rng.normal(size=(1800, 64))
    n_links, least = linked_by_brute_force(x)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = cells.near_duplicates(table).toPandas().sort_values("vec_id")
    assert int(n_links.sum()) - int(got.n_links.sum()) == 0
    assert (got.n_links.to_numpy() == n_links).all() and (got.component_id.to_numpy() == least).all()


def test_tight_groups_are_not_dealt_against_themselves(spark, monkeypatch):
    rim, cores, crowds = np.array([1, 0]), np.array([10, 10]), np.array([0, 0])
    assert len(cells.units_of(0, True, [], 7, rim, cores, crowds)) == 1 and cells.units_of(1, True, [], 7, rim, cores, crowds) == []
    monkeypatch.setattr(cells, "CELL_ROWS", 200)
    monkeypatch.setattr(cells, "MEMBERS", 32)
    rng = np.random.default_rng(9)
    x = np.r_[rng.normal(size=(1, 24)) + 0.03 * rng.normal(size=(500, 24)), rng.normal(size=(300, 24))]
    x = np.r_[x, x[:1] + 0.3 * rng.normal(size=(400, 24))]  # around the rim of the tight group
    n_links, least = linked_by_brute_force(x)
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<float>")
    got = cells.near_duplicates(table).toPandas().sort_values("vec_id")
    assert (got.n_links.to_numpy() == n_links).all() and (got.component_id.to_numpy() == least).all()


def test_huge_components_are_exact():
    x = np.array([[2.0**60, 1.0], [2.0**60, 2.0], [1.0, 1.0]])
    tree, best = kdtree.Tree(np.array([1, 2, 3]), x), []
    assert not tree.exact(x[:1])
    tree.search(1, x[0], tree.bounds(x[:1])[0], False, 1, best)
    assert best == [(2**120 + 2, -2)]


def labelled(spark):
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice(["river", "stone", "cloud", "green", "light"], 40)) for _ in range(160)]
    rows = [(100 + i, t if i % 4 else t.upper().replace(" ", "%%% "), int(i % 4 > 0)) for i, t in enumerate(good)]
    return rows


def test_quality(spark, docs, nothing):
    rows = labelled(spark)
    table = as_docs(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y, None) for i, _, y in rows] + [(None, 1, 1), (1, None, 1)], "doc_id long, quality int, toxic int")
    weights = quality.fit(table, labels, "quality")
    got = {r.doc_id: r.score for r in quality.score(table, weights).collect()}
    out = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert len(out) > 10 and all((got[i] >= 0.3) == y for i, y in out)
    assert quality.score(docs, weights).count() == len(TEXTS) and quality.score(nothing, weights).count() == 0
    assert quality.score(docs, quality.fit(docs, labels.limit(0), "quality")).select("score").distinct().collect()[0][0] == 0.5


def test_toxicity(spark, docs, nothing):
    rows = labelled(spark)
    bad = {i for i, _, _ in rows if i % 3 == 0}
    table = as_docs(spark, [(i, t + (" you id1оt and scumbag" if i in bad else " scumbag hunter")) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, int(i in bad)) for i, _, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(table, labels)
    assert any("idiot" in t for t in model.terms)
    got = {r.doc_id: r.score for r in toxicity.score(table, model).collect()}
    assert all((s >= 0.5) == (i in bad) for i, s in got.items())
    assert max(r.score for r in toxicity.score(docs, model).collect()) < 0.5
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).agg(F.max("score")).first()[0] == 0.0


def earlier_strings(rows, n=100):
    """By the definition: ids that rows repeat are documents of their own, not earlier than each other."""
    first, out = {}, collections.Counter()
    texts = [((-(1 << 63) if i is None else i), (t or "").encode()) for i, t in rows]
    for i, raw in texts:
        for p in range(len(raw) - n + 1):
            w = raw[p : p + n]
            first[w] = min(first.get(w, i), i)
    for i, raw in texts:
        mark, own = np.zeros(len(raw), bool), set()
        for p in range(len(raw) - n + 1):
            w = raw[p : p + n]
            if first[w] < i or w in own:
                mark[p : p + n] = True
            own.add(w)
        rest = bytes(np.frombuffer(raw, np.uint8)[~mark])
        spans = int((np.diff(np.r_[0, mark.astype(int)]) == 1).sum())
        out[None if i == -(1 << 63) else i, len(raw), int(mark.sum()), spans, hashlib.sha256(rest).hexdigest()] += 1
    return out


def test_repeats(spark, docs, nothing, monkeypatch):
    rng = np.random.default_rng(5)
    piece = ["".join(rng.choice(list("abcdé \n"), 150)) for _ in range(4)]
    rows = [(k, "".join(piece[c] + "".join(rng.choice(list("xyz"), 30)) for c in rng.integers(0, 4, 3))) for k in range(30)]
    rows += [(i + 100 if i else None, t) for i, t in TEXTS]
    alone = lambda k: "".join(rng.choice(list("mnopq"), k))
    p = alone(300)
    rows += [(200, p), (205, p + alone(50)), (205, alone(300)), (205, p[:250] + alone(40)), (205, p[:250] + alone(40))]
    rows += [(None, p), (None, alone(200) + p), (None, alone(300)), (None, p + "!" + p)]  # ids that are repeated
    table = as_docs(spark, rows)
    for most in (repeats.MOST, 2):
        monkeypatch.setattr(repeats, "MOST", most)
        got = repeats.remove_repeats(table).collect()
        assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == earlier_strings(rows)
    monkeypatch.setattr(repeats, "INDEXED", 1)  # every slice has an index of its own
    got = repeats.remove_repeats(table).collect()
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == earlier_strings(rows)
    assert repeats.remove_repeats(nothing).count() == 0


def test_matching_statistics():
    rng = np.random.default_rng(2)
    text = np.r_[rng.integers(0, 2, 60), 300, rng.integers(0, 2, 60), 301].astype(np.int64)
    index = RunIndex(text, 80)
    suffixes = [tuple(text[i:]) for i in index.order]
    assert suffixes == sorted(suffixes)
    common = [0] + [sum(1 for _ in itertools.takewhile(lambda p: p[0] == p[1], zip(a, b))) for a, b in zip(suffixes, suffixes[1:])]
    assert index.matching_statistics()[index.order].tolist() == common


def test_archives(spark):
    pages = [(1, "http://b.org/x", "<p>same</p>"), (2, "http://a.org", "<p>same</p>"), (3, None, None), (4, "bad url [", ""), (5, "http://a.org", "é" * 9000), (5, "http://a.org", "é" * 9000), (None, "http://c.org", "z")]
    table = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, time int").repartition(3)
    got = warc.capture_history(table).toPandas().sort_values(["part", "position"])
    assert list(zip(got.key, got.time)) == sorted(zip(got.key, got.time))
    most = {}
    for i, _, h in pages:
        most[h or ""] = max(most.get(h or "", -1), clean(i))
    for i, _, h in pages:
        row = got[got.page_id.map(clean) == clean(i)].iloc[0]
        assert row.payload_bytes == len((h or "").encode()) and row.payload_digest == warc.sha1((h or "").encode())
        assert (row.record_type, clean(row.refers_to)) == (("response", -1) if most[h or ""] == clean(i) else ("revisit", most[h or ""]))
    assert warc.capture_history(table.limit(0)).count() == 0


def test_loser_tree():
    rng = np.random.default_rng(4)
    for k in (0, 1, 2, 3, 7):
        runs = [sorted([f"{v:03d}", "", v, "", "", "", 0, 0, str(s), n] for n, v in enumerate(rng.integers(0, 50, 20).tolist())) for s in range(k)]
        merged = list(warc.LoserTree([iter(sorted(r, key=warc.order)) for r in runs]))
        assert merged == sorted((c for r in runs for c in r), key=warc.order)


def word_sets(rows, size):
    for i, t in rows:
        w = (t or "").encode().lower().split()
        yield i, {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()


def test_setsketch(spark, docs, nothing):
    got = collections.defaultdict(list)
    for r in setsketch.near_duplicates(docs, size=4).collect():
        got[r.doc_id].append(r)
    rows = list(word_sets(TEXTS, 4))
    for i, s in rows:
        assert len(s) in [r.n_shingles for r in got[i]]
    assert {r.component_id for i in (1, 2, 3) for r in got[i]} == {1} and got[7][0].component_id == 6 and got[4][0].kept
    assert got[None][0].component_id is None and got[15][0].kept and not got[3][0].kept
    assert setsketch.near_duplicates(nothing).count() == 0


def test_every_pair_at_the_threshold_is_linked(spark):
    # 4 of 5 shingles are common; the sketches of the first four pairs agree in 83 of 128 registers only.
    rows = []
    for k in [7342, 39377, 101044, 113523, *range(300)]:
        words = [f"{c}{k}" for c in "abcdefghi"]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words[:8]))]
    got = setsketch.near_duplicates(as_docs(spark, rows)).collect()
    assert [r.doc_id for r in got if r.component_id != r.doc_id // 2 * 2] == [] and len(got) == len(rows)


def test_setsketch_settles_chains(spark):
    words = [f"w{i}" for i in range(200)]
    rows = [(k, " ".join(words[2 * k : 2 * k + 60])) for k in range(40)]  # neighbours link, ends do not
    got = setsketch.near_duplicates(as_docs(spark, rows), size=4).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 1 << 63, 1200).astype(np.uint64)
    a, b = setsketch.sketch(pool[:1000]), setsketch.sketch(pool[200:])
    assert (np.maximum(a, b) == setsketch.sketch(pool)).all()
    est = setsketch.likeliest(np.array([(a > b).sum()]), np.array([(a < b).sum()]), np.array([1000.0]), np.array([1000.0]))
    assert abs(est[0] - 800 / 1200) < 0.12


def test_mixing(docs, nothing):
    got = mixing.mix(docs).toPandas()
    assert len(got) == len(TEXTS)
    per = got.assign(source=got.source.fillna("~")).groupby("source").agg({"size": "sum", "taken": "sum", "target": "first"})
    assert (abs(per.taken - per.target) < 1).all() and (per.target <= 3 * per["size"]).all()
    assert (got.taken <= 3 * got["size"]).all() and abs(per.target.sum() - per["size"].sum()) < 1e-6
    again = mixing.mix(docs.repartition(5)).toPandas()
    order = ["doc_id", "size", "taken"]
    assert got[order].sort_values(order).to_numpy().tolist().__repr__() == again[order].sort_values(order).to_numpy().tolist().__repr__()
    assert mixing.mix(nothing).count() == 0


@pytest.mark.parametrize("weight", [[1.0], [0.25], [0.01], [1.0, 0.25], [0.01, 50.0]])
def test_slices_are_even_at_every_weight(spark, weight):
    n, slices = 40_000, 200
    u = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    rate = F.element_at(F.array(*map(F.lit, weight)), (F.col("id") % len(weight) + 1).cast("int"))
    keys = spark.range(n).select((-F.log(1 - u) / rate).alias("key")).select("key", mixing.slice_of(F.col("key"), F.lit(slices)).alias("slice"))
    per = keys.groupBy("slice").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("a"), F.max("key").alias("b")).orderBy("slice").collect()
    assert max(r.n for r in per) < 1.4 * n / slices and all(r.b < s.a for r, s in zip(per, per[1:]))


def test_pipeline(spark, tmp_path):
    rows = labelled(spark)
    good = [(i, t) for i, t, y in rows if y]
    table = as_docs(spark, [(i, t) for i, t, _ in rows] + [(400, good[0][1]), (401, None), (402, "")]).drop("length", "size")
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    state, seen = table, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        state = stage(spark, state, str(tmp_path)).cache()
        assert state.columns == table.columns
        seen[name] = [r.doc_id for r in state.collect()]
    assert not {i for i, _, y in rows if not y} & set(seen["quality"]) and {i for i, _ in good} <= set(seen["quality"])
    assert 400 not in seen["near_duplicates"] and good[0][0] in seen["near_duplicates"]
    assert sorted(seen["repeats"], key=clean) == sorted(seen["near_duplicates"], key=clean)
    packed = corpus_pipeline.STAGES[-1][1](spark, state, str(tmp_path)).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    assert sorted(set(packed.doc_id)) == sorted(set(seen["mixing"]))


CLASHES = "size target key epochs taken slice docs budget score _n _h _id time id digest n own doc spans c_text".split()


def test_pipeline_keeps_columns_of_any_name(spark, tmp_path):
    """Each stage against plain Python, with columns that have the names the stages use."""
    rows = [(i, t, y) for i, t, y in labelled(spark)]
    texts = [(i, t) for i, t, _ in rows] + [(400, rows[1][1]), (401, None), (402, ""), (400, rows[1][1]), (None, rows[2][1])]
    extra = ", ".join(f"`{c}` string" for c in CLASHES)
    made = [(i, t, None, f"s{k % 2}", None if t is None else len(t), *[f"{c}{k}" for c in CLASHES]) for k, (i, t) in enumerate(texts)]
    table = spark.createDataFrame(made, f"doc_id long, text string, lang string, source string, n_chars long, {extra}")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    extras = {tuple(r[5:]) for r in made}
    run = lambda name, df: stages[name](spark, df, str(tmp_path))
    good = run("quality", table).cache()
    assert good.columns == table.columns and {tuple(r[5:]) for r in good.collect()} <= extras
    score = {(r.doc_id, r.text): r.score for r in quality.score(table, quality.fit(table, labels, "quality"), ["doc_id", "text"]).collect()}
    assert sorted((clean(r.doc_id), r.text or "") for r in good.collect()) == sorted(
        (clean(i), t or "") for i, t in texts if score[i, t] >= corpus_pipeline.ACCEPTED
    )
    few = run("near_duplicates", good).cache()
    assert few.columns == table.columns and {tuple(r[5:]) for r in few.collect()} <= extras
    assert [r.doc_id for r in few.collect()].count(400) == 0 and few.where("doc_id IS NULL").count() == good.where("doc_id IS NULL").count()
    cut = run("repeats", few).cache()
    want = earlier_strings([(r.doc_id, r.text) for r in few.collect()])
    assert {(i, sha): n for (i, _, _, _, sha), n in want.items()} == collections.Counter(
        (r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in cut.collect()
    )
    assert cut.columns == table.columns and all(r.n_chars == len(r.text) for r in cut.collect())
    mixed = run("mixing", cut).cache()
    assert mixed.columns == table.columns and {tuple(r[5:]) for r in mixed.collect()} <= extras
    taken = collections.Counter()
    for r in mixed.collect():
        taken[r.doc_id, r["size"]] += len(r.text.split())
    plan = mixing.mix(cut, carry=["size"])
    assert taken == {(r.doc_id, r.c_size): r.taken for r in plan.collect() if r.taken}
    packed = run("packing", mixed).toPandas()
    assert packed.groupby("sequence_id").length.sum().max() <= 2048
    assert packed.groupby("doc_id", dropna=False).size().sum() == len(packed) and set(packed.doc_id.map(clean)) == {clean(r.doc_id) for r in mixed.collect()}
