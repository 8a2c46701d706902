"""What removing repeated strings leaves on disk."""

import collections
import hashlib
import time

import numpy as np
import pytest

from tidewatch.llm import common, repeats


def removed(rows, n=100):
    """(id, bytes removed, digest of the rest) by the definition, for ids that do not repeat."""
    first = {}
    for i, text in rows:
        for p in range(len(text) - n + 1):
            first[text[p : p + n]] = min(first.get(text[p : p + n], (i, p)), (i, p))
    out = collections.Counter()
    for i, text in rows:
        mark = np.zeros(len(text), bool)
        for p in range(len(text) - n + 1):
            if first[text[p : p + n]] < (i, p):
                mark[p : p + n] = True
        rest = "".join(c for c, m in zip(text, mark) if not m)
        out[i, int(mark.sum()), hashlib.sha256(rest.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("halvings", [1, 3, 7])
def test_strings_of_common_phrases(spark, monkeypatch, halvings):
    """A phrase with many surroundings: strings do not meet one by one unless most of them is common."""
    rng = np.random.default_rng(12)
    alone = lambda k: "".join(rng.choice(list("abcdefgh"), k))
    phrase, longer, around = alone(45), alone(94), [alone(80) for _ in range(3)]
    texts = [alone(90) + phrase + alone(90) for _ in range(150)]
    texts += [alone(40) + longer + alone(40) for _ in range(60)]
    texts += [around[rng.integers(3)][: rng.integers(30, 81)] + phrase + around[rng.integers(3)][rng.integers(0, 50) :] for _ in range(60)]
    texts += ["the " * int(rng.integers(20, 60)) + alone(30) for _ in range(30)]
    rows = list(enumerate(rng.permutation(texts).tolist()))
    monkeypatch.setattr(repeats, "MOST", 8)
    monkeypatch.setattr(repeats, "HALVINGS", halvings)
    made = {}

    def settled(df, name, keep=common.settled):
        made[name] = keep(df, name)
        return made[name]

    monkeypatch.setattr(repeats, "settled", settled)
    got = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.n_removed, r.kept_sha256) for r in got) == removed(rows)
    strings, contexts = made["indexed"].where("h IS NOT NULL").count(), made["contexts"].where("m > 8").count()
    assert contexts > 200
    if halvings == 3:
        assert strings < 3 * contexts  # before, more than 40 for each


def test_shuffles_of_settled_tables_are_deleted(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {name for name in files.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in name and name.endswith(".data")}

    before = shuffles()
    table = common.settled(spark.range(1000).repartition(3, "id"), "numbers")
    end = time.time() + 20
    while (left := shuffles() - before) and time.time() < end:
        time.sleep(0.1)  # they go in the background
    assert not left and table.count() == 1000
    assert spark.conf.get(common.CLEANUP) == "false"
