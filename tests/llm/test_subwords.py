"""Ids of texts from numbered words, kept over the tasks of a worker."""

import os

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tidewatch.llm.subwords import Subwords, shared_subwords

VOCABULARIES = [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)]


def whole(coder, text):
    return coder.tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name, drops", VOCABULARIES)
@pytest.mark.parametrize("cached", [20, 1 << 20])
def test_random_words_and_marks(name, drops, cached):
    coder = Subwords(public_tokenizers.path(name), drops, cached)
    rng = np.random.default_rng(7)
    parts = ["ab", "Über", "don't", "'s", "x²", "12", "ªº", "!!", "'", "_", "a,b", "end.\nNext", "½", "¿", "ÿ", "«", "~)", "e-f"]
    for _ in range(30):
        texts = [
            " ".join("".join(rng.choice(parts, rng.integers(1, 4))) for _ in range(rng.integers(0, 12))) for _ in range(9)
        ] + ["", " lead", "two  blanks", "日本 x", "a <|endoftext|> b", "\n"]
        assert [ids.tolist() for ids in coder.encode(texts)] == [whole(coder, t) for t in texts]


@pytest.mark.parametrize("name, drops", VOCABULARIES)
def test_a_failure_leaves_no_word_without_ids(name, drops):
    coder = shared_subwords(public_tokenizers.path(name), drops)
    good, text = coder.tokenizer, "fresh words, that fail at first"

    class Broken:
        def encode_batch_fast(self, *_, **__):
            raise RuntimeError("lost")

    coder.tokenizer = Broken()
    with pytest.raises(RuntimeError):
        coder.encode([text])
    coder.tokenizer = good
    assert coder.encode([text])[0].tolist() == whole(coder, text)


def test_tasks_of_a_worker_share_what_they_learned(spark):
    path = public_tokenizers.path("word_bpe_49k.json")

    def look(batches):
        coder = shared_subwords(path, True)
        known = len(coder.numbers)
        coder.encode(["some words to learn"])
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"pid": [os.getpid()], "new": [len(coder.numbers) - known]})

    rows = spark.range(40).repartition(40).mapInArrow(look, "pid long, new long").collect()
    learned = [r.pid for r in rows if r.new]
    assert len(learned) == len(set(learned))
