"""Toxicity from a weighted lexicon, matched by one automaton over folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits or signs that stand
for letters to plain letters, and turns every other character into a space. Terms are whole
words or word beginnings; they and their weights (smoothed log odds of toxic against other
documents) are learned from labels, by counting in tasks and summing by term. A term that
is followed or preceded by a word with which it occurs in clean documents only makes an
exception phrase; matches inside exception phrases do not count. A document's score is a
logistic function of its summed weights and of that sum for its length.

A text without words scores by the intercept alone, which is low; with no labels or one
class only every score is the share of label 1 (0 without labels). Null labels are left
out; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections import Counter, defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import kept, text_or_empty
from tidewatch.llm.quality import sampled_labels

SAMPLE = 20_000  # labelled documents that fit the lexicon, in expectation
PREFIXES = range(3, 11)
LEAST_DOCUMENTS = 5
LEAST_WEIGHT = 2.5
LEAST_RATIO = 20.0  # likelihood ratio (G) a term must reach
#: Characters that look like, or stand for, a plain letter.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i",
}
TWINS = {"i": "l", "l": "i"}  # both are written 1 and !; a lexicon term is stored with either


def _char(code: int) -> str:
    c = chr(code)
    wide = unicodedata.normalize("NFKC", c).lower()
    plain = wide if len(wide) == 1 else c.lower()[:1]
    plain = LOOKALIKES.get(plain, plain)
    return plain if plain.isalpha() else " "


class Folding(dict):
    """Translation table that fills itself; at most one entry per character of Unicode."""

    def __missing__(self, code: int) -> str:
        self[code] = got = _char(code)
        return got


def fold(text: str, table: Folding) -> str:
    """Words of plain letters with one space around each. Signs at a word's edge are no letters."""
    words = [w.strip("!$@.,:;?()[]\"'") or " " for w in text.split()]
    return f" {' '.join(' '.join(words).translate(table).split())} "


def terms_of(folded: str) -> set[str]:
    """Candidate terms: ' word ' and ' beginning' of every word."""
    out = set()
    for w in set(folded.split()):
        out.add(f" {w} ")
        out.update(f" {w[:n]}" for n in PREFIXES if n < len(w))
    return out


def weigh(counts: DataFrame, positives: int, negatives: int) -> DataFrame:
    """(term, weight) of terms whose share among toxic documents is significantly larger."""
    p, n = F.col("p"), F.col("n")
    base = (positives + 1) / (positives + negatives + 2)
    weight = F.log((p + 0.5) / (positives + 1)) - F.log((n + 0.5) / (negatives + 1))
    seen = p + n
    ratio = 2 * (
        p * F.log(F.greatest(p, F.lit(1e-9)) / (seen * base))
        + n * F.log(F.greatest(n, F.lit(1e-9)) / (seen * (1 - base)))
    )
    return (
        counts.select("term", weight.alias("weight"), ratio.alias("ratio"), "p")
        .where((F.col("weight") >= LEAST_WEIGHT) & (F.col("ratio") >= LEAST_RATIO) & (F.col("p") >= LEAST_DOCUMENTS))
    )


def thin(rows: list[tuple[str, float, int]]) -> dict[str, float]:
    """Terms out of (term, weight, toxic documents) that begin each other.

    A beginning that nearly always goes on in one way gives way to the longer term; of the
    others, the shortest that is about as telling as what it begins is kept.
    """
    found = {term: (weight, p) for term, weight, p in rows}
    same = set()
    for term, (weight, p) in found.items():
        for n in range(2, len(term)):
            if term[:n] in found and p >= 0.95 * found[term[:n]][1] and weight >= found[term[:n]][0] - 0.1:
                same.add(term[:n])
    weights = {t: w for t, (w, _) in found.items() if t not in same}
    best = dict(weights)
    for term, weight in weights.items():
        for n in range(2, len(term)):
            if term[:n] in best:
                best[term[:n]] = max(best[term[:n]], weight)
    out: dict[str, float] = {}
    for term in sorted(weights, key=len):
        covered = any(term[:n] in out for n in range(2, len(term)))
        if not covered and weights[term] >= best[term] - 0.7:
            out[term] = weights[term]
    return out


def automaton(terms: dict[str, float]) -> ahocorasick.Automaton:
    """Matches terms and the spellings in which an i and an l have changed places."""
    found = ahocorasick.Automaton()
    for term, weight in terms.items():
        spellings = {term}
        for i, c in enumerate(term):
            if c in TWINS:
                spellings.add(term[:i] + TWINS[c] + term[i + 1 :])
        for spelling in spellings:
            if spelling == term or spelling not in terms:
                found.add_word(spelling, (len(spelling), weight))
    if len(found):
        found.make_automaton()
    return found


def matches(folded: str, found: ahocorasick.Automaton) -> list[tuple[int, float]]:
    """(start of the word, weight) of matched words; the heaviest term of a word counts."""
    best: dict[int, float] = {}
    if len(found):
        for end, (size, weight) in found.iter(folded):
            start = end - size + 2
            best[start] = max(weight, best.get(start, 0.0))
    return sorted(best.items())


def around(folded: str, start: int) -> tuple[str, str]:
    """The two-word phrases that end and begin with the word at ``start``."""
    end = folded.find(" ", start)
    before = folded.rfind(" ", 0, max(0, start - 1)) + 1
    after = folded.find(" ", end + 1)
    return folded[before:end] if start > 1 else "", folded[start:after] if after > 0 else ""


def measure(folded: str, found: ahocorasick.Automaton, exceptions: set[str]) -> tuple[float, float]:
    total = 0.0
    for start, weight in matches(folded, found):
        if not exceptions or not exceptions.intersection(around(folded, start)):
            total += weight
    return np.log1p(total), total / np.sqrt(folded.count(" "))


def logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of two features and the intercept, by Newton steps with a small ridge."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        ridge = np.diag([1e-2, 1e-2, 1e-4])
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w += np.clip(step, -2, 2)
    return w


class Model:
    def __init__(self, terms: dict[str, float], exceptions: set[str], weights: list[float], share: float | None):
        self.terms, self.exceptions, self.weights, self.share = terms, exceptions, weights, share


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE) -> Model:
    chosen = kept(sampled_labels(labels, label, sample), "sample")
    counts = {r["y"]: r["count"] for r in chosen.groupBy("y").count().collect()}
    positives, negatives = counts.get(1, 0), counts.get(0, 0)
    if not positives or not negatives:
        return Model({}, set(), [], positives / max(1, positives + negatives))
    texts = docs.select("doc_id", text_or_empty()).join(F.broadcast(chosen), "doc_id")  # bounded by `sample`

    def count(batches):
        table, seen = Folding(), defaultdict(lambda: [0, 0])
        for batch in batches:
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for term in terms_of(fold(text, table)):
                    seen[term][y] += 1
                if len(seen) > 500_000:
                    yield emit(seen)
                    seen.clear()
        yield emit(seen)

    def emit(seen):
        return pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.string())]
            + [pa.array([v[i] for v in seen.values()], pa.int64()) for i in (1, 0)],
            names=["term", "p", "n"],
        )

    tallies = texts.mapInArrow(count, "term string, p long, n long").groupBy("term").agg(
        F.sum("p").alias("p"), F.sum("n").alias("n")
    )
    # Bounded: terms in five or more toxic documents of the sample.
    rows = sorted(weigh(tallies, positives, negatives).collect(), key=lambda r: (-r["ratio"], r["term"]))
    terms = thin([(r["term"], r["weight"], r["p"]) for r in rows])

    def phrases(batches):
        table, found, seen = Folding(), automaton(terms), defaultdict(Counter)
        for batch in batches:
            for text, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                folded = fold(text, table)
                for phrase in {p for start, _ in matches(folded, found) for p in around(folded, start) if p}:
                    seen[phrase][y] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.string())]
            + [pa.array([v[i] for v in seen.values()], pa.int64()) for i in (1, 0)],
            names=["term", "p", "n"],
        )

    said = texts.mapInArrow(phrases, "term string, p long, n long").groupBy("term").agg(
        F.sum("p").alias("p"), F.sum("n").alias("n")
    )
    # Bounded: phrases of lexicon words in at most about `sample` clean documents.
    exceptions = {r["term"] for r in said.where("n >= 3 and p = 0").select("term").collect()}

    def place(batches):
        table, found = Folding(), automaton(terms)
        for batch in batches:
            got = [measure(fold(t, table), found, exceptions) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.float64()), batch.column(2)],
                names=["a", "b", "y"],
            )

    # Bounded: three numbers for each document of the sample.
    points = sorted(texts.mapInArrow(place, "a double, b double, y int").collect(), key=lambda r: (r["y"], r["a"], r["b"]))
    x = np.array([[r["a"], r["b"]] for r in points])
    return Model(terms, exceptions, logistic(x, np.array([r["y"] for r in points])).tolist(), None)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    terms, exceptions, weights, share = model.terms, model.exceptions, model.weights, model.share

    def apply(batches):
        table, found = Folding(), automaton(terms)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            if share is not None:
                scores = [share] * len(texts)
            else:
                got = np.array([measure(fold(t, table), found, exceptions) for t in texts]).reshape(-1, 2)
                scores = 1 / (1 + np.exp(-np.clip(got @ weights[:2] + weights[2], -50, 50)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text_or_empty()).mapInArrow(apply, f"doc_id {kind}, score double")
