"""Tokenizing whole texts with a public vocabulary, with a cache of text pieces.

The vocabularies split a text by a fixed pattern before any merge, so the ids of a text are
the ids of its pieces in order. A piece here ends only where that pattern always ends one:
between white space and words, and after a run of letters. Texts for which this does not
hold plainly (other alphabets, control characters, written special tokens) go to the
tokenizer whole.
"""

from __future__ import annotations

import re
import string
from collections import defaultdict
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
from tokenizers import Tokenizer

from tidewatch.llm.common import single_threaded

LETTERS = "a-zA-ZªµºÀ-ÖØ-öø-ÿ"
CONTROL = bytes([0, 0x1C, 0x1D, 0x1E, 0x1F, 0x85])
WORDS = re.compile(rf"[{LETTERS}]+|[^\s{LETTERS}]\S*")
WORDS_WITH_SPACE = re.compile(rf" ?[{LETTERS}]+| ?[^\s{LETTERS}]\S*|\s+(?!\S)|\s+")
RARE_SPACE = b"\t\x0b\x0c\r\xa0"  # all white space but blanks and line ends
LINES_AS_BLANKS = bytes(32 if b == 10 else b for b in range(256))
MARKS = string.punctuation
WORDS_A_CALL = 256
CALLS = 16  # that the tokenizer gets at once
CACHED_PIECES = 1_300_000


def plain(text: str) -> bytes | None:
    """The text as Latin-1, if its pieces can be told without the vocabulary's own pattern."""
    try:
        raw = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return raw if len(raw.translate(None, CONTROL)) == len(raw) and b"<|" not in raw else None


def odd_space(raw: bytes) -> bool:
    """Whether white space is anything but single blanks and line ends between words."""
    blanks = raw.translate(LINES_AS_BLANKS)
    return len(raw.translate(None, RARE_SPACE)) != len(raw) or b"  " in blanks or blanks[:1] == b" " or blanks[-1:] == b" "


class Subwords:
    """Ids of texts, the same as ``Tokenizer.encode(text, add_special_tokens=False)``.

    ``drops_space`` says that the vocabulary lower-cases words, drops white space and marks
    the last id of a word; otherwise a space belongs to the word after it. Every word (what
    stands between spaces) gets a number when it is first seen, so a text costs one look-up a
    word; the ids of all words lie in one array and are gathered by these numbers.
    """

    def __init__(self, path: str, drops_space: bool, cached: int = CACHED_PIECES):
        single_threaded()
        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.kind = np.uint16 if self.size <= 1 << 16 else np.uint32
        self.drops_space = drops_space
        self.lead = "" if drops_space else " "
        self.pattern = WORDS if drops_space else WORDS_WITH_SPACE
        self.cached = cached
        self.edge = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.edge[i] = token.endswith("</w>") if drops_space else token.startswith("Ġ")
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = defaultdict(count().__next__)  # of what stands between spaces, with a space before it
        self.pieces: dict[str, bytes] = {}  # everything else
        self.ids = np.zeros(1 << 16, self.kind)
        self.used = 0
        self.begin, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def direct(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, self.kind).tobytes()

    def _since(self, known: int) -> list[str]:
        """Words numbered from ``known`` on, in order."""
        return list(islice(reversed(self.numbers), len(self.numbers) - known))[::-1]

    def _keep(self, numbers: list[int], lengths: np.ndarray, ids: np.ndarray) -> None:
        """Ids of words, one after another."""
        if len(self.numbers) > len(self.begin):
            more = np.zeros(2 * len(self.numbers) - len(self.begin), np.int64)
            self.begin, self.length = np.r_[self.begin, more], np.r_[self.length, more]
        if self.used + len(ids) > len(self.ids):
            self.ids = np.r_[self.ids, np.zeros(self.used + 2 * len(ids), self.kind)]
        self.begin[numbers] = self.used + np.cumsum(lengths) - lengths
        self.length[numbers] = lengths
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def _keep_raw(self, numbers: list[int], coded: list[bytes]) -> None:
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // np.dtype(self.kind).itemsize
        self._keep(numbers, lengths, np.frombuffer(b"".join(coded), self.kind))

    def _learn_letters(self, words: list[str]) -> None:
        """Runs of letters, many in one call; the ids of each end (or begin) with a marked id."""
        lead, numbers = self.lead, self.numbers
        step = WORDS_A_CALL * CALLS
        for start in range(0, len(words), step):
            groups = [words[at : at + WORDS_A_CALL] for at in range(start, min(start + step, len(words)), WORDS_A_CALL)]
            coded = self.tokenizer.encode_batch_fast([lead + " ".join(g) for g in groups], add_special_tokens=False)
            for group, code in zip(groups, coded):
                ids = np.array(code.ids, self.kind)
                cuts = np.flatnonzero(self.edge[ids])
                if len(cuts) == len(group):
                    cuts = np.r_[0, cuts + 1] if self.drops_space else np.r_[cuts, len(ids)]
                    self._keep([numbers[p] for p in group], np.diff(cuts), ids)
                else:
                    self._keep_raw([numbers[p] for p in group], [self.direct(lead + p) for p in group])

    def _learn_pieces(self, pieces: set[str]) -> None:
        new = list(pieces.difference(self.pieces))
        for p, code in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self.pieces[p] = np.array(code.ids, self.kind).tobytes()

    def _word(self, number: int) -> bytes:
        at = self.begin[number]
        return self.ids[at : at + self.length[number]].tobytes()

    def _learn(self, known: int) -> None:
        """Ids of all words numbered from ``known`` on."""
        letters, marked, others = [], [], []
        for w in self._since(known):
            if w.isalpha():
                letters.append(w)
            elif (core := w.rstrip(MARKS)).isalpha():
                marked.append((w, core, w[len(core) :]))
            else:
                others.append(w)
        numbers = self.numbers
        seen = len(numbers)
        cores = [numbers[core] for _, core, _ in marked]
        self._learn_letters(letters + self._since(seen))
        self._learn_pieces({tail for _, _, tail in marked})
        self._keep_raw(
            [numbers[w] for w, _, _ in marked],
            [self._word(core) + self.pieces[tail] for core, (_, _, tail) in zip(cores, marked)],
        )
        self._keep_raw([numbers[w] for w in others], self._by_piece([self.lead + w for w in others]))

    def _by_piece(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts, piece by piece."""
        split, numbers, pieces = self.pattern.findall, self.numbers, self.pieces
        n, seen = len(self.lead), len(numbers)
        parts = [
            [numbers[p[n:]] if p[:n] == self.lead and p[n:].isalpha() else p for p in split(t)] for t in texts
        ]
        self._learn_letters(self._since(seen))
        self._learn_pieces({p for part in parts for p in part if isinstance(p, str)})
        return [b"".join([pieces[p] if isinstance(p, str) else self._word(p) for p in part]) for part in parts]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.pieces) + len(self.numbers) > self.cached:
            self.forget()
        try:
            return self._encode(texts)
        except BaseException:
            self.forget()  # words may have numbers but no ids yet
            raise

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, self.kind)] * len(texts)
        split: list[tuple[int, str, list[str]]] = []
        slow: list[int] = []
        for i, text in enumerate(texts):
            if not text:
                continue
            raw = plain(text)
            if raw is None:
                out[i] = np.frombuffer(self.direct(text), self.kind)
            elif self.drops_space:
                split.append((i, "", text.lower().split()))
            elif odd_space(raw):
                slow.append(i)
            else:
                first, *words = text.split(" ")
                split.append((i, first, words))
        known = len(self.numbers)
        counts = np.array([0] + [len(words) for _, _, words in split])
        bounds = np.cumsum(counts)
        words = chain.from_iterable([words for _, _, words in split])
        row = np.fromiter(map(self.numbers.__getitem__, words), np.int64, bounds[-1])
        self._learn(known)
        ids = self._by_piece([first for _, first, _ in split] + [texts[i] for i in slow])
        lengths = self.length[row]
        ends = np.r_[0, np.cumsum(lengths)]
        found = self.ids[np.repeat(self.begin[row] - ends[:-1], lengths) + np.arange(ends[-1])]
        cuts = ends[bounds].tolist()
        for (i, _, _), first, a, b in zip(split, ids, cuts, cuts[1:]):
            out[i] = np.r_[np.frombuffer(first, self.kind), found[a:b]] if first else found[a:b]
        for i, raw in zip(slow, ids[len(split) :]):
            out[i] = np.frombuffer(raw, self.kind)
        return out


@lru_cache(maxsize=1)
def shared_subwords(path: str, drops_space: bool) -> Subwords:
    """One for all tasks that a worker runs one after another, so that words learned once stay known."""
    return Subwords(path, drops_space)
