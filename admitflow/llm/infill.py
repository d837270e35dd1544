"""Fill-in-the-middle: cut a text at two token boundaries and write its parts in another order.

A token is a run of ASCII letters or any other single code point. Code points fall into four classes, one of them the
letters that go on with a token. A wavelet matrix over the classes answers how many code points of a class stand before
a place; the ranks of the other three add up to the number of tokens that have started, and bisection on that number
finds the place of a token. One matrix covers many documents, and all their cuts are found by one bisection.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admitflow.llm.common import bounded_runs

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # of 100: h3 from here leaves a text as it is
SUFFIX_FIRST_BELOW = 20  # of 100: h4 below this puts the suffix first
SEED = "1:"

# Classes of code points.
_INSIDE, _STARTS, _WHITE, _OTHER = range(4)
_LEVELS = 2
# Code points that share a wavelet matrix; a longer text has one of its own.
RUN_CHARS = 1 << 21


class WaveletMatrix:
    """Ranks over a sequence of small numbers.

    Each level holds one bit of every symbol in 64-bit words, with the ones before each word; the next level has the
    symbols with a zero first.
    """

    def __init__(self, symbols: np.ndarray, levels: int):
        self._levels = []
        for level in reversed(range(levels)):
            bits = (symbols >> level) & 1
            words = np.zeros(len(bits) // 64 + 1, np.uint64)
            words.view(np.uint8)[: (len(bits) + 7) // 8] = np.packbits(bits, bitorder="little")
            before = np.zeros(len(words) + 1, np.int64)
            np.cumsum(np.bitwise_count(words), out=before[1:])
            self._levels.append((level, words, before, len(bits) - int(before[-1])))
            symbols = np.concatenate([symbols[bits == 0], symbols[bits == 1]])

    def rank(self, symbol: int, ends: np.ndarray) -> np.ndarray:
        """How many of the first ``ends`` symbols are ``symbol``, for each of ``ends``."""
        starts = np.zeros_like(ends)
        for level, words, before, zeros in self._levels:
            if symbol >> level & 1:
                starts, ends = zeros + _ones(words, before, starts), zeros + _ones(words, before, ends)
            else:
                starts, ends = starts - _ones(words, before, starts), ends - _ones(words, before, ends)
        return ends - starts


def _ones(words: np.ndarray, before: np.ndarray, ends: np.ndarray) -> np.ndarray:
    word = ends >> 6
    below = (np.uint64(1) << (ends & 63).astype(np.uint64)) - np.uint64(1)
    return before[word] + np.bitwise_count(words[word] & below)


class Boundaries:
    """Token boundaries of several texts."""

    def __init__(self, texts: list[str]):
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.lengths, self._starts = lengths, np.cumsum(lengths) - lengths
        points = np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")
        lowered = points | 32
        letter = (lowered >= ord("a")) & (lowered <= ord("z")) & (points < 128)
        goes_on = letter.copy()
        goes_on[1:] &= letter[:-1]
        goes_on[self._starts[lengths > 0]] = False
        white = (points == 32) | ((points >= 9) & (points <= 13))
        classes = np.where(letter, np.where(goes_on, _INSIDE, _STARTS), np.where(white, _WHITE, _OTHER))
        self._matrix = WaveletMatrix(classes.astype(np.uint8), _LEVELS)

    def _started(self, places: np.ndarray) -> np.ndarray:
        """Tokens of each text that start before a place in it."""
        def up_to(ends: np.ndarray) -> np.ndarray:
            return sum(self._matrix.rank(c, ends) for c in (_STARTS, _WHITE, _OTHER))

        return up_to(self._starts + places) - up_to(self._starts)

    def tokens(self) -> np.ndarray:
        return self._started(self.lengths)

    def places(self, tokens: np.ndarray) -> np.ndarray:
        """Where token number ``tokens`` of each text starts; its length, if there is no such token."""
        low, high = np.zeros_like(self.lengths), self.lengths.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            before = self._started(middle) <= tokens
            low = np.where(open_ & before, middle, low)
            high = np.where(open_ & ~before, middle - 1, high)
        return low


_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _draws(doc_id: int | None, seed: str) -> list[int]:
    digest = hashlib.sha256(f"{seed}{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def _form(text: str, draws: list[int], plain_from: int, suffix_first_below: int) -> str:
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or draws[2] % 100 >= plain_from:
        return "plain"
    return "spm" if draws[3] % 100 < suffix_first_below else "psm"


def _written(text: str, form: str, first: int, second: int) -> str:
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def _cut_task(seed: str, plain_from: int, suffix_first_below: int):
    def cut_run(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
        boundaries = Boundaries(texts)
        tokens = boundaries.tokens()
        draws = [_draws(i, seed) for i in ids]
        cuts = np.sort(np.array([d[:2] for d in draws], np.int64) % (tokens[:, None] + 1), axis=1)
        firsts, seconds = (boundaries.places(cuts[:, k]).tolist() for k in (0, 1))
        forms, prefixes, middles, outputs = [], [], [], []
        for text, own, first, second in zip(texts, draws, firsts, seconds):
            form = _form(text, own, plain_from, suffix_first_below)
            plain = form == "plain"
            forms.append(form)
            prefixes.append(None if plain else first)
            middles.append(None if plain else second - first)
            outputs.append(text if plain else _written(text, form, first, second))
        columns = [
            pa.array(ids, pa.int64()), pa.array(tokens, pa.int64()), pa.array(forms, pa.string()),
            pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), (text.as_py() or "" for text in batch.column(1)))
            for run in bounded_runs(rows, lambda row: len(row[1]), RUN_CHARS):
                ids, texts = zip(*run)
                yield cut_run(list(ids), list(texts))

    return cut


def transform(
    docs: DataFrame, seed: str = SEED, plain_from: int = PLAIN_FROM, suffix_first_below: int = SUFFIX_FIRST_BELOW
) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document.

    A null text is empty, and an empty one stays plain with no tokens. A null doc_id is hashed as nothing after the seed
    and passed on. Repeated rows give the same row each. Cuts may coincide or lie at an end; parts are empty then. A
    text that holds one of the marks stays plain, so every output can be taken apart. Other columns are not read. An
    empty table gives no rows. Nothing is shuffled.
    """
    task = _cut_task(seed, plain_from, suffix_first_below)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task, _SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text again, from an output and its form alone."""
    def between(mark: str, next_mark: str) -> Column:
        return F.substring_index(F.substring_index(output, mark, -1), next_mark, 1)

    middle = F.substring_index(output, MIDDLE, -1)
    psm = F.concat(between(PREFIX, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(docs: DataFrame) -> DataFrame:
    """Digests of each output and of the text restored from it."""
    cut = transform(docs)
    back = restored(F.col("output"), F.col("form"))
    return cut.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(back, 256).alias("restored_sha256"),
    )
