"""Language of every word, and of a text, by a linear-chain conditional random field.

A word's evidence for a language is a weight for each affix and inner character n-gram (n-grams of the word between two
boundary marks) and for the word itself if the lexicon holds it. Learned transition weights say how readily the language
changes from one word to the next, so a foreign passage is labelled as such and a stray word is not. Forward-backward
gives each word's chances; a text's language is the one with the largest sum of them.

The field is trained here on a bounded sample: runs of words from sampled documents are strung together into
code-switched sequences, so that transitions are learned too.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitflow.llm.common import first_by_hash, held_out

# Bounds of the learning sample: documents of each language, and the characters learnt of one. A longer text is learnt
# from slices spread evenly over all of it.
DOCS_PER_LANGUAGE = 150
LEARNT_CHARS = 20_000
LEARNT_SLICES = 10
ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 17
LEXICON_LEAST = 3
EPOCHS = 12
RATE = 0.3
RIDGE = 1e-4
RUN_WORDS = (8, 60)
RUNS_PER_SEQUENCE = 8
# Words that one forward-backward pass holds, and words whose evidence a task remembers.
PASS_WORDS = 1_000_000
REMEMBERED = 400_000
UNDETERMINED = "und"

_WORD = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case."""
    return _WORD.findall(text.lower())


def ngram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram of " word ", in order of the words."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    space = codes == 32
    # A boundary mark belongs to the word after it, the last one to the word before.
    word = np.cumsum(space) - 1
    owners, buckets = [], []
    for n in ORDERS:
        size = len(codes) - n + 1
        if size <= 0:
            continue
        mixed = np.full(size, n, np.uint64)
        inner = np.zeros(size, bool)
        for k in range(n):
            mixed = (mixed ^ codes[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            if 0 < k < n - 1:
                inner |= space[k : k + size]
        # Not across words, and not a boundary mark alone.
        good = ~inner & ~(space[:size] & space[n - 1 : n - 1 + size])
        owners.append(word[:size][good])
        buckets.append((mixed[good] >> np.uint64(40)).astype(np.int64) % BUCKETS)
    owner, bucket = np.concatenate(owners), np.concatenate(buckets)
    order = np.argsort(owner, kind="stable")
    return owner[order], bucket[order]


def layout(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Time-major places of sequences that are sorted from long to short.

    Gives how many sequences reach each step, where the step's entries start, and the place of each word.
    """
    steps = int(lengths[0]) if len(lengths) else 0
    reach = len(lengths) - np.searchsorted(lengths[::-1], np.arange(steps), side="right")
    start = np.concatenate([[0], np.cumsum(reach)])
    sequence = np.repeat(np.arange(len(lengths)), lengths)
    first = np.repeat(np.cumsum(lengths) - lengths, lengths)
    step = np.arange(len(sequence)) - first
    return reach, start, start[step] + sequence


def forward_backward(
    evidence: np.ndarray, reach: np.ndarray, start: np.ndarray, change: np.ndarray
) -> tuple[np.ndarray, np.ndarray, float]:
    """Chances of each entry's label, expected label changes, and log-likelihood of the normaliser.

    ``evidence`` holds log weights by time-major place, ``change`` the log weights of (label, next label).
    """
    peak = evidence.max(axis=1, keepdims=True)
    weight = np.exp(evidence - peak)
    moves = np.exp(change)
    before = np.empty_like(weight)
    after = np.ones_like(weight)
    scale = np.empty(len(weight))
    expected = np.zeros_like(change)
    for t in range(len(reach)):
        here = slice(start[t], start[t] + reach[t])
        now = weight[here]
        if t:
            now = now * (before[start[t - 1] : start[t - 1] + reach[t]] @ moves)
        total = now.sum(axis=1)
        scale[here] = total
        before[here] = now / total[:, None]
    for t in range(len(reach) - 2, -1, -1):
        later = slice(start[t + 1], start[t + 1] + reach[t + 1])
        here = slice(start[t], start[t] + reach[t + 1])
        seen = weight[later] * after[later] / scale[later][:, None]
        after[here] = seen @ moves.T
        expected += (before[here].T @ seen) * moves
    return before * after, expected, float(np.log(scale).sum() + peak.sum())


@dataclass
class Model:
    languages: list[str]
    grams: np.ndarray  # bucket x language
    lexicon: dict[str, int]
    entries: np.ndarray  # lexicon word x language; the last row is for words outside
    change: np.ndarray

    def evidence(self, words: list[str]) -> np.ndarray:
        found = np.zeros((len(words), len(self.languages)), np.float64)
        owner, bucket = ngram_buckets(words)
        for k in range(found.shape[1]):
            found[:, k] = np.bincount(owner, self.grams[bucket, k], len(words))
        outside = len(self.entries) - 1
        return found + self.entries[[self.lexicon.get(w, outside) for w in words]]


def _sequences(sample: list[tuple[str, str]], languages: list[str], seed: int) -> list[list[tuple[str, int]]]:
    """Code-switched sequences: runs of random length from all documents, shuffled and strung together."""
    rng = np.random.default_rng(seed)
    runs = []
    for text, lang in sample:
        words, label, at = words_of(text), languages.index(lang), 0
        while at < len(words):
            size = int(rng.integers(*RUN_WORDS))
            runs.append([(w, label) for w in words[at : at + size]])
            at += size
    order = rng.permutation(len(runs))
    return [
        [pair for i in order[k : k + RUNS_PER_SEQUENCE] for pair in runs[i]]
        for k in range(0, len(runs), RUNS_PER_SEQUENCE)
    ]


def train(sample: list[tuple[str, str]], seed: int = 5) -> Model:
    """Fit the field to (text, language) rows by AdaGrad on the exact gradient."""
    languages = sorted({lang for _, lang in sample})
    n = len(languages)
    sequences = sorted(_sequences(sample, languages, seed), key=len, reverse=True)
    counts = Counter(w for s in sequences for w, _ in s)
    types = sorted(counts)
    number = {w: i for i, w in enumerate(types)}
    lexicon = {w: i for i, w in enumerate(w for w in types if counts[w] >= LEXICON_LEAST)}
    entry = np.array([lexicon.get(w, len(lexicon)) for w in types], np.int64)
    model = Model(languages, np.zeros((BUCKETS, n)), lexicon, np.zeros((len(lexicon) + 1, n)), np.zeros((n, n)))
    if n < 2:
        return model
    lengths = np.array([len(s) for s in sequences])
    reach, start, place = layout(lengths)
    token = np.empty(len(place), np.int64)
    label = np.empty(len(place), np.int64)
    token[place] = [number[w] for s in sequences for w, _ in s]
    label[place] = [y for s in sequences for _, y in s]
    owner, bucket = ngram_buckets(types)
    truth = np.zeros((len(types), n))
    np.add.at(truth, (token, label), 1)
    changes = np.zeros((n, n))
    for s in sequences:
        labels = [y for _, y in s]
        np.add.at(changes, (labels[:-1], labels[1:]), 1)
    total = len(token)
    sums = [np.full_like(w, 1e-8) for w in (model.grams, model.entries, model.change)]
    for _ in range(EPOCHS):
        of_type = model.entries[entry].copy()
        for k in range(n):
            of_type[:, k] += np.bincount(owner, model.grams[bucket, k], len(types))
        chances, expected, _ = forward_backward(of_type[token], reach, start, model.change)
        error = truth - np.stack([np.bincount(token, chances[:, k], len(types)) for k in range(n)], axis=1)
        by_gram = np.stack([np.bincount(bucket, error[owner, k], BUCKETS) for k in range(n)], axis=1)
        by_entry = np.stack([np.bincount(entry, error[:, k], len(lexicon) + 1) for k in range(n)], axis=1)
        by_entry[-1] = 0
        slopes = (by_gram, by_entry, changes - expected)
        for weights, slope, squares in zip((model.grams, model.entries, model.change), slopes, sums):
            slope = slope / total - RIDGE * weights / len(types)
            squares += slope * slope
            weights += RATE * slope / np.sqrt(squares)
    return model


def sample_rows(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> list[tuple[str, str]]:
    """At most ``per_language`` learning rows of each language, chosen by a hash of the id, whatever their length."""
    usable = ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    known = docs.select("doc_id", "text", "lang").where(usable)
    chosen = first_by_hash(known, "lang", per_language)
    size = LEARNT_CHARS // LEARNT_SLICES
    starts = F.sequence(F.lit(0), F.lit(LEARNT_SLICES - 1))
    last = F.char_length("text") - size
    slices = F.transform(
        starts, lambda i: F.substring(F.col("text"), (i * last / (LEARNT_SLICES - 1)).cast("int") + 1, F.lit(size))
    )
    learnt = F.when(F.char_length("text") <= LEARNT_CHARS, F.col("text")).otherwise(F.array_join(slices, " "))
    return sorted((r.text, r.lang) for r in chosen.select(learnt.alias("text"), "lang").collect())


class _Remembered:
    """Evidence rows of the words met so far."""

    def __init__(self, model: Model):
        self.model = model
        self.numbers: dict[str, int] = {}
        self.rows = np.empty((0, len(model.languages)))

    def numbers_of(self, texts: list[list[str]]) -> list[np.ndarray]:
        if len(self.numbers) > REMEMBERED:
            self.numbers, self.rows = {}, self.rows[:0]
        numbers = self.numbers
        new = list({w for words in texts for w in words if w not in numbers})
        if new:
            self.rows = np.concatenate([self.rows, self.model.evidence(new)])
            numbers.update(zip(new, range(len(numbers), len(numbers) + len(new))))
        return [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)) for words in texts]


def _label(texts: list[list[str]], known: _Remembered) -> list[tuple[str, float, int, int]]:
    """(language, mean chance, words, changes of language) of each list of words."""
    model = known.model
    result: list[tuple[str, float, int, int]] = [(UNDETERMINED, 0.0, 0, 0)] * len(texts)
    if not model.languages:
        return [(UNDETERMINED, 0.0, len(words), 0) for words in texts]
    order = sorted((i for i in range(len(texts)) if texts[i]), key=lambda i: -len(texts[i]))
    if not order:
        return result
    tokens = known.numbers_of([texts[i] for i in order])
    lengths = np.array([len(t) for t in tokens])
    reach, start, place = layout(lengths)
    by_place = np.empty(len(place), np.int64)
    by_place[place] = np.concatenate(tokens)
    chances, _, _ = forward_backward(known.rows[by_place], reach, start, model.change)
    chances = chances[place] / chances[place].sum(axis=1, keepdims=True)
    first = np.cumsum(lengths) - lengths
    sums = np.add.reduceat(chances, first, axis=0)
    best = chances.argmax(axis=1)
    turned = np.concatenate([[False], best[1:] != best[:-1]])
    turned[first] = False
    turns = np.add.reduceat(turned.astype(np.int64), first)
    for k, i in enumerate(order):
        top = int(sums[k].argmax())
        share = min(1.0, float(sums[k, top] / lengths[k]))
        result[i] = (model.languages[top], share, int(lengths[k]), int(turns[k]))
    return result


def identify(spark: SparkSession, docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, n_words, n_switches) of every row.

    A text that is null or has no letters is ``und`` with score 0; so is every text if no row can be learned from. One
    known language is predicted for all. Null ids count as not held out, repeated rows are predicted alike, other
    columns are not read, and an empty table gives none. Ties go to the first language by name. Whole texts are read.
    """
    model = spark.sparkContext.broadcast(train(sample_rows(docs, per_language)))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Remembered(model.value)
        for batch in batches:
            labels: list[tuple[str, float, int, int]] = []
            waiting: list[list[str]] = []
            held = 0
            for text in batch.column(1):
                waiting.append(words_of(text.as_py() or ""))
                held += len(waiting[-1])
                if held >= PASS_WORDS:
                    labels += _label(waiting, known)
                    waiting, held = [], 0
            labels += _label(waiting, known)
            lang, share, words, turns = zip(*labels) if labels else ((), (), (), ())
            columns = [pa.array(lang, pa.string()), pa.array(share, pa.float64())]
            columns += [pa.array(words, pa.int64()), pa.array(turns, pa.int64())]
            names = ["doc_id", "lang_pred", "score", "n_words", "n_switches"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, lang_pred string, score double, n_words long, n_switches long"
    found = rows.mapInArrow(predict, schema)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *found.columns[1:])
