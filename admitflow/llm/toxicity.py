"""Toxicity by the nearest labelled examples.

A document is compared with labelled examples by the exact cosine of TF-IDF vectors over all words and word stems
(leading characters). Document frequencies are counted over all documents; a term weighs the more, the more the learning
rows tie it to one label, but none is left out. What no example has counts in the document's length alone, its
frequency taken from hashed classes.
The examples lie in an inverted index of blocks: for each term and block the largest weight bounds what any example of
the block can reach, so blocks that cannot enter the nearest few are never scored. The nearest examples vote, nearer
ones more; the vote is turned into a probability by the vote that the learning rows get when each is left out.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from admitflow.llm.common import bounded_runs, first_by_hash, held_out
from admitflow.llm.wordhash import BASE, mix

# Bound of what is learnt: examples of each label, a parameter of fit().
EXAMPLES_PER_LABEL = 1000
# Classes that the frequencies of terms without example are counted in.
CLASSES = 1 << 18
STEM_LENGTHS = (5,)
NEAREST = 15
BLOCK = 64
# At most so many terms lie in the matrix, and of these only those that one example in so many has.
DENSE_TERMS = 1024
DENSE_PART = 64
# Documents whose terms and matrix parts are computed together.
TOGETHER = 64
# Characters of texts whose words are cut together; a longer text is a run of its own.
RUN_CHARACTERS = 1 << 19
# Words whose terms a task remembers: 2 to this power.
_TABLE_POWER = 20
# Hashes of terms without example are remembered up to this, so that those of TOGETHER texts fit a word.
_UNKNOWN = 1 << 55
# Similarity that a vote for "not toxic" without any example counts as; keeps weak evidence near zero.
PRIOR_VOTE = 0.2
THRESHOLD = 0.3

# Words are runs of letters and of numerals that are no digits, to Python and to Spark; both hash a term the same way.
_WORD = re.compile(r"[^\W\d_]+")
_SPARK_WORD = r"([\p{L}\p{Nl}\p{No}]+)"
_SEED = 42


def stems(word: str) -> list[str]:
    """The word itself (marked by a final full stop) and its leading characters."""
    return [word + ".", *(word[:n] for n in STEM_LENGTHS if len(word) > n)]


def _hash(term: str) -> int:
    return xxhash.xxh64_intdigest(term, _SEED)


def _hashes(text: Column) -> Column:
    """The distinct hashes of a text's terms, as ``_hash`` gives them (signed)."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_SPARK_WORD), F.lit(1)))
    found = F.transform(words, lambda w: F.xxhash64(F.concat(w, F.lit("."))))
    for n in map(F.lit, STEM_LENGTHS):
        longer = F.filter(words, lambda w: F.length(w) > n)  # noqa: B023
        found = F.array_union(found, F.transform(longer, lambda w: F.xxhash64(F.left(w, n))))  # noqa: B023
    return found


@cache
def _alphabet() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point whether words hold it, and a number that stands for it in hashes."""
    every = "".join(map(chr, range(sys.maxunicode + 1)))
    letter = np.zeros(len(every), bool)
    for run in _WORD.finditer(every):
        letter[run.start() : run.end()] = True
    return letter, mix(np.arange(1, len(every) + 1, dtype=np.uint64))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[0] = 1
    return np.cumprod(powers)


class Terms:
    """Numbers of the terms of words, remembered for as many words as a table of fixed size holds.

    Terms that no example has get the number of their class, after all others; what is remembered of them is the hash that
    the class is taken from. Within the table words are told apart by 64 bits, taken from sums over all characters of a
    run of texts; a word is only cut out if it is not there yet.
    """

    def __init__(self, numbers: dict[str, int]):
        self._numbers = numbers
        self._words = np.zeros(1 << _TABLE_POWER, np.uint64)
        self._terms = np.empty((1 << _TABLE_POWER, 1 + len(STEM_LENGTHS)), np.int64)
        self._rising = self._falling = np.empty(0, np.uint64)

    def _of_word(self, word: str) -> list[int]:
        get, classes = self._numbers.get, len(self._numbers)
        found = []
        for term in stems(word):
            number = get(term)
            found.append(classes + _hash(term) % _UNKNOWN if number is None else number)
        return found + [-1] * (1 + len(STEM_LENGTHS) - len(found))

    def _of_words(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Where the words of a text in lower case start, and the terms of each (-1: none)."""
        letter, value = _alphabet()
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(self._rising) < len(codes):
            size = 1 << len(codes).bit_length()
            self._rising, self._falling = _powers(int(BASE), size), _powers(pow(int(BASE), -1, 1 << 64), size)
        edges = np.flatnonzero(np.diff(letter[codes], prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(value[codes] * self._rising[: len(codes)], out=sums[1:])
        words = mix((sums[ends] - sums[starts]) * self._falling[starts]) | np.uint64(1)
        places = words >> np.uint64(64 - _TABLE_POWER)
        terms = self._terms[places]
        new = np.flatnonzero(self._words[places] != words)
        if len(new):
            _, first, which = np.unique(words[new], return_index=True, return_inverse=True)
            cut = zip(starts[new[first]].tolist(), ends[new[first]].tolist())
            found = np.array([self._of_word(text[a:b]) for a, b in cut], np.int64)
            terms[new] = found[which]
            # Of words with one place the last stays.
            self._words[places[new]] = words[new]
            self._terms[places[new]] = terms[new]
        return starts, terms

    def _placed(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of every term of every word the place of its text, and the term."""
        lower = [text.lower() for text in texts]
        borders = np.cumsum([len(text) + 1 for text in lower])
        starts, terms = self._of_words("\n".join(lower))
        places, some = np.searchsorted(borders, starts, "right"), terms >= 0
        return np.repeat(places, some.sum(axis=1)), terms[some]

    def _folded(self, terms: np.ndarray) -> np.ndarray:
        classes = len(self._numbers)
        return np.where(terms < classes, terms, classes + ((terms - classes) & (CLASSES - 1)))

    def of(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The distinct terms of each text in rising order, and how often it has each."""
        found, width = [], len(self._numbers) + CLASSES
        for run in bounded_runs(texts, len, RUN_CHARACTERS):
            places, terms = self._placed(run)
            keys, times = np.unique(places * width + self._folded(terms), return_counts=True)
            ends = np.searchsorted(keys, np.arange(len(run) + 1) * width)
            found += [(keys[a:b] - k * width, times[a:b]) for k, (a, b) in enumerate(zip(ends, ends[1:]))]
        return found

    def add_to(self, frequency: np.ndarray, texts: list[str]) -> None:
        """Count each term of each text once, classes once for each of their terms."""
        for run in bounded_runs(texts, len, RUN_CHARACTERS):
            places, terms = self._placed(run)
            keys = np.sort(places * (2 * _UNKNOWN) + terms)
            keys = keys[np.diff(keys, prepend=-1) != 0]
            np.add.at(frequency, self._folded(keys & (2 * _UNKNOWN - 1)), 1)


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers from each start up to its end, one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


@dataclass
class Index:
    """Postings by term and block of examples, and the largest weight of each term in each block.

    The terms with the longest lists, which most blocks hold, lie as rows of a matrix instead, with the weight of each
    example: their part of the cosines comes from one product for many documents.
    """

    first: np.ndarray  # of each term: its first run, a run being its postings in one block
    block: np.ndarray  # of each run
    largest: np.ndarray
    start: np.ndarray  # of each run: its first posting
    row: np.ndarray  # of each posting
    weight: np.ndarray
    toxic: np.ndarray
    ids: np.ndarray
    dense: np.ndarray  # longest terms x examples
    place: np.ndarray  # of each term: its row there, or -1

    @classmethod
    def build(cls, vectors: np.ndarray, toxic: np.ndarray, ids: np.ndarray) -> Index:
        rows, terms = np.nonzero(vectors)
        return cls.post(rows, terms, vectors[rows, terms], vectors.shape[1], toxic, ids)

    @classmethod
    def post(cls, rows, terms, weights, n_terms: int, toxic: np.ndarray, ids: np.ndarray) -> Index:
        # Examples with the same strongest term lie together, so that a block's bounds are tight.
        strongest = np.full(len(ids), -1)
        rising = np.argsort(weights, kind="stable")
        strongest[rows[rising]] = terms[rising]
        order = np.lexsort((ids, strongest))
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        rows = place[rows]
        order_of_postings = np.lexsort((rows, terms))
        rows, terms, weights = rows[order_of_postings], terms[order_of_postings], weights[order_of_postings]
        lengths = np.bincount(terms, minlength=n_terms)
        longest = np.argsort(-lengths, kind="stable")[:DENSE_TERMS]
        longest = longest[lengths[longest] * DENSE_PART >= max(len(ids), 1)]
        where = np.full(n_terms, -1)
        where[longest] = np.arange(len(longest))
        dense, own = np.zeros((len(longest), len(ids))), where[terms] >= 0
        dense[where[terms[own]], rows[own]] = weights[own]
        rows, terms, weights = rows[~own], terms[~own], weights[~own]
        blocks = rows // BLOCK
        opens = np.ones(len(rows), bool)
        opens[1:] = (np.diff(terms) != 0) | (np.diff(blocks) != 0)
        start = np.flatnonzero(opens)
        largest = np.maximum.reduceat(weights, start) if len(start) else np.empty(0)
        first = np.searchsorted(terms[start], np.arange(n_terms + 1))
        ends = np.append(start, len(rows))
        return cls(
            first, blocks[start], largest, ends, rows.astype(np.int32), weights, toxic[order], ids[order], dense, where
        )

    def dense_parts(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Of each vector the part of its cosine with every example that the longest terms give."""
        values = np.zeros((len(vectors), len(self.dense)))
        for own, (terms, weights) in zip(values, vectors):
            places = self.place[terms]
            own[places[places >= 0]] = weights[places >= 0]
        return values @ self.dense

    def nearest(
        self, terms: np.ndarray, values: np.ndarray, k: int, skip: int = -1, part: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Rows and cosines of the k nearest examples that share a term; ties go to the smaller id."""
        part = self.dense_parts([(terms, values)])[0] if part is None else part
        rare = self.place[terms] < 0
        terms, values = terms[rare], values[rare]
        sizes = self.first[terms + 1] - self.first[terms]
        runs, value = _ranges(self.first[terms], self.first[terms + 1]), np.repeat(values, sizes)
        blocks = self.block[runs]
        bounds = np.bincount(blocks, self.largest[runs] * value, -(-len(self.ids) // BLOCK))
        # Weights are not negative: the k-th largest part is a bar that the k nearest reach, whatever is added.
        bar = 0.0
        if len(part) > k + 1:
            bar = np.partition(part, -k - 1)[-k - 1] - 1e-9
            bounds = bounds + np.maximum.reduceat(part, np.arange(0, len(part), BLOCK))
        chosen = bounds[blocks] >= bar
        opens, ends = self.start[runs[chosen]], self.start[runs[chosen] + 1]
        at = _ranges(opens, ends)
        cosines = part + np.bincount(
            self.row[at], self.weight[at] * np.repeat(value[chosen], ends - opens), len(self.ids)
        )
        rows = np.flatnonzero((cosines >= bar) & (cosines > 0))
        if len(rows) > 4 * k:
            rows = rows[cosines[rows] >= np.partition(cosines[rows], -k - 1)[-k - 1] - 1e-9]
        rows = rows[rows != skip]
        rows = rows[np.lexsort((self.ids[rows], -cosines[rows].round(12)))[:k]]
        return rows, cosines[rows]


def _arrays(counts: Counter) -> tuple[np.ndarray, np.ndarray]:
    return np.fromiter(counts.keys(), np.int32, len(counts)), np.fromiter(counts.values(), np.int32, len(counts))


@dataclass
class Model:
    numbers: dict[str, int]
    weight: np.ndarray  # of each term, then of each class
    index: Index
    votes: np.ndarray  # calibration: votes in rising order
    chances: np.ndarray  # and the chance of the label at each

    def vector(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Terms that examples have and their parts of the unit vector of all terms."""
        values = (1 + np.log(times)) * self.weight[terms]
        known = terms < len(self.numbers)
        return terms[known], values[known] / max(np.sqrt((values * values).sum()), 1e-300)

    def vote(self, rows: np.ndarray, cosines: np.ndarray) -> float:
        weights = cosines / (1.1 - np.minimum(cosines, 1.0))
        return float((weights * self.index.toxic[rows]).sum() / (weights.sum() + PRIOR_VOTE))

    def scores(self, counts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[float, list[int]]]:
        """Score and voting examples of each document, given by its terms and their times."""
        vectors = [self.vector(*c) for c in counts]
        found = []
        for vector, part in zip(vectors, self.index.dense_parts(vectors)):
            rows, cosines = self.index.nearest(*vector, NEAREST, part=part)
            chance = np.interp(self.vote(rows, cosines), self.votes, self.chances)
            found.append((float(chance), self.index.ids[rows].tolist()))
        return found


def _learning_rows(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """(doc_id, text, toxic): at most ``per_label`` documents of each label, chosen by a hash of the id."""
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    filled = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("text") != "")
    # Only ids are joined and ranked; the texts of those chosen are fetched last.
    chosen = first_by_hash(known.join(filled.select("doc_id"), "doc_id", "left_semi"), "toxic", per_label)
    return filled.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def _evidence(terms: list[np.ndarray], toxic: np.ndarray, n_terms: int) -> np.ndarray:
    """How much each term tells the labels apart in the learning rows: log-likelihood against chance."""
    seen = np.zeros((2, n_terms))
    for found, label in zip(terms, toxic.astype(int)):
        seen[label, found] += 1
    both = np.maximum(seen.sum(axis=0), 1)
    evidence = np.zeros(n_terms)
    for label in (0, 1):
        share = max((toxic == label).mean(), 1e-9) if len(toxic) else 1.0
        some = seen[label] > 0
        evidence[some] += seen[label, some] * np.log(seen[label, some] / both[some] / share)
    return np.maximum(evidence, 0)


def _together(texts: pa.Array) -> Iterator[list[str]]:
    for start in range(0, len(texts), TOGETHER):
        yield [text or "" for text in texts.slice(start, TOGETHER).to_pylist()]


def _document_frequencies(docs: DataFrame, numbers: dict[str, int]) -> tuple[int, np.ndarray]:
    """Number of documents, and of those with each term or class, over all documents.

    A task adds its documents up in one array, so it hands on a row per term or class at most; these are summed on Spark,
    and as many come back at most.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(numbers)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(shipped.value)
        found = np.zeros(len(shipped.value) + CLASSES, np.int64)
        for batch in batches:
            for texts in _together(batch.column(0)):
                terms.add_to(found, texts)
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], ["term", "n"])

    parts = docs.select(F.col("text").cast("string")).mapInArrow(counted, "term long, n long")
    summed = parts.groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    frequency = np.zeros(len(numbers) + CLASSES)
    frequency[summed.column("term").to_numpy()] = summed.column("n").to_numpy()
    return docs.count(), frequency


def _calibrate(votes: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression of the label on the vote: pool neighbours until chances rise with the vote."""
    distinct, place = np.unique(votes.round(9), return_inverse=True)
    weight = np.bincount(place, weights)
    label = np.bincount(place, weights * toxic)
    pools: list[list[float]] = []  # sums of votes, labels and weights
    for v, y, w in zip(distinct, label, weight):
        pools.append([v * w, y, w])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    xs = np.array([p[0] / p[2] for p in pools])
    ys = np.array([p[1] / p[2] for p in pools])
    return xs, ys


def fit(
    spark: SparkSession,
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = EXAMPLES_PER_LABEL,
) -> Model:
    """Learn from at most ``per_label`` labelled documents of each label that are not held out."""
    numbers: dict[str, int] = {}
    counts, found = [], []
    # One example at a time: its text is gone when the next one comes.
    for row in _learning_rows(docs, labels, per_label).toLocalIterator():
        times: Counter = Counter()
        for word, n in Counter(_WORD.findall(row.text.lower())).items():
            for term in stems(word):
                times[numbers.setdefault(term, len(numbers))] += n
        counts.append(_arrays(times))
        found.append((row.doc_id, row.toxic))
    order = sorted(range(len(found)), key=found.__getitem__)
    counts, found = [counts[i] for i in order], [found[i] for i in order]
    toxic, doc_ids = np.array([y for _, y in found], float), np.array([i for i, _ in found], np.int64)
    total, frequency = _document_frequencies(docs, numbers)
    weight = np.log((1 + total) / (1 + frequency)) + 1
    weight[: len(numbers)] *= 1 + _evidence([c[0] for c in counts], toxic, len(numbers))
    model = Model(numbers, weight, None, np.zeros(1), np.zeros(1))
    kept = [i for i, c in enumerate(counts) if len(c[0])]
    vectors = [model.vector(*counts[i]) for i in kept]
    at = np.repeat(np.arange(len(kept)), [len(v[0]) for v in vectors])
    held = [np.concatenate([np.empty(0, t), *(v[k] for v in vectors)]) for k, t in ((0, np.int64), (1, float))]
    model.index = Index.post(at, *held, len(numbers), toxic[kept], doc_ids[kept])
    if len(toxic):
        place_of = {doc_id: k for k, doc_id in enumerate(model.index.ids.tolist())}
        votes = np.zeros(len(toxic))
        for i, vector in zip(kept, vectors):
            near = model.index.nearest(*vector, NEAREST, skip=place_of[int(doc_ids[i])])
            votes[i] = model.vote(*near)
        # The examples hold the labels in equal parts at most; weights give back how frequent they are.
        share = _label_counts(labels)
        sample = np.array([max((toxic == y).sum(), 1) for y in (0, 1)])
        weights = np.where(toxic == 1, share[1] / sample[1], share[0] / sample[0])
        model.votes, model.chances = _calibrate(votes, toxic, weights)
    return model


def _label_counts(labels: DataFrame) -> np.ndarray:
    found = labels.where(~held_out(F.col("doc_id"))).groupBy(F.col("toxic").cast("int").alias("toxic")).count()
    counts = np.ones(2)
    for row in found.where(F.col("toxic").isin(0, 1)).collect():
        counts[row.toxic] = row["count"]
    return counts


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame, **bounds: int) -> DataFrame:
    """Score, prediction and evidence of every row of ``docs``; its other columns come along.

    Adds held_out, score, predicted (1 from 0.3 on) and neighbours, the ids of the examples that voted. Null, empty and
    very long texts are scored like others, whole; what shares no term with an example gets the score of no vote. Null
    ids count as not held out; repeated rows are scored alike. Without labelled examples every score is 0. Columns of
    ``docs`` with the added names are replaced. Labels that are null or neither 0 nor 1 teach nothing; of contradicting
    labels of one document the larger counts.
    """
    model = spark.sparkContext.broadcast(fit(spark, docs, labels, **bounds))
    added = ("held_out", "score", "predicted", "neighbours")
    kept = docs.drop(*added)
    at = kept.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(model.value.numbers)
        for batch in batches:
            scores, near = [], []
            for texts in _together(batch.column(at)):
                for value, ids in model.value.scores(terms.of(texts)):
                    scores.append(value)
                    near.append(ids)
            columns = [*batch.columns, pa.array(scores, pa.float64()), pa.array(near, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "score", "neighbours"])

    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("score", T.DoubleType()),
            T.StructField("neighbours", T.ArrayType(T.LongType())),
        ]
    )
    found = kept.mapInArrow(scored, schema)
    return found.withColumns(
        {
            "held_out": held_out(F.col("doc_id")),
            "predicted": (F.col("score") >= THRESHOLD).cast("int"),
        }
    )
