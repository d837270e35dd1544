"""Passages that documents with smaller ids hold already, found by suffix automata.

A window is a run of 50 words. Every window is cut down to an anchor, the smallest hash among its runs of 12 words; equal
windows have equal anchors at equal places. Only anchors that several documents share can lie in repeated windows.
The windows around one anchor in one document are a segment; equal segments fall together at once. What is left of an
anchor's segments is a reference shard: its documents are streamed by rising id through a suffix automaton of the words
of those before, and its matching statistics show which windows the automaton holds. Before that, windows whose hash
only one document of the shard has are left out, so an automaton only holds what may repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitflow.llm.common import stored
from admitflow.llm.wordhash import BASE, mix, run_hashes, word_hashes

WINDOW = 50
ANCHOR = 12
_SPREAD = WINDOW - ANCHOR + 1  # runs of an anchor's size within a window
PASS_BYTES = 1 << 21
_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def segments(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, segment hash, first window, number of windows) of the segments of one document's word hashes."""
    windows = len(words) - WINDOW + 1
    if windows <= 0:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int64))  # type: ignore[return-value]
    runs = run_hashes(words, ANCHOR)
    at = np.lib.stride_tricks.sliding_window_view(runs, _SPREAD).argmin(axis=1) + np.arange(windows)
    first = np.flatnonzero(np.diff(at, prepend=-1))
    count = np.diff(first, append=windows)
    # Hash of all words of a segment from running sums: words weighted by powers, shifted back to its start.
    powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(words), BASE, np.uint64))])
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers[:-1])])
    back = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(len(words), _INVERSE, np.uint64))])
    whole = (sums[first + count + WINDOW - 1] - sums[first]) * back[first]
    whole = mix(whole ^ (count.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
    return runs[at[first]].view(np.int64), whole.view(np.int64), first, count


def _passes(batch: pa.RecordBatch, column: int) -> Iterator[tuple[list[int], list[bytes]]]:
    rows, texts, held = [], [], 0
    for row, text in enumerate(batch.column(column)):
        rows.append(row)
        texts.append((text.as_py() or "").encode())
        held += len(texts[-1])
        if held >= PASS_BYTES:
            yield rows, texts
            rows, texts, held = [], [], 0
    if rows:
        yield rows, texts


def _find_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tid, text) to one row per segment."""
    names = ["doc_id", "tid", "anchor", "segment", "first", "n"]
    for batch in batches:
        for rows, texts in _passes(batch, 2):
            words, counts = word_hashes(texts)
            ends = np.cumsum(counts)
            found = [segments(words[e - n : e]) for e, n in zip(ends, counts)]
            sizes = [len(f[0]) for f in found]
            owner = np.repeat(np.array(rows), sizes)
            columns = [batch.column(k).take(pa.array(owner)) for k in (0, 1)]
            columns += [pa.array(np.concatenate([f[k] for f in found])) for k in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names)


def _cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, tid, text, segments) to one row per segment with its words."""
    for batch in batches:
        rows = []
        for doc_id, tid, text, wanted in zip(*(batch.column(k).to_pylist() for k in range(4))):
            words = text.encode().split()
            for s in wanted:
                cut = b" ".join(words[s["first"] : s["first"] + s["n"] + WINDOW - 1])
                rows.append((doc_id, tid, s["anchor"], s["first"], cut))
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.binary()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "tid", "anchor", "first", "words"])


class SuffixAutomaton:
    """All runs of words of the texts added so far."""

    def __init__(self):
        self._next: list[dict[bytes, int]] = [{}]
        self._link = [-1]
        self._length = [0]

    def _state(self, length: int, follow: dict[bytes, int], link: int) -> int:
        self._next.append(follow)
        self._length.append(length)
        self._link.append(link)
        return len(self._next) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        copy = self._state(self._length[state] + 1, dict(self._next[target]), self._link[target])
        self._link[target] = copy
        while state >= 0 and self._next[state].get(word) == target:
            self._next[state][word] = copy
            state = self._link[state]
        return copy

    def add(self, words: list[bytes]) -> None:
        last = 0
        for word in words:
            held = self._next[last].get(word)
            if held is not None:  # an earlier text has this run
                exact = self._length[held] == self._length[last] + 1
                last = held if exact else self._split(last, word, held)
                continue
            new = self._state(self._length[last] + 1, {}, 0)
            state = last
            while state >= 0 and word not in self._next[state]:
                self._next[state][word] = new
                state = self._link[state]
            if state >= 0:
                held = self._next[state][word]
                exact = self._length[held] == self._length[state] + 1
                self._link[new] = held if exact else self._split(state, word, held)
            last = new

    def statistics(self, words: list[bytes]) -> list[int]:
        """For each word the length of the longest run ending there that some text has."""
        state, length, found = 0, 0, []
        for word in words:
            while state and word not in self._next[state]:
                state = self._link[state]
                length = self._length[state]
            if word in self._next[state]:
                state = self._next[state][word]
                length += 1
            found.append(length)
        return found


def repeated_windows(shard: list[tuple[int, int, int, bytes]]) -> list[tuple[int, int, int]]:
    """(doc_id, tid, window) of the windows of a shard that a smaller doc_id of it has.

    ``shard`` has (doc_id, tid, first window, words) by rising doc_id.
    """
    hashes, counts = word_hashes([s[3] for s in shard])
    ends = np.cumsum(counts)
    runs = [run_hashes(hashes[e - n : e], WINDOW) for e, n in zip(ends, counts)]
    owner = np.repeat(np.array([s[0] for s in shard]), [len(r) for r in runs])
    _, place = np.unique(np.concatenate(runs), return_inverse=True)
    least, most = np.full(place.max() + 1, np.iinfo(np.int64).max), np.full(place.max() + 1, np.iinfo(np.int64).min)
    np.minimum.at(least, place, owner)
    np.maximum.at(most, place, owner)
    several = np.split((least < most)[place], np.cumsum([len(r) for r in runs])[:-1])
    automaton, found, waiting, doc = SuffixAutomaton(), [], [], None
    for (doc_id, tid, first, text), flags in zip(shard, several):
        if doc_id != doc:
            for words in waiting:
                automaton.add(words)
            waiting, doc = [], doc_id
        if not flags.any():
            continue
        words = text.split()
        edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            part = words[start : end + WINDOW - 1]
            lengths = automaton.statistics(part)
            hits = [start + k for k in range(end - start) if lengths[k + WINDOW - 1] >= WINDOW]
            found += [(doc_id, tid, first + k) for k in hits]
            if len(hits) < end - start:
                waiting.append(part)
    return found


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (anchor, doc_id, tid, first, words) to the repeated windows; an anchor's rows are a shard."""

    def result(shard: list) -> pa.RecordBatch:
        rows = repeated_windows(shard) if len(shard) > 1 else []
        columns = list(zip(*rows)) if rows else [[]] * 3
        columns.append([1] * len(rows))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "tid", "first", "n"])

    anchor, shard = None, []
    for batch in batches:
        for key, *row in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if key != anchor:
                if len(shard) > 1:
                    yield result(shard)
                anchor, shard = key, []
            shard.append(tuple(row))
    if len(shard) > 1:
        yield result(shard)


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, covered windows) to what is kept."""
    for batch in batches:
        total, removed, texts = [], [], []
        for text, covered in zip(batch.column(1), batch.column(2)):
            words = (text.as_py() or "").encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            for s in covered.as_py() or []:
                gone[s["first"]] += 1
                gone[s["first"] + s["n"] + WINDOW - 1] -= 1
            keep = np.cumsum(gone)[:-1] == 0
            texts.append(b" ".join([w for w, k in zip(words, keep.tolist()) if k] if covered.is_valid else words))
            total.append(len(words))
            removed.append(int(len(words) - keep.sum()))
        digests = [hashlib.sha256(t).hexdigest() for t in texts]
        kept = pa.array([t.decode() for t in texts], pa.string())
        columns = [batch.column(0), pa.array(total), pa.array(removed), pa.array(digests), kept]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def remove_repeats(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) of every row; kept words are joined by one blank.

    A null or empty text has no words. A row without an id is kept whole, and nothing is removed for its sake. Of rows
    that share an id none removes from another; repeated rows get equal results. Texts are read whole, other columns are
    not read, and an empty table gives none.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tid"), text.alias("text"))
    known = rows.where(F.col("doc_id").isNotNull())
    kinds = "doc_id long, tid long, anchor long, segment long, first long, n long"
    every = stored(known.mapInArrow(_find_segments, kinds), "segments")
    shared = every.groupBy("anchor").agg(
        F.min("doc_id").alias("least"),
        F.max("doc_id").alias("most"),
        (F.min("segment") < F.max("segment")).alias("differ"),
    )
    some = stored(every.join(shared.where("least < most").select("anchor", "differ"), "anchor"), "segments")
    first = some.groupBy("anchor", "segment").agg(F.min("doc_id").alias("holder"))
    held = stored(some.join(first, ["anchor", "segment"]), "segments")
    whole = held.where("doc_id > holder").select("doc_id", "tid", "first", "n")
    open_segments = held.where("doc_id = holder and differ").dropDuplicates(["anchor", "doc_id", "tid", "first"])
    wanted = open_segments.groupBy("doc_id", "tid").agg(F.collect_list(F.struct("anchor", "first", "n")).alias("wanted"))
    texts = known.dropDuplicates(["doc_id", "tid"]).join(wanted, ["doc_id", "tid"])
    cut = texts.select("doc_id", "tid", "text", "wanted").mapInArrow(
        _cut_segments, "doc_id long, tid long, anchor long, first long, words binary"
    )
    shards = (
        cut.select("anchor", "doc_id", "tid", "first", "words")
        .repartition("anchor")
        .sortWithinPartitions("anchor", "doc_id", "tid", "first")
    )
    streamed = shards.mapInArrow(_stream, "doc_id long, tid long, first long, n long")
    covered = whole.union(streamed).groupBy("doc_id", "tid").agg(F.collect_list(F.struct("first", "n")).alias("covered"))
    covered = covered.select(F.col("doc_id").alias("d"), F.col("tid").alias("t"), "covered")
    final = rows.join(covered, (F.col("doc_id") == F.col("d")) & (F.col("tid") == F.col("t")), "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    return final.select("doc_id", "text", "covered").mapInArrow(_finish, schema)
