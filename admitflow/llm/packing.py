"""Pack token sequences into fixed windows by best-fit decreasing.

Every document is a run of ids that ends with id 0. Runs longer than a window are first cut into full windows. What is
left over of each is placed, longest first, into the open window with the least room that still holds it; a segment tree
over remaining capacities finds that window. Each task packs the documents it has read: nothing is shuffled, sequence
ids carry the task's number, and a lost task is simply packed again.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 1024
END_ID = 0
# Left-over runs that one best-fit pass sorts together. Bounds a task's memory; each pass leaves one or two open windows.
PASS_RUNS = 65_536

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies spell each byte as one printable character; this maps the character to the byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {chr(b): b for b in printable}
    others = [b for b in range(256) if b not in set(printable)]
    symbols.update({chr(256 + i): b for i, b in enumerate(others)})
    return symbols


class Encoder:
    """Ids of a text as little-endian 32-bit bytes, with the vocabulary file of the ``tokenizers`` format.

    Byte-pair merges follow the order of the ids, so the vocabulary alone drives a faster encoder of the same ids.
    """

    def __init__(self, vocabulary: str):
        import public_tokenizers
        import tiktoken

        with open(vocabulary, encoding="utf-8") as file:
            content = json.load(file)
        special = {t["content"]: t["id"] for t in content.get("added_tokens", []) if t.get("special")}
        symbols = _byte_symbols()
        ranks = {
            bytes(symbols[c] for c in token): number
            for token, number in content["model"]["vocab"].items()
            if token not in special
        }
        self._encoding = tiktoken.Encoding(
            "file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
        )

    def encode(self, text: str) -> bytes:
        return self._encoding.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()


class OpenWindows:
    """Windows with room left, found by the least room that is enough.

    Leaf ``c`` of a binary segment tree counts the windows with ``c`` places left; an inner node counts its leaves.
    """

    def __init__(self, capacity: int):
        self._leaves = 1 << capacity.bit_length()
        self._tree = [0] * (2 * self._leaves)
        self._windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, room: int, window: int) -> None:
        self._windows[room].append(window)
        self._count(room, 1)

    def _count(self, room: int, change: int) -> None:
        node = self._leaves + room
        while node:
            self._tree[node] += change
            node >>= 1

    def take_tightest(self, length: int) -> tuple[int, int] | None:
        """Remove and return (room, window) with the least room of at least ``length``."""
        tree, node = self._tree, self._leaves + length
        while not tree[node]:
            # Up until a right sibling exists, then look there.
            while node & 1:
                node >>= 1
            if node <= 1:
                return None
            node += 1
        while node < self._leaves:
            node <<= 1
            if not tree[node]:
                node += 1
        room = node - self._leaves
        self._count(room, -1)
        return room, self._windows[room].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[tuple[int, int]]:
    """(window, offset) of each run. Runs of one length keep their order."""
    places: list[tuple[int, int]] = [(0, 0)] * len(lengths)
    opened, windows = OpenWindows(capacity), 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        length = lengths[i]
        found = opened.take_tightest(length)
        if found is None:
            room, window = capacity, windows
            windows += 1
        else:
            room, window = found
        places[i] = (window, capacity - room)
        if room > length:
            opened.add(room - length, window)
    return places


def _pack_task(vocabulary: str, window: int, pass_runs: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        end, width = END_ID.to_bytes(4, "little"), 4 * window
        base, used = TaskContext.get().partitionId() << 40, 0
        pieces: list[tuple] = []
        rest: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal used
            places = best_fit_decreasing([r[2] for r in rest], window)
            pieces.extend((*r, base + used + w, offset) for r, (w, offset) in zip(rest, places))
            used += 1 + max((w for w, _ in places), default=-1)
            columns = zip(*pieces) if pieces else [[]] * 7
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)
            pieces.clear()
            rest.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(encoder.encode(text.as_py() or "") + end)
                total = len(ids) // 4
                full = total // window
                for k in range(full):
                    crc = zlib.crc32(ids[k * width : (k + 1) * width])
                    pieces.append((doc_id, k * window, window, crc, total, base + used, 0))
                    used += 1
                if total % window:
                    crc = zlib.crc32(ids[full * width :])
                    rest.append((doc_id, full * window, total % window, crc, total))
                if len(rest) >= pass_runs or len(pieces) >= 4 * pass_runs:
                    yield flush()
        if pieces or rest:
            yield flush()

    return pack


def pack(
    docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, pass_runs: int = PASS_RUNS
) -> DataFrame:
    """Pieces of all documents with their place in sequences of at most ``window`` ids.

    A null or empty text is id 0 alone. Repeated rows are packed once each; ids may be null and are passed on. An empty
    table gives no pieces. Other columns of ``docs`` are not read. Runs of one length go in the order they were read.
    Strings of special tokens in a text become their ids, as the vocabulary file says.
    """
    task = _pack_task(vocabulary or default_vocabulary(), window, pass_runs)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task, SCHEMA)
