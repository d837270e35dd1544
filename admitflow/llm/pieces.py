"""SentencePiece encoding that knows which bytes of the text each piece stands for, and decoding.

A text is first normalised: at each place the longest key of the model's compiled character map is replaced, what no key
matches stays, and white space is treated as the model says. On the way every normalised byte keeps the place in the
original it comes from. The merges run over the normalised text, with the model's own pieces and no further
normalisation; as pieces follow each other without a gap, their lengths give the normalised places, and the kept places
project these to spans of the original bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admitflow.llm.common import bounded_runs

# Fixed values of the model format: field numbers and kinds of pieces.
_PIECES, _TRAINER, _NORMALIZER, _SELF_TEST = 1, 2, 3, 4
_PIECE_TEXT, _PIECE_KIND = 1, 3
_NORMAL, _UNKNOWN, _CONTROL, _USER_DEFINED, _BYTE = 1, 2, 3, 4, 6
_WHITE_AS_SUFFIX = 24
_CHARACTER_MAP, _DUMMY_PREFIX, _DROP_EXTRA_WHITE, _ESCAPE_WHITE = 2, 3, 4, 5
_SPACE, _ESCAPED_SPACE = b" ", "▁".encode()

# Characters that are encoded together; a longer text goes alone.
RUN_CHARS = 1 << 21


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _number(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(number, value, bytes of the whole field) of a protocol buffer message."""
    at = 0
    while at < len(data):
        start = at
        key, at = _number(data, at)
        if key & 7 == 0:
            value, at = _number(data, at)
        else:
            size, at = _number(data, at) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], at)
            value, at = data[at : at + size], at + size
        yield key >> 3, value, data[start:at]


class CharacterMap:
    """A model's compiled map: a double-array trie of UTF-8 keys, and the replacements its leaves point to."""

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self._units = np.frombuffer(compiled[4 : 4 + size], "<u4").tolist()
        self._targets = compiled[4 + size :]
        self._root = self._children(0, self._units[0])
        first = bytes(b for b in range(256) if self._step(self._root, b) is not None)
        self._candidates = re.compile(b"[" + re.escape(first) + b"]") if first else None

    @staticmethod
    def _children(node: int, unit: int) -> int:
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _step(self, base: int, byte: int) -> int | None:
        node = base ^ byte
        return node if node < len(self._units) and self._units[node] & 0x800000FF == byte else None

    def longest_prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Length and replacement of the longest key at a place; length 0 without one."""
        base, length, leaf = self._root, 0, 0
        for end in range(at, len(data)):
            node = self._step(base, data[end])
            if node is None:
                break
            unit = self._units[node]
            base = self._children(node, unit)
            if unit & 256:
                length, leaf = end + 1 - at, self._units[base] & 0x7FFFFFFF
        if not length:
            return 0, b""
        return length, self._targets[leaf : self._targets.index(0, leaf)]

    def apply(self, data: bytes, origins: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The mapped bytes and the original place of each; ``origins`` are those of the bytes as they are."""
        if self._candidates is None:
            return data, origins
        parts, places, done = [], [], 0
        for found in self._candidates.finditer(data):
            at = found.start()
            if at < done:
                continue
            length, target = self.longest_prefix(data, at)
            if length:
                parts += [data[done:at], target]
                places += [origins[done:at], np.full(len(target), at, origins.dtype)]
                done = at + length
        return b"".join([*parts, data[done:]]), np.concatenate([*places, origins[done:]])


@dataclass
class Normaliser:
    """What a model does to a text before it is cut into pieces."""

    character_map: CharacterMap | None = None
    dummy_prefix: bool = True
    drop_extra_white: bool = True
    escape_white: bool = True

    @classmethod
    def of(cls, spec: bytes) -> Normaliser:
        found = {number: value for number, value, _ in message_fields(spec)}
        compiled = found.get(_CHARACTER_MAP)
        flags = (bool(found.get(number, 1)) for number in (_DUMMY_PREFIX, _DROP_EXTRA_WHITE, _ESCAPE_WHITE))
        return cls(CharacterMap(compiled) if compiled else None, *flags)

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each and for their end the place in ``data`` it comes from."""
        raw = np.frombuffer(data, np.uint8)
        # Every byte of a character comes from where the character starts.
        origins = np.maximum.accumulate(np.where(raw & 0xC0 == 0x80, 0, np.arange(len(raw))))
        end = len(data)
        if self.character_map:
            data, origins = self.character_map.apply(data, origins)
        if self.drop_extra_white:
            space = np.frombuffer(data, np.uint8) == ord(_SPACE)
            kept = ~space
            kept[1:] |= ~space[:-1]  # the first of a run stays, but for one at the start
            data, origins = np.frombuffer(data, np.uint8)[kept].tobytes(), origins[kept]
        if not data:
            return b"", np.array([end])
        if self.dummy_prefix:
            data, origins = _SPACE + data, np.concatenate([origins[:1], origins])
        mark = _ESCAPED_SPACE if self.escape_white else _SPACE
        if self.escape_white:
            widths = np.where(np.frombuffer(data, np.uint8) == ord(_SPACE), len(mark), 1)
            data, origins = data.replace(_SPACE, mark), np.repeat(origins, widths)
        if self.drop_extra_white:
            while data.endswith(mark):
                data, end = data[: -len(mark)], int(origins[len(data) - len(mark)])
                origins = origins[: len(data)]
        return data, np.append(origins, end)


@dataclass
class Encoder:
    """Ids and original byte spans of texts, with a SentencePiece model that falls back to bytes."""

    model: bytes
    normaliser: Normaliser = field(init=False)

    def __post_init__(self):
        import sentencepiece

        plain, widths, spec, bytes_known = [], [], b"", 0
        for number, value, whole in message_fields(self.model):
            if number == _PIECES:
                piece = {n: v for n, v, _ in message_fields(value)}
                kind = piece.get(_PIECE_KIND, _NORMAL)
                if kind == _USER_DEFINED:
                    raise ValueError("pieces that are kept from normalisation are not supported")
                bytes_known += kind == _BYTE
                widths.append({_BYTE: 1, _CONTROL: 0, _UNKNOWN: 0}.get(kind, len(piece[_PIECE_TEXT])))
            elif number == _TRAINER and any(n == _WHITE_AS_SUFFIX and v for n, v, _ in message_fields(value)):
                raise ValueError("models that mark white space behind words are not supported")
            elif number == _NORMALIZER:
                spec = value
            if number not in (_NORMALIZER, _SELF_TEST):
                plain.append(whole)
        if bytes_known < 256:
            raise ValueError("the model does not fall back to bytes")
        self._widths = np.array(widths)
        self.normaliser = Normaliser.of(spec)
        # The same pieces, with a normaliser that changes nothing.
        unchanged = b"".join(bytes([number << 3, 0]) for number in (_DUMMY_PREFIX, _DROP_EXTRA_WHITE, _ESCAPE_WHITE))
        plain.append(bytes([_NORMALIZER << 3 | 2, len(unchanged)]) + unchanged)
        self._merges = sentencepiece.SentencePieceProcessor(model_proto=b"".join(plain))
        self._whole = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        self.end_id = self._whole.eos_id()

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per text its ids, and where the original bytes of each start and end. The end id stands for no bytes."""
        normalised, origins = [], []
        for text in texts:
            data, places = self.normaliser(text.encode())
            normalised.append(data.decode())
            origins.append(places)
        found = []
        for own, places in zip(self._merges.encode(normalised, num_threads=1), origins):
            ids = np.array([*own, self.end_id], np.int32)
            ends = np.cumsum(self._widths[ids])
            if ends[-1] != len(places) - 1:
                raise AssertionError("pieces do not cover the normalised text")
            starts = np.concatenate([[0], ends[:-1]])
            found.append((ids, places[starts], places[ends]))
        return found

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self._whole.decode([own.tolist() for own in ids])


_SCHEMA = "doc_id long, ids array<int>, starts array<int>, ends array<int>"
_DECODED_SCHEMA = f"{_SCHEMA}, decoded string"


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(parts).astype(np.int32)))


def _encode_task(model_path: str, decode: bool):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with open(model_path, "rb") as file:
            encoder = Encoder(file.read())
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), (text.as_py() or "" for text in batch.column(1)))
            for run in bounded_runs(rows, lambda row: len(row[1]), RUN_CHARS):
                doc_ids, texts = zip(*run)
                ids, starts, ends = zip(*encoder.encode(list(texts)))
                columns = [pa.array(doc_ids, pa.int64()), _lists(ids), _lists(starts), _lists(ends)]
                names = ["doc_id", "ids", "starts", "ends"]
                if decode:
                    columns.append(pa.array(encoder.decode(ids), pa.string()))
                    names.append("decoded")
                yield pa.RecordBatch.from_arrays(columns, names)

    return encode


def encode(docs: DataFrame, model: str | None = None, decode: bool = False) -> DataFrame:
    """(doc_id, ids, starts, ends) of every document, with an end id; ``decode`` adds the text the ids give again.

    Piece i stands for the UTF-8 bytes starts[i] to ends[i] (exclusive) of the text; several pieces that spell one
    character in bytes leave the character to the last of them. A null or empty text has the end id alone. ``model`` is
    a file that executors can read. Repeated rows give the same row each; ids may be null. An empty table gives no rows.
    Other columns are not read. Nothing is shuffled.
    """
    task = _encode_task(model or default_model(), decode)
    schema = _DECODED_SCHEMA if decode else _SCHEMA
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(task, schema)


def report(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Digests of each document's ids and decoded text, and the bytes that its pieces cover."""
    written = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encode(docs, model, decode=True).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(written, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.array_max("ends").cast("long").alias("covered_bytes"),
    )
