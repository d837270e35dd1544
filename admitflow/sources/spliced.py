"""CSV records that go on over line ends, read by many tasks a file.

A file is split at line ends wherever Spark likes. One look counts quotes: a split with an odd number of them turns the
state, inside or outside a quoted field, for the splits that follow, so sums over one row a split give the state that
each one starts in. The look also brings the first and the last few lines of a split, out of which the records that cross
a border are put together. Then every split is read on its own: what its quotes hold together is one record.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from admitflow import session

# What the look may bring of a record that crosses a border, per side.
CARRIED_BYTES = 1 << 20
# Splits that start inside a field are broadcast, up to so many.
BROADCAST_SPLITS = 1_000_000

# A quote, or a run of doubled ones and one more, that neither opens nor closes a field; a line end of another kind.
_STRAY = r'[^,"]"(?:"")*[^,"\r]|\r[^"]'
_FIELD = r'(?:[^",\r\n]*|"(?:[^"]|"")*")'
_RECORD = rf"^{_FIELD}(?:,{_FIELD})*$"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(line, file, block): a file stands by the hash of its path, which each of its lines carries."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").cast("binary").alias("line"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _quotes(lines: pa.Array) -> np.ndarray:
    return pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, bool]]:
    """Lines of one split each, and whether they are its first."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, blocks = batch.column("file").to_numpy(), batch.column("block").to_numpy()
        turns = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
        for start, end in zip([0, *turns], [*turns, batch.num_rows]):
            run = batch.slice(start, end - start)
            key = (int(files[start]), int(blocks[start]))
            yield run, key != last
            last = key


class _Ends:
    """A split as far as the look goes: its quotes, and the lines at its ends."""

    def __init__(self, file: int, block: int, carried: int):
        self.key, self.quotes, self.odd, self.stray = (file, block), 0, False, False
        self._carried = carried
        self.head: list[bytes] | None = []  # up to the first odd line; None: too long
        self.tail: list[bytes] | None = []  # from the last odd line
        self._head_bytes = self._tail_bytes = 0

    def add(self, lines: pa.Array) -> None:
        quotes = _quotes(lines)
        self.quotes += int(quotes.sum())
        self.stray = self.stray or pc.any(pc.match_substring_regex(lines, _STRAY), min_count=0).as_py()
        odd = np.flatnonzero(quotes & 1)
        if not self.odd:
            self._grow_head(lines[: odd[0] + 1] if len(odd) else lines)
        if len(odd):
            self.odd, self.tail, self._tail_bytes = True, [], 0
            lines = lines[odd[-1] :]
        if self.odd:
            self._grow_tail(lines)

    def _grow_head(self, lines: pa.Array) -> None:
        self._head_bytes += lines.nbytes
        fits = self.head is not None and self._head_bytes <= self._carried
        self.head = self.head + lines.to_pylist() if fits else None

    def _grow_tail(self, lines: pa.Array) -> None:
        self._tail_bytes += lines.nbytes
        fits = self.tail is not None and self._tail_bytes <= self._carried
        self.tail = self.tail + lines.to_pylist() if fits else None

    def row(self) -> dict:
        def text(lines: list[bytes] | None) -> bytes | None:
            return b"\n".join(lines) if self.odd and lines is not None else None

        file, block = self.key
        return {
            "file": file, "block": block, "turns": self.quotes % 2, "odd": self.odd, "stray": self.stray,
            "head": text(self.head), "tail": text(self.tail),
        }


_ENDS = pa.schema(
    [
        ("file", pa.int64()), ("block", pa.int64()), ("turns", pa.int32()), ("odd", pa.bool_()),
        ("stray", pa.bool_()), ("head", pa.binary()), ("tail", pa.binary()),
    ]
)
_ENDS_SCHEMA = "file long, block long, turns int, odd boolean, stray boolean, head binary, tail binary"


def _look_task(carried: int):
    def look_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = None
        for run, first in _runs(batches):
            if first:
                if ends:
                    yield pa.RecordBatch.from_pylist([ends.row()], _ENDS)
                ends = _Ends(run.column("file")[0].as_py(), run.column("block")[0].as_py(), carried)
            ends.add(run.column("line"))
        if ends:
            yield pa.RecordBatch.from_pylist([ends.row()], _ENDS)

    return look_at


@dataclass(frozen=True)
class Layout:
    """One stored row per split of the files, and what follows from all of them."""

    splits: DataFrame
    line_breaks: bool
    # Whether records can be put together from splits; else only a reader of whole files gets them right.
    separable: bool


def look(spark: SparkSession, path: str, carried: int = CARRIED_BYTES) -> Layout:
    found = session.scratch_path(spark, "splits")
    _lines(spark, path).mapInArrow(_look_task(carried), _ENDS_SCHEMA).write.parquet(found)
    by_place = Window.partitionBy("file").orderBy("block")
    before = F.coalesce(F.sum("turns").over(by_place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = spark.read.parquet(found).select(
        "*",
        (before % 2 == 1).alias("inside"),
        ((before + F.col("turns")) % 2 == 1).alias("open"),
        F.lead("head").over(by_place).alias("next_head"),
    )
    # A record over a whole split, one that is too long on a side, or a field that the end of its file leaves open.
    unfit = "stray OR (inside AND NOT odd) OR (open AND (tail IS NULL OR next_head IS NULL))"
    seen = splits.selectExpr("odd", f"coalesce({unfit}, false) AS unfit", "inside").agg(
        F.max("odd").alias("odd"), F.max("unfit").alias("unfit"), F.count_if("inside").alias("inside")
    ).first()
    return Layout(splits, bool(seen["odd"]), not seen["unfit"] and seen["inside"] <= BROADCAST_SPLITS)


_BLANK = pa.array([b"", b"\r"], pa.binary())
_RECORDS = pa.schema([("record", pa.binary()), ("header", pa.bool_())])
_RECORDS_SCHEMA = "record binary, header boolean"


def _joined(lines: pa.Array, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Runs of lines that follow each other from the first line on, each as one text: cut out of all lines' bytes."""
    ended = pc.binary_join_element_wise(lines, b"", b"\n")
    _, offsets, data = ended.buffers()
    offsets = np.frombuffer(offsets, np.int32)[ended.offset : ended.offset + len(ended) + 1]
    cuts = pa.py_buffer(np.append(offsets[starts], offsets[ends[-1] + 1]))
    return pc.binary_slice(pa.Array.from_buffers(pa.binary(), len(starts), [None, cuts, data]), 0, -1)


class _Records:
    """The records that begin and end in one split."""

    def __init__(self, inside: bool, starts_file: bool):
        self._inside, self._skipping, self._header = inside, inside, starts_file
        self._open: list[bytes] = []

    def add(self, lines: pa.Array) -> pa.RecordBatch:
        """The records that end in these lines, in order."""
        odd = (_quotes(lines) & 1).astype(bool)
        outside = (np.cumsum(odd) + self._inside) % 2 == 0  # behind each line
        ends = np.flatnonzero(outside)
        if not len(ends):
            self._inside = True
            self._keep(lines)
            return self._checked(pa.array([], pa.binary()))
        starts = np.append(0, ends[:-1] + 1)
        blank = pc.is_in(lines, value_set=_BLANK).to_numpy(zero_copy_only=False)
        filled = ~((starts == ends) & blank[ends])
        found, continued = _joined(lines, starts, ends), self._inside
        if continued:
            # The first record began in lines given before, or in another split.
            first = b"\n".join([*self._open, found[0].as_py()])
            found = pa.concat_arrays([pa.array([] if self._skipping else [first], pa.binary()), found[1:]])
            filled = np.append([] if self._skipping else [True], filled[1:]).astype(bool)
            self._open, self._skipping = [], False
        self._inside = not outside[-1]
        self._keep(lines[int(ends[-1]) + 1 :])
        return self._checked(found if filled.all() else found.filter(pa.array(filled)))

    def _keep(self, lines: pa.Array) -> None:
        if not self._skipping:
            self._open += lines.to_pylist()

    def _checked(self, records: pa.Array) -> pa.RecordBatch:
        if pc.any(pc.ends_with(records, b"\r"), min_count=0).as_py():
            records = pc.replace_substring_regex(records, r"\r$", "")
        if not pc.all(pc.match_substring_regex(records, _RECORD), min_count=0).as_py():
            raise ValueError("a quote stands inside a field without quotes: read such files whole")
        header = np.zeros(len(records), bool)
        if self._header and len(records):
            header[0], self._header = True, False
        return pa.RecordBatch.from_arrays([records, pa.array(header)], schema=_RECORDS)


def _splice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    records = None
    for run, first in _runs(batches):
        if first:
            records = _Records(run.column("inside")[0].as_py(), run.column("block")[0].as_py() == 0)
        yield records.add(run.column("line"))


def records(spark: SparkSession, path: str, layout: Layout) -> DataFrame:
    """(record, header): every record as text; ``header`` marks the first one of each file. Blank lines are left out."""
    inside = F.broadcast(layout.splits.where("inside").select("file", "block", "inside"))
    lines = _lines(spark, path).join(inside, ["file", "block"], "left")
    own = lines.select("line", "file", "block", F.coalesce("inside", F.lit(False)).alias("inside"))
    crossing = layout.splits.where("open").select(
        F.concat("tail", F.lit(b"\n"), "next_head").alias("record"), F.lit(False).alias("header")
    )
    whole = crossing.select(F.regexp_replace(F.col("record").cast("string"), "\r$", "").alias("record"), "header")
    return own.mapInArrow(_splice, _RECORDS_SCHEMA).select(F.col("record").cast("string"), "header").union(whole)


def read(spark: SparkSession, path: str, layout: Layout, columns: list[str], options: dict[str, str]) -> DataFrame:
    """The records as columns of text. A header that differs from ``columns`` raises, as does a malformed record."""
    schema = ", ".join(f"`{name}` string" for name in columns)
    parsed = records(spark, path, layout).select(
        F.from_csv("record", schema, {**options, "mode": "FAILFAST", "multiLine": "true"}).alias("row"), "header"
    )
    return parsed.where(_is_data(columns)).select("row.*")


def _is_data(columns: list[str]) -> Column:
    names = F.array(*[F.lit(name) for name in columns])
    found = F.array(*[F.col(f"row.`{name}`") for name in columns])
    wrong = F.raise_error(F.concat(F.lit("a file has another header: "), F.array_join(found, ",", "")))
    return F.when(F.col("header") & ~found.eqNullSafe(names), wrong.cast("boolean")).otherwise(~F.col("header"))
