"""Work on the ordered rows of a key: the value before, and the latest row."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admitflow import session
from admitflow.operators.skew import Split

_ROW = "__row"
_PIECE = "__piece"
# Rows of a key and a few values that may be broadcast.
BROADCAST_STARTS = 100_000


def _ascending(order: list[str]) -> list[Column]:
    return [F.col(name).asc_nulls_last() for name in order]


def _rank(order: list[str], nulls_last: bool = True) -> list[Column]:
    """Struct fields that compare like ``order``; a NULL is the smallest value inside a struct."""
    fields = []
    for name in order:
        if nulls_last:
            fields.append(F.col(name).isNull().alias(f"{name}__null"))
        fields.append(F.col(name))
    return fields


def with_previous(split: Split, order: list[str], values: dict[str, str]) -> Split:
    """Add, per key and in ``order``, the preceding row's value: ``values`` maps new name to source column.

    Ordinary keys: one window, so one shuffle by key, shared by every window on that key. Hot keys are range
    partitioned by key and order, so that a key spreads over many tasks; only the last row of each piece travels on
    to the piece that follows.
    """
    cold = _window(split.cold, [split.key], order, values)
    hot = None if split.hot is None else _in_pieces(split, order, values)
    return replace(split, cold=cold, hot=hot)


def _window(df: DataFrame, keys: list[str], order: list[str], values: dict[str, str]) -> DataFrame:
    spec = Window.partitionBy(*keys).orderBy(*_ascending(order))
    return df.select("*", *[F.lag(source).over(spec).alias(name) for name, source in values.items()])


def _in_pieces(split: Split, order: list[str], values: dict[str, str]) -> DataFrame:
    key = split.key
    session.enable_checkpoints(split.hot.sparkSession)
    # Equal rows get different row numbers, so a run of copies can be cut as well. Both steps are stored: row numbers
    # and piece borders must stay the same if a task is run again.
    numbered = split.hot.withColumn(_ROW, F.monotonically_increasing_id()).checkpoint()
    full_order = [*order, _ROW]
    pieces = (
        numbered.repartitionByRange(max(split.pieces, 2), F.col(key), *_ascending(full_order))
        .withColumn(_PIECE, F.spark_partition_id())
        .checkpoint()
    )

    spec = Window.partitionBy(_PIECE, key).orderBy(*_ascending(full_order))
    inside = pieces.select(
        "*",
        (F.row_number().over(spec) == 1).alias("__first"),
        *[F.lag(source).over(spec).alias(f"__in_{name}") for name, source in values.items()],
    )

    # One row per key and piece: at most pieces + hot keys, which the split has counted.
    last = F.max(F.struct(*_rank(full_order), *[F.col(s).alias(f"__v_{n}") for n, s in values.items()]))
    ends = pieces.groupBy(key, _PIECE).agg(last.alias("__last"))
    before = F.lag("__last").over(Window.partitionBy(key).orderBy(_PIECE))
    starts = ends.select(F.col(key).alias("__key"), F.col(_PIECE).alias("__at"), before.alias("__before"))

    if split.pieces + len(split.hot_keys) <= BROADCAST_STARTS:
        starts = F.broadcast(starts)
    joined = inside.join(
        starts, F.col(key).eqNullSafe(F.col("__key")) & (F.col(_PIECE) == F.col("__at")), "left"
    )
    kept = [c for c in numbered.columns if c != _ROW]
    return joined.select(
        *kept,
        *[
            F.when(F.col("__first"), F.col(f"__before.__v_{name}")).otherwise(F.col(f"__in_{name}")).alias(name)
            for name in values
        ],
    )


def latest(order: list[str], fields: list[str], nulls_last: bool = False) -> Column:
    """Aggregate: ``fields`` of the row that comes last in ``order``, as a struct. Combines before the shuffle."""
    return F.max(F.struct(*_rank(order, nulls_last), F.struct(*fields).alias("row")))["row"]
