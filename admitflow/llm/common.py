"""Helpers that the training-data operators share: reading, storing, choosing learning rows, shipping models."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from admitflow import session

T = TypeVar("T")

HELD_OUT_REMAINDER = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: later jobs neither repeat it nor depend on its executors."""
    path = session.scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 2 when divided by 4. A null id is not."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(remainder == HELD_OUT_REMAINDER, F.lit(False))


def sized_partitions(df: DataFrame, rows: int, rows_per_task: int) -> int:
    """As many partitions as the session's default, or more if each would hold more than ``rows_per_task``."""
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(default, math.ceil(rows / rows_per_task))


# Parts that the range of hashes is counted in: 2 to this power.
_HASH_PARTS_POWER = 12


def first_by_hash(rows: DataFrame, by: str, most: int) -> DataFrame:
    """Of each value of ``by`` the ``most`` rows whose doc_id has the smallest hash; all, if there are fewer.

    The hashes are counted by part of their range first. Only the parts that hold the smallest go to the window, so its
    task for a frequent value reads little more than ``most`` rows, however many there are. ``by`` holds the classes of
    a model, so its values are few: one row for each is broadcast.
    """
    order = F.xxhash64("doc_id")
    part = F.shiftright(order, 64 - _HASH_PARTS_POWER)
    parts = rows.groupBy(F.col(by).alias("__by"), part.alias("__part")).agg(F.count("*").alias("n"))
    before = Window.partitionBy("__by").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    needed = parts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < most)
    last = needed.groupBy("__by").agg(F.max("__part").alias("__last"))
    near = rows.join(F.broadcast(last), F.col(by) == F.col("__by")).where(part <= F.col("__last")).select(*rows.columns)
    place = F.row_number().over(Window.partitionBy(by).orderBy(order, "doc_id"))
    return near.withColumn("__place", place).where(F.col("__place") <= most).drop("__place")


def bounded_runs(rows: Iterable[T], size: Callable[[T], int], most: int) -> Iterator[list[T]]:
    """Neighbouring rows whose sizes add up to ``most`` at most; a larger row is a run of its own."""
    run: list[T] = []
    total = 0
    for row in rows:
        own = size(row)
        if run and total + own > most:
            yield run
            run, total = [], 0
        run.append(row)
        total += own
    if run:
        yield run
