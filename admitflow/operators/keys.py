"""Dense ordered surrogate keys."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from admitflow import session

# Rows one task may number on its own, however large the table is.
PIECE_ROWS = 1_000_000
PIECE_ROWS_CONF = "spark.admitflow.keyPieceRows"
# Pieces whose offsets (16 bytes each) may be broadcast.
BROADCAST_PIECES = 100_000

_POSITION_BITS = (1 << 33) - 1


def add_dense_key(df: DataFrame, key: str, by: str) -> DataFrame:
    """Put ``key`` = 1..N in front, in the order of the unique column ``by``.

    A counted-small table is numbered in one task. A larger one is range partitioned and sorted; each row's place in
    its partition plus the sizes of the partitions before gives the same numbers without moving all rows to one task.
    """
    spark = df.sparkSession
    rows = df.count()
    pieces = math.ceil(rows / int(spark.conf.get(PIECE_ROWS_CONF, str(PIECE_ROWS))))
    if pieces <= 1:
        number = F.row_number().over(Window.orderBy(F.col(by).asc_nulls_last())).cast("bigint")
        return df.select(number.alias(key), *df.columns)

    session.enable_checkpoints(spark)
    order = F.col(by).asc_nulls_last()
    placed = (
        df.repartitionByRange(pieces, order)
        .sortWithinPartitions(order)
        .select(
            "*",
            F.spark_partition_id().alias("__piece"),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_BITS)).alias("__place"),
        )
        .checkpoint()  # the borders come from a sample: both reads below need the same ones
    )
    # One row per piece.
    earlier = F.sum("n").over(Window.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (
        placed.groupBy("__piece")
        .agg(F.count("*").alias("n"))
        .select("__piece", F.coalesce(earlier, F.lit(0)).alias("__offset"))
    )
    number = F.col("__offset") + F.col("__place") + 1
    if pieces <= BROADCAST_PIECES:
        offsets = F.broadcast(offsets)
    return placed.join(offsets, "__piece").select(number.alias(key), *df.columns)
