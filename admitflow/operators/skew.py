"""Keys that hold too many rows for one task, found before rows are grouped by them."""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is worked on in pieces of about as many rows, however large the table is.
HOT_ROWS = 5_000_000
HOT_ROWS_CONF = "spark.admitflow.hotKeyRows"
# A frequent-item sketch over n entries is off by 3.5 / n of all rows at most: here by rows / 5,714. For tables of up to
# 4,000 times the limit that is 0.7 of the limit, so every key above 1.7 of it is found. Larger tables are counted by key.
SKETCH_ITEMS = 20_000
SKETCHED_LIMITS = 4_000


@dataclass(frozen=True)
class Split:
    """One table as rows of ordinary keys and rows of hot keys (None when there are none)."""

    key: str
    cold: DataFrame
    hot: DataFrame | None = None
    hot_keys: tuple = ()
    pieces: int = 0

    def map(self, step) -> Split:
        return replace(self, cold=step(self.cold), hot=None if self.hot is None else step(self.hot))

    def union(self) -> DataFrame:
        return self.cold if self.hot is None else self.cold.unionByName(self.hot)

    def holds_hot_key(self, col: Column) -> Column:
        return _holds(col, self.hot_keys)


def _holds(col: Column, keys: tuple) -> Column:
    filled = [k for k in keys if k is not None]
    tests = [F.coalesce(col.isin(filled), F.lit(False))] if filled else []
    if None in keys:
        tests.append(col.isNull())
    return reduce(lambda a, b: a | b, tests)


def hot_keys(df: DataFrame, key: str) -> dict[object, int]:
    """The keys of ``df`` with more rows than one task should get, and their rows.

    A table that has fewer rows than a hot key needs no closer look (for stored tables that count comes from the
    Parquet footers). Otherwise one pass over the key column fills a frequent-item sketch of fixed size, or, where that
    would be too coarse, counts the rows by key. The hot keys come back to the driver: one for each ``HOT_ROWS`` rows of
    the table at most, by arithmetic.
    """
    rows, limit = df.count(), _limit(df)
    if rows <= limit:
        return {}
    if rows <= SKETCHED_LIMITS * limit:
        frequent = f"filter(approx_top_k(`{key}`, {SKETCH_ITEMS // 2}, {SKETCH_ITEMS}), item -> item.count > {limit}L)"
        found = df.agg(F.expr(frequent).alias("items")).first()["items"]
    else:
        sizes = df.groupBy(F.col(key).alias("item")).agg(F.count("*").alias("count"))
        found = sizes.filter(F.col("count") > limit).collect()
    return {entry["item"]: entry["count"] for entry in found}


def _limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(HOT_ROWS_CONF, str(HOT_ROWS)))


def split(df: DataFrame, key: str) -> Split:
    """Separate the hot keys of ``df``."""
    found = hot_keys(df, key)
    if not found:
        return Split(key, df)
    keys = tuple(found)
    held = _holds(F.col(key), keys)
    return Split(key, df.filter(~held), df.filter(held), keys, math.ceil(sum(found.values()) / _limit(df)))


def lookup(
    rows: DataFrame, key: str, members: DataFrame, member_key: str, hot: dict[object, int], by: str
) -> DataFrame:
    """Left join of ``rows`` to ``members``, the rows of ``hot`` keys spread over many tasks by a hash of ``by``.

    Each hot key is cut into as many parts as the largest one needs, and its members are repeated once per part: few
    rows, as hot keys are few. Rows without a key meet nothing, yet they would all meet in one task; they are spread
    alike where they are many.
    """
    match = F.col(key) == F.col(member_key)
    if not hot:
        return rows.join(members, match, "left")
    keys, parts = tuple(hot), math.ceil(max(hot.values()) / _limit(rows))
    part = F.when(_holds(F.col(key), keys), F.pmod(F.xxhash64(by), F.lit(parts)).cast("int")).otherwise(F.lit(0))
    copies = F.when(_holds(F.col(member_key), keys), F.sequence(F.lit(0), F.lit(parts - 1)))
    spread = members.withColumn("__copy", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    return rows.withColumn("__part", part).join(spread, match & (F.col("__part") == F.col("__copy")), "left").drop(
        "__part", "__copy"
    )
