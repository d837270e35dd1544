"""Counting rule violations: many rules per scan, one row per rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def counted(df: DataFrame, counts: dict[str, str]) -> DataFrame:
    """Aggregates over a whole table, given as SQL per rule, to rows (check_name, bad_count); NULL counts as 0."""
    one_row = df.selectExpr(*[f"{sql} AS c{i}" for i, sql in enumerate(counts.values())])
    pairs = ", ".join(f"'{name}', CAST(coalesce(c{i}, 0) AS bigint)" for i, name in enumerate(counts))
    return one_row.selectExpr(f"stack({len(counts)}, {pairs}) AS (check_name, bad_count)")


def row_counts(rules: dict[str, str]) -> dict[str, str]:
    """Row-level rules, each the condition for a bad row, as aggregates."""
    return {name: f"count_if({condition})" for name, condition in rules.items()}


def failing_rows(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """All row-level rules of a table in one scan."""
    return counted(df, row_counts(rules))


def duplicate_groups(df: DataFrame, key: str, name: str) -> DataFrame:
    return counted(key_sizes(df, key), {name: "count_if(n > 1)"})


def duplicate_rows(df: DataFrame, key: str, name: str) -> DataFrame:
    return counted(key_sizes(df, key), {name: "sum(CASE WHEN n > 1 THEN n END)"})


def key_sizes(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("n"))


def without_parent(sizes: DataFrame, parent: DataFrame, parent_key: str) -> DataFrame:
    """Of ``key_sizes``, the keys that have no parent; NULL has none."""
    parents = parent.select(F.col(parent_key).alias("parent"))
    return sizes.join(parents, F.col("key") == F.col("parent"), "left_anti")


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Rows without a parent. Rows are counted per key first, so a frequent key reaches the join as one row."""
    lost = without_parent(key_sizes(child, foreign_key), parent, parent_key)
    return counted(lost, {name: "sum(n)"})


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
