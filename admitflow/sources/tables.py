"""Stored tables: one Parquet directory per table, grouped in layers."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitflow.sources.replace import Slot


@dataclass(frozen=True)
class Layer:
    """A folder of tables. Every write replaces the whole table, and only once the new one is whole."""

    spark: SparkSession
    folder: str

    def path(self, table: str) -> str:
        return f"{self.folder.rstrip('/')}/{table}"

    def write(self, table: str, df: DataFrame) -> DataFrame:
        """Store ``df`` and give back the stored table, so later steps do not compute it again."""
        Slot(self.spark, self.path(table)).write(df)
        return self.read(table)

    def write_all(self, builds: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        """Build and store tables that do not depend on each other, as concurrent jobs that fill each other's gaps."""
        write = inheritable_thread_target(self.spark)(lambda table, build: self.write(table, build()))
        with ThreadPoolExecutor(len(builds)) as pool:
            return dict(zip(builds, pool.map(write, builds.keys(), builds.values())))

    def read(self, table: str) -> DataFrame:
        return Slot(self.spark, self.path(table)).read()

    def count(self, table: str) -> int:
        """Row count, taken from the Parquet footers."""
        return self.read(table).count()

    def total_bytes(self) -> int:
        """Size of all tables, from the file listing; 0 where nothing is stored yet."""
        files = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
        try:
            listed = files.option("pathGlobFilter", "*.parquet").load(self.folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0
        return listed.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


# What one task may write as one file.
SINGLE_FILE_ROWS = 1_000_000


def export(df: DataFrame, path: str, single_file_rows: int = SINGLE_FILE_ROWS) -> int:
    """Write a sorted result as Parquet and count what can be read back.

    A result counted to have few rows is one file; the files of a larger one follow each other in sort order.
    """
    result = df.coalesce(1) if df.count() <= single_file_rows else df
    stored = Slot(df.sparkSession, path)
    stored.write(result)
    return stored.read().count()
