"""Delivered CSV extracts, read as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitflow import vocabulary as V
from admitflow.sources import spliced


def extract_paths(folder: str) -> dict[str, str]:
    """Each source is ``<name>.csv`` in the folder: one file, or a directory of part files."""
    return {source: f"{folder.rstrip('/')}/{source}.csv" for source in V.SOURCE_COLUMNS}


def has_line_breaks_in_fields(spark: SparkSession, path: str) -> bool:
    """Whether some record goes on over a line end: its first line then has an odd number of quotes."""
    return spliced.look(spark, path).line_breaks


_OPTIONS = {"escape": '"', "maxCharsPerColumn": "-1"}


def read_csv(spark: SparkSession, path: str, line_breaks_in_fields: bool | None = None) -> DataFrame:
    """A CSV as it is: columns as named by its header, all text, empty fields as NULL. A missing path raises.

    Files are split over tasks, also where fields hold line breaks: a look at the quotes then tells which lines belong
    together. It is spared if ``line_breaks_in_fields`` is False. Files whose quotes do not tell (quotes inside fields
    that have none around them, records as long as a split) are read whole, one task each.
    """
    layout = None if line_breaks_in_fields is False else spliced.look(spark, path)
    broken = layout is not None and layout.line_breaks
    reader = spark.read.options(header=True, multiLine=broken, **_OPTIONS)
    columns = reader.csv(path).schema  # reads one header, infers nothing
    if broken and layout.separable:
        return spliced.read(spark, path, layout, columns.names, _OPTIONS)
    return (
        reader.schema(columns)
        .option("enforceSchema", False)  # a part file with another header raises
        .option("mode", "FAILFAST")  # so does a record with too few or too many fields
        .csv(path)
    )


def total_bytes(spark: SparkSession, folder: str) -> int:
    """Size of all sources, from the file listing; no content is read."""
    files = spark.read.format("binaryFile").load(list(extract_paths(folder).values()))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
