"""Column expressions shared by staging, marts and checks. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


_DATE = r"^(\d{4})[-/](\d{1,2})[-/](\d{1,2})"
_NUMBER = r"^[+-]?(?:(?:\d+[.]?\d*|[.]\d+)(?:[eE][+-]?\d+)?|(?i:inf|infinity))$"


def _dated(col: Column) -> Column:
    """Text that begins with year, month and day as Spark reads it, NULL for other text.

    Spark would also read a bare year, or a bare time as a time of today.
    """
    text = F.trim(col)
    return F.when(text.rlike(_DATE), F.regexp_replace(text, _DATE, "$1-$2-$3"))


def strict_timestamp(col: Column) -> Column:
    """Text to a zone-less timestamp; unreadable text raises, an explicit offset is shifted to UTC."""
    readable = F.coalesce(_dated(col), F.concat(F.lit("no date: "), col))
    return readable.cast("timestamp").cast("timestamp_ntz")


def strict_int(col: Column) -> Column:
    return col.cast("int")


def lenient_timestamp(col: Column) -> Column:
    """As ``strict_timestamp`` with NULL for unreadable text, decided row by row.

    Eight digits are year, month and day; month/day/year is read as well.
    """
    digits = F.regexp_replace(F.trim(col), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    american = F.regexp_replace(digits, r"^(\d{1,2})/(\d{1,2})/(\d{4})(?!\d)", "$3-$1-$2")
    return _dated(american).try_cast("timestamp").cast("timestamp_ntz")


def lenient_number(col: Column) -> Column:
    """Decimal text to a number; other text, "NaN" and the literals of programming languages are NULL."""
    text = F.trim(col)
    return F.when(text.rlike(_NUMBER), text).try_cast("double")


def date_key(ts: Column) -> Column:
    """yyyymmdd as an integer, NULL for NULL."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries crossed from start to end: 0.9 s to 1.1 s is one."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)
