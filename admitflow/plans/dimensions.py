"""Dimension tables of the star schema."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admitflow import session
from admitflow import vocabulary as V
from admitflow.functions import scalars as X
from admitflow.operators import counting, keys

APPLICANT_ATTRIBUTES = [
    "applicant_type",
    "country_code",
    "region",
    "acquisition_channel",
    "marketing_campaign",
    "preferred_language",
]


def calendar(events: DataFrame, column: str = "event_timestamp") -> DataFrame:
    """One row per day from the first to the last event date."""
    bounds = events.agg(F.min(column).cast("date").alias("low"), F.max(column).cast("date").alias("high"))
    days = bounds.select(F.explode(F.sequence("low", "high", F.expr("interval 1 day"))).alias("calendar_date"))
    day = F.col("calendar_date")
    return days.select(
        X.date_key(day).alias("date_key"),
        day,
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        F.dayofmonth(day).cast("bigint").alias("day"),
        (F.dayofweek(day) - 1).cast("bigint").alias("day_of_week"),  # Sunday is 0
        F.date_format(day, "EEEE").alias("day_name"),
    )


def channels(code_columns: list[DataFrame]) -> DataFrame:
    """Every code found in the given one-column tables, plus the unknown member."""
    codes = counting.union([c.toDF("channel_code").distinct() for c in code_columns]).distinct()
    session.enable_checkpoints(codes.sparkSession)
    codes = codes.filter(F.col("channel_code").isNotNull()).checkpoint()  # a few codes out of whole tables
    members = keys.add_dense_key(codes, "channel_key", "channel_code")
    return _unknown(members, channel_key=V.UNKNOWN_KEY, channel_code=V.UNKNOWN_CODE).unionByName(members)


def conformed_channels(applicants: DataFrame, applications: DataFrame, events: DataFrame) -> DataFrame:
    """Channel codes of all three tables."""
    return channels(
        [
            applications.select("source_channel"),
            applicants.select("acquisition_channel"),
            events.select("source_channel"),
        ]
    )


def applicants(staged: DataFrame) -> DataFrame:
    """Current attributes per applicant, plus the unknown member whose attributes are NULL."""
    members = keys.add_dense_key(
        staged.select("applicant_id", *APPLICANT_ATTRIBUTES), "applicant_key", "applicant_id"
    )
    return _unknown(members, applicant_key=V.UNKNOWN_KEY, applicant_id=V.UNKNOWN_CODE).unionByName(members)


def applications(staged: DataFrame) -> DataFrame:
    """Descriptive attributes per application; it has no unknown member."""
    columns = ["application_id", "application_type", "device_type", "current_step"]
    return keys.add_dense_key(staged.select(*columns), "application_key", "application_id")


def all_dimensions(
    staged_applicants: DataFrame, staged_applications: DataFrame, events: DataFrame
) -> dict[str, Callable[[], DataFrame]]:
    """Builders of the four dimensions, which do not depend on each other."""
    return {
        "dim_date": lambda: calendar(events),
        "dim_channel": lambda: conformed_channels(staged_applicants, staged_applications, events),
        "dim_applicant": lambda: applicants(staged_applicants),
        "dim_application": lambda: applications(staged_applications),
    }


def _unknown(like: DataFrame, **values) -> DataFrame:
    columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in like.schema.fields]
    return like.sparkSession.range(1).select(*columns)
