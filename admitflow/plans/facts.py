"""Fact tables of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admitflow import vocabulary as V
from admitflow.functions import scalars as X
from admitflow.operators import ordered, skew

# Numbers are unique per application once the staging gate has passed; the rest keeps other input deterministic.
EVENT_ORDER = ["event_sequence", "event_timestamp", "event_id"]


def _members(dimension: DataFrame, key: str, code: str, as_key: str, as_code: str) -> DataFrame:
    """Lookup side of a dimension. The unknown member is never looked up: its code could also be a real one."""
    return dimension.filter(F.col(key) != V.UNKNOWN_KEY).select(F.col(key).alias(as_key), F.col(code).alias(as_code))


# Codes that still fit every executor with ease.
BROADCAST_CODES = 100_000


def _codes(dim_channel: DataFrame) -> DataFrame:
    """Lookup side of the channel dimension, broadcast when counted small: few channels hold many rows each, so the
    rows should not be shuffled by channel."""
    members = _members(dim_channel, "channel_key", "channel_code", "__channel", "__channel_code")
    return F.broadcast(members) if dim_channel.count() <= BROADCAST_CODES else members


def _found(key: str) -> Column:
    return F.coalesce(F.col(key), F.lit(V.UNKNOWN_KEY).cast("bigint"))


def event_fact(events: DataFrame, dim_application: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """One row per event, with the seconds since the previous event of its application (0 for the first)."""
    split = skew.split(events, "application_id")
    split = ordered.with_previous(split, EVENT_ORDER, {"__previous": "event_timestamp"})

    applications = _members(dim_application, "application_key", "application_id", "__application", "__application_id")
    match = F.col("application_id") == F.col("__application_id")
    # The window already distributes ordinary applications by id: the lookup adds no shuffle of events.
    located = split.cold.join(applications, match, "left")
    if split.hot is not None:
        few = applications.filter(split.holds_hot_key(F.col("__application_id")))
        # One row per hot key where ids are unique; counted, as nothing here ensures that.
        few = F.broadcast(few) if few.count() <= BROADCAST_CODES else few
        located = located.unionByName(split.hot.join(few, match, "left"))

    channels = _codes(dim_channel)
    gap = X.seconds_between(F.col("__previous"), F.col("event_timestamp"))
    return located.join(channels, F.col("source_channel") == F.col("__channel_code"), "left").select(
        "event_id",
        _found("__application").alias("application_key"),
        _found("__channel").alias("channel_key"),
        X.date_key(F.col("event_timestamp")).alias("date_key"),
        "event_sequence",
        "event_timestamp",
        "event_type",
        "step_name",
        "from_status",
        "to_status",
        "event_outcome",
        "failure_reason",
        "session_id",
        "event_metadata",
        F.coalesce(gap, F.lit(0)).cast("bigint").alias("seconds_since_prev_event"),
    )


def application_snapshot(
    applications: DataFrame,
    history: DataFrame,
    dim_application: DataFrame,
    dim_applicant: DataFrame,
    dim_channel: DataFrame,
) -> DataFrame:
    """One row per application with its milestones, durations, failed events and sessions.

    ``history`` is one row per application, so the event log is not read again. Applicants with very many applications
    are found first, and the applicant lookup spreads theirs over many tasks.
    """
    per_application = history.select(
        F.col("application_id").alias("__history_id"), "failure_event_count", "session_count"
    )
    lookup = _members(dim_application, "application_key", "application_id", "__application", "__application_id")
    owners = _members(dim_applicant, "applicant_key", "applicant_id", "__applicant", "__applicant_id")
    channels = _codes(dim_channel)

    joined = (
        applications.join(per_application, F.col("application_id") == F.col("__history_id"), "left")
        .join(lookup, F.col("application_id") == F.col("__application_id"), "left")
        .join(channels, F.col("source_channel") == F.col("__channel_code"), "left")
    )
    crowded = skew.hot_keys(applications, "applicant_id")
    joined = skew.lookup(joined, "applicant_id", owners, "__applicant_id", crowded, by="application_id")
    started, submitted, completed = F.col("started_at"), F.col("submitted_at"), F.col("completed_at")
    return joined.select(
        "application_id",
        _found("__application").alias("application_key"),
        _found("__applicant").alias("applicant_key"),
        _found("__channel").alias("channel_key"),
        X.date_key(started).alias("started_date_key"),
        X.date_key(submitted).alias("submitted_date_key"),
        X.date_key(completed).alias("completed_date_key"),
        "started_at",
        "submitted_at",
        "completed_at",
        "application_status",
        "decision",
        "rejection_reason",
        X.seconds_between(started, submitted).alias("seconds_to_submit"),
        X.seconds_between(started, completed).alias("seconds_to_complete"),
        F.coalesce("failure_event_count", F.lit(0)).cast("bigint").alias("failure_event_count"),
        F.coalesce("session_count", F.lit(0)).cast("bigint").alias("session_count"),
    )
