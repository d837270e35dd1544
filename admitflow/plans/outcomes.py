"""The analytical outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admitflow import vocabulary as V

FUNNEL_ORDER = ["calendar_date", "channel_code", "application_type"]
DURATION_ORDER = ["channel_code", "application_type"]


FUNNEL_COUNTS = {
    "applications_started": "true",
    "applications_submitted": "submitted_at IS NOT NULL",
    "applications_approved": "application_status = 'APPROVED'",
    "applications_rejected": "application_status = 'REJECTED'",
    "applications_abandoned": "application_status = 'ABANDONED'",
}

_SUMS = {
    "n_applications": "count(*)",
    "submit_seconds": "sum(seconds_to_submit)",
    "submit_n": "count(seconds_to_submit)",
    # Decided applications only: others would mix in the time until they were abandoned.
    "decision_seconds": "sum(CASE WHEN decision IS NOT NULL THEN seconds_to_complete END)",
    "decision_n": "count(CASE WHEN decision IS NOT NULL THEN seconds_to_complete END)",
    "failures": "sum(failure_event_count)",
    "sessions": "sum(session_count)",
    "abandoned": "count_if(application_status = 'ABANDONED')",
}

# A mean over several cells of the cube: total by count, NULL without any value.
_MEANS = {
    "avg_minutes_to_submit": "try_divide(double(sum(submit_seconds)), double(sum(submit_n))) / 60D",
    "avg_minutes_to_decision": "try_divide(double(sum(decision_seconds)), double(sum(decision_n))) / 60D",
    "avg_failure_events": "double(sum(failures)) / double(sum(n_applications))",
    "avg_sessions": "double(sum(sessions)) / double(sum(n_applications))",
    "abandonment_rate": "double(sum(abandoned)) / double(sum(n_applications))",
}


def _aggregates(sql: dict[str, str]) -> list[Column]:
    return [F.expr(text).alias(name) for name, text in sql.items()]


def sorted_by(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def _classified(snapshot: DataFrame, dim_application: DataFrame) -> DataFrame:
    """Snapshot rows with the type of their application. Unknown applications have no type and drop out; they go
    before the join, where they would all meet in one task."""
    types = dim_application.select("application_key", "application_type")
    return snapshot.filter(F.col("application_key") != V.UNKNOWN_KEY).join(types, "application_key")


def outcome_cube(snapshot: DataFrame, dim_application: DataFrame) -> DataFrame:
    """Sums per start date, channel and type that both outputs are derived from.

    Needs a snapshot with one row per application, which the marts gate has established. One pass over the snapshot,
    one large join, and a result whose size depends on days, channels and types only.
    """
    flags = {name: f"count_if({flag} AND application_id IS NOT NULL)" for name, flag in FUNNEL_COUNTS.items()}
    return (
        _classified(snapshot, dim_application)
        .groupBy("started_date_key", "channel_key", "application_type")
        .agg(*_aggregates(flags | _SUMS))
    )


def funnel_from_cube(cube: DataFrame, dim_date: DataFrame, dim_channel: DataFrame) -> DataFrame:
    result = (
        cube.join(dim_date.select("date_key", "calendar_date"), F.col("started_date_key") == F.col("date_key"))
        .join(dim_channel, "channel_key")
        .groupBy(*FUNNEL_ORDER)
        .agg(*[F.sum(name).alias(name) for name in FUNNEL_COUNTS])
    )
    return sorted_by(result, FUNNEL_ORDER)


def durations_from_cube(cube: DataFrame, dim_channel: DataFrame) -> DataFrame:
    result = (
        cube.join(dim_channel, "channel_key")
        .groupBy(*DURATION_ORDER)
        .agg(F.sum("n_applications").alias("n_applications"), *_aggregates(_MEANS))
    )
    return sorted_by(result, DURATION_ORDER)


def funnel(snapshot: DataFrame, dim_application: DataFrame, dim_date: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """Distinct applications per start date, channel and type, for a snapshot whose grain has not been checked.

    Rows are folded per application first, so one aggregation by application replaces a distinct count per column.
    """
    grain = ["started_date_key", "channel_key", "application_type", "application_id"]
    per_application = (
        _classified(snapshot, dim_application)
        .groupBy(*grain)
        .agg(*_aggregates({name: f"max({flag})" for name, flag in FUNNEL_COUNTS.items()}))
    )
    named = {name: f"count_if({name} AND application_id IS NOT NULL)" for name in FUNNEL_COUNTS}
    cells = per_application.groupBy(*grain[:3]).agg(*_aggregates(named))
    return funnel_from_cube(cells, dim_date, dim_channel)


def durations(snapshot: DataFrame, dim_application: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """Time taken, failed events, sessions and abandonment per channel and type."""
    return durations_from_cube(outcome_cube(snapshot, dim_application), dim_channel)


def step_times(event_fact: DataFrame) -> DataFrame:
    """Mean seconds since the previous event, per step."""
    return event_fact.groupBy("step_name").agg(
        F.count("*").alias("n_events"), F.avg("seconds_since_prev_event").alias("avg_seconds")
    )
