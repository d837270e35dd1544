"""Raw text tables to typed staging tables, row for row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from admitflow import vocabulary as V
from admitflow.functions import scalars as X


def _blankable_timestamp(col: Column) -> Column:
    return X.strict_timestamp(X.blank_to_null(col))


# How a column is read; any other column is copied as text.
CONVERSIONS = {
    "applicants": {
        "marketing_campaign": X.blank_to_null,
        "created_at": X.strict_timestamp,
        "updated_at": X.strict_timestamp,
    },
    "onboarding_applications": {
        "started_at": X.strict_timestamp,
        "submitted_at": _blankable_timestamp,
        "completed_at": _blankable_timestamp,
        "decision": X.blank_to_null,
        "rejection_reason": X.blank_to_null,
        "updated_at": X.strict_timestamp,
    },
    "onboarding_events": {
        "event_sequence": X.strict_int,
        "event_timestamp": X.strict_timestamp,
        "from_status": X.blank_to_null,
        "failure_reason": X.blank_to_null,
        "event_metadata": X.blank_to_null,
    },
}

# The report reads what it can: unreadable values become NULL and are counted by its rules.
LENIENT = {
    "applicants": {},
    "onboarding_applications": {
        "started_at": X.lenient_timestamp,
        "submitted_at": X.lenient_timestamp,
        "completed_at": X.lenient_timestamp,
    },
    "onboarding_events": {"event_timestamp": X.lenient_timestamp, "event_sequence": X.lenient_number},
}

STAGED_NAMES = {
    "applicants": "stg_applicants",
    "onboarding_applications": "stg_applications",
    "onboarding_events": "stg_events",
}


def stage(raw: DataFrame, source: str) -> DataFrame:
    """The typed form of one source. Unreadable times and numbers raise."""
    convert = CONVERSIONS[source]
    columns = V.SOURCE_COLUMNS[source]
    return raw.select(*[convert.get(c, lambda col: col)(F.col(c)).alias(c) for c in columns])


def read_leniently(raw: DataFrame, source: str) -> DataFrame:
    """All text columns with blanks as NULL, plus a typed ``<column>_read`` for times and numbers."""
    columns = V.SOURCE_COLUMNS[source]
    text = raw.select(*[X.blank_to_null(F.col(c)).alias(c) for c in columns])
    return text.select("*", *[read(F.col(c)).alias(f"{c}_read") for c, read in LENIENT[source].items()])
