"""The event log folded to one row per application."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admitflow import vocabulary as V
from admitflow.functions import predicates as P
from admitflow.operators import ordered, skew

# Rows that share a sequence number are told apart by what they carry, so results do not depend on row order.
TIES = ["to_status", "from_status", "step_name"]
BY_SEQUENCE = ["event_sequence", "event_timestamp", *TIES]
BY_TIME = ["event_timestamp", "event_sequence", *TIES]

_USED = [
    "application_id",
    "event_sequence",
    "event_timestamp",
    "step_name",
    "from_status",
    "to_status",
    "event_outcome",
    "session_id",
]

_TERMINAL = P.listed(V.TERMINAL_STATUSES)
_FOLD = {
    "event_count": "count(*)",
    "sequence_faults": "count_if(event_sequence <= previous_sequence)",
    "timestamp_faults": "count_if(event_timestamp <= previous_timestamp)",
    "status_breaks": "count_if(previous_to_status IS NOT NULL AND NOT (from_status <=> previous_to_status))",
    "after_terminal": f"count_if(previous_to_status IN {_TERMINAL})",
    "undated_events": "count_if(event_timestamp IS NULL)",
    "numbered_events": "count(event_sequence)",
    "repeated_numbers": "count_if(event_sequence = number_before)",
    "fractional_numbers": "count_if(event_sequence <> floor(event_sequence))",
    "first_number": "min(event_sequence)",
    "last_number": "max(event_sequence)",
    "submitted_event_at": "min(CASE WHEN to_status = 'SUBMITTED' THEN event_timestamp END)",
    "terminal_event_at": f"min(CASE WHEN to_status IN {_TERMINAL} THEN event_timestamp END)",
    "failure_event_count": "count_if(event_outcome = 'FAILED')",
}
# Ordinary applications have their events sorted by session, where a session counts at its first event; that spares the
# extra aggregation levels of a distinct count. Hot ones use the distinct count, which spreads over sessions.
_SESSIONS_IN_ORDER = "count_if(session_id IS NOT NULL AND NOT (session_id <=> session_before))"
_SESSIONS = "count(DISTINCT session_id)"


def with_neighbours(events: DataFrame) -> skew.Split:
    """Events with the previous time and status by sequence, and the previous sequence by time.

    Both orders group by application, so ordinary applications need one shuffle and a local sort per order.
    """
    split = skew.split(events, "application_id")
    split = ordered.with_previous(
        split,
        BY_SEQUENCE,
        {
            "previous_timestamp": "event_timestamp",
            "previous_to_status": "to_status",
            "number_before": "event_sequence",
        },
    )
    return ordered.with_previous(split, BY_TIME, {"previous_sequence": "event_sequence"})


def event_history(events: DataFrame, unnumbered_is_latest: bool = False) -> DataFrame:
    """One row per application_id (NULL included).

    sequence_faults      events whose number does not exceed that of the event before in time
    timestamp_faults     events whose time does not exceed that of the event before in sequence
    status_breaks        events that do not start from the status the event before ended in
    after_terminal       events that follow a terminal status
    """
    latest = ordered.latest(BY_SEQUENCE, ["to_status", "step_name", "event_timestamp"], nulls_last=unnumbered_is_latest)

    def fold(df: DataFrame, sessions: str) -> DataFrame:
        counts = _FOLD | {"session_count": sessions}
        return df.groupBy("application_id").agg(
            latest.alias("latest"), *[F.expr(sql).alias(name) for name, sql in counts.items()]
        )

    split = with_neighbours(events.select(*_USED))
    by_session = ordered.with_previous(
        replace(split, hot=None), ["session_id"], {"session_before": "session_id"}
    )
    folded = fold(by_session.cold, _SESSIONS_IN_ORDER)
    return folded if split.hot is None else folded.unionByName(fold(split.hot, _SESSIONS))
