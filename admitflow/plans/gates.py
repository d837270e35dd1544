"""The two gates of the flow: staged tables before modelling, marts before export.

A gate is one DataFrame (check_name, bad_count); ``enforce`` turns it into an error that lists every violated check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from admitflow import vocabulary as V
from admitflow.functions import predicates as P
from admitflow.operators import counting
from admitflow.plans.history import event_history


class DataQualityError(Exception):
    def __init__(self, failures: dict[str, int]):
        self.failures = failures
        lines = [f"{name}: {count} rows" for name, count in failures.items()]
        super().__init__("violated checks\n  " + "\n  ".join(lines))


def enforce(checks: DataFrame) -> None:
    """Run every check, then raise if any of them counted bad rows."""
    bad = checks.filter("bad_count > 0").orderBy("check_name").collect()
    if bad:
        raise DataQualityError({row["check_name"]: row["bad_count"] for row in bad})


APPLICANT_RULES = {
    "applicant_type_accepted": P.outside("applicant_type", V.APPLICANT_TYPES),
    "applicants_required": P.any_null(V.STAGED_REQUIRED["applicants"]),
}

APPLICATION_RULES = {
    "application_status_accepted": P.outside("application_status", V.APPLICATION_STATUSES),
    "application_type_accepted": P.outside("application_type", V.APPLICATION_TYPES),
    "source_channel_accepted": P.outside("source_channel", V.SOURCE_CHANNELS),
    "device_type_accepted": P.outside("device_type", V.DEVICE_TYPES),
    "decision_only_when_decided": "decision IS NOT NULL AND " + P.outside("application_status", V.DECIDED_STATUSES),
    "applications_required": P.any_null(V.STAGED_REQUIRED["onboarding_applications"]),
    "milestones_in_order": "least(submitted_at, completed_at, updated_at) < started_at OR completed_at < submitted_at",
}

_ALLOWED = " OR ".join(f"(from_status <=> '{a}' AND to_status <=> '{b}')" for a, b in V.TRANSITIONS)

EVENT_RULES = {
    "event_outcome_accepted": P.outside("event_outcome", V.EVENT_OUTCOMES),
    "event_type_accepted": P.outside("event_type", V.EVENT_TYPES),
    "event_metadata_json": f"NOT ({P.is_json('event_metadata')})",
    "events_required": P.any_null(V.STAGED_REQUIRED["onboarding_events"]),
    "first_event_creates": "event_sequence = 1 AND NOT (event_type = 'APPLICATION_CREATED'"
    " AND from_status IS NULL AND to_status = 'STARTED')",
    # A status change with an unknown side is not an allowed one.
    "transition_allowed": f"event_sequence > 1 AND NOT ({_ALLOWED})",
}

HISTORY_COUNTS = {
    "event_sequence_increases": "sum(sequence_faults)",
    "event_timestamp_increases": "sum(timestamp_faults)",
    "from_status_continues": "sum(status_breaks)",
    "nothing_after_terminal": "sum(after_terminal)",
}

# Conditions on an application joined with its history.
LATEST_STATE_RULES = {
    "state_matches_latest_event": "NOT (application_status = latest.to_status AND current_step = latest.step_name"
    " AND updated_at = latest.event_timestamp)",
    "milestones_match_events": "NOT (submitted_at <=> submitted_event_at AND completed_at <=> terminal_event_at)",
}


def history_faults(history: DataFrame) -> DataFrame:
    return counting.counted(history, HISTORY_COUNTS)


def latest_state_faults(applications: DataFrame, history: DataFrame) -> DataFrame:
    """Applications that disagree with their own events. Those without any event are not looked at here."""
    known = history.select("application_id", "latest", "submitted_event_at", "terminal_event_at")
    return counting.failing_rows(applications.join(known, "application_id"), LATEST_STATE_RULES)


def event_orphans(history: DataFrame, applications: DataFrame) -> DataFrame:
    sizes = history.select(F.col("application_id").alias("key"), F.col("event_count").alias("n"))
    lost = counting.without_parent(sizes, applications, "application_id")
    return counting.counted(lost, {"event_application_exists": "sum(n)"})


def staging_gate(
    applicants: DataFrame, applications: DataFrame, events: DataFrame, history: DataFrame | None = None
) -> DataFrame:
    """All checks on the staged tables. Pass a stored ``history`` to have the events folded only once."""
    if history is None:
        history = event_history(events)
    return counting.union(
        [
            counting.duplicate_groups(applicants, "applicant_id", "applicant_id_unique"),
            counting.duplicate_groups(applications, "application_id", "application_id_unique"),
            counting.duplicate_groups(events, "event_id", "event_id_unique"),
            counting.orphans(applications, "applicant_id", applicants, "applicant_id", "application_applicant_exists"),
            event_orphans(history, applications),
            counting.failing_rows(applicants, APPLICANT_RULES),
            counting.failing_rows(applications, APPLICATION_RULES),
            counting.failing_rows(events, EVENT_RULES),
            history_faults(history),
            latest_state_faults(applications, history),
        ]
    )


def row_count_gap(left: DataFrame, right: DataFrame, name: str) -> DataFrame:
    signed = left.selectExpr("count(*) AS n").unionByName(right.selectExpr("-count(*) AS n"))
    return counting.counted(signed, {name: "abs(sum(n))"})


def key_repeats(dimensions: dict[str, DataFrame], name: str) -> DataFrame:
    """Surplus rows per key, over all dimensions given as key column -> table."""
    repeats = [d.selectExpr(f"count(*) - count(DISTINCT {key}) AS n") for key, d in dimensions.items()]
    return counting.counted(counting.union(repeats), {name: "sum(n)"})


def unmatched_keys(fact: DataFrame, keys: list[str], dimension: DataFrame, key: str) -> DataFrame:
    """Count of fact rows with a filled key that the dimension lacks, as one column n.

    Rows are first counted per combination of keys; each key then needs one join of its own.
    """
    combos = fact.groupBy(*keys).agg(F.count("*").alias("rows"))
    for i, name in enumerate(keys):
        known = dimension.select(F.col(key).alias(f"__known{i}")).distinct()
        combos = combos.join(known, F.col(name) == F.col(f"__known{i}"), "left")
    lost = " OR ".join(f"({name} IS NOT NULL AND __known{i} IS NULL)" for i, name in enumerate(keys))
    return combos.selectExpr(f"coalesce(sum(CASE WHEN {lost} THEN rows END), 0) AS n")


def date_key_faults(event_fact: DataFrame, snapshot: DataFrame, dim_date: DataFrame) -> DataFrame:
    snapshot_keys = ["started_date_key", "submitted_date_key", "completed_date_key"]
    both = unmatched_keys(event_fact, ["date_key"], dim_date, "date_key").unionByName(
        unmatched_keys(snapshot, snapshot_keys, dim_date, "date_key")
    )
    return counting.counted(both, {"date_key_exists": "sum(n)"})


def application_key_faults(event_fact: DataFrame, dim_application: DataFrame) -> DataFrame:
    filled = event_fact.filter(F.col("application_key") != V.UNKNOWN_KEY)
    return counting.orphans(
        filled, "application_key", dim_application, "application_key", "event_application_key_exists"
    )


def marts_gate(
    dim_date: DataFrame,
    dim_channel: DataFrame,
    dim_applicant: DataFrame,
    dim_application: DataFrame,
    event_fact: DataFrame,
    snapshot: DataFrame,
    applications: DataFrame,
    events: DataFrame,
) -> DataFrame:
    """All checks on the marts; ``applications`` and ``events`` are the staged tables the facts come from."""
    dimensions = {
        "applicant_key": dim_applicant,
        "application_key": dim_application,
        "channel_key": dim_channel,
        "date_key": dim_date,
    }
    return counting.union(
        [
            counting.duplicate_groups(snapshot, "application_id", "snapshot_application_unique"),
            application_key_faults(event_fact, dim_application),
            row_count_gap(snapshot, applications, "snapshot_rows_match_staging"),
            counting.failing_rows(snapshot, {"seconds_to_complete_not_negative": "seconds_to_complete < 0"}),
            counting.duplicate_groups(event_fact, "event_id", "event_fact_event_unique"),
            row_count_gap(event_fact, events, "event_fact_rows_match_staging"),
            key_repeats(dimensions, "dimension_keys_unique"),
            date_key_faults(event_fact, snapshot, dim_date),
        ]
    )


def extra_checks(
    applications: DataFrame, event_fact: DataFrame, snapshot: DataFrame, dim_application: DataFrame
) -> DataFrame:
    """Checks that follow from the description of the model but belong to neither gate."""
    filled = snapshot.filter(F.col("application_key") != V.UNKNOWN_KEY)
    return counting.union(
        [
            counting.failing_rows(applications, {"updated_not_before_completed": "updated_at < completed_at"}),
            counting.failing_rows(snapshot, {"seconds_to_submit_not_negative": "seconds_to_submit < 0"}),
            counting.failing_rows(event_fact, {"seconds_since_prev_not_negative": "seconds_since_prev_event < 0"}),
            counting.orphans(
                filled, "application_key", dim_application, "application_key", "snapshot_application_key_exists"
            ),
        ]
    )
