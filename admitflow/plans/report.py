"""Rule report over the raw extracts: every rule with PASS or FAIL, nothing stops early.

Values are read leniently, so an unreadable time counts as missing instead of raising.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from admitflow import session
from admitflow import vocabulary as V
from admitflow.functions import predicates as P
from admitflow.operators import counting
from admitflow.plans import staging
from admitflow.plans.history import event_history
from admitflow.sources.extracts import extract_paths, read_csv, total_bytes
from admitflow.sources.tables import Layer

SAMPLE_ROWS = 5


@dataclass(frozen=True)
class Extracts:
    """The three sources after ``staging.read_leniently``."""

    applicants: DataFrame
    applications: DataFrame
    events: DataFrame

    @classmethod
    def of(cls, raw: dict[str, DataFrame]) -> Extracts:
        return cls(*[staging.read_leniently(raw[source], source) for source in V.SOURCE_COLUMNS])

    @classmethod
    def landed(cls, layer: Layer, folder: str, line_breaks_in_fields: bool | None = None) -> Extracts:
        """The extracts of a folder, read once and stored in ``layer``; no later step reads the CSV files again."""
        spark = session.prepare(layer.spark)
        session.fit_shuffles(spark, total_bytes(spark, folder))

        def read(source: str, path: str) -> DataFrame:
            return staging.read_leniently(read_csv(spark, path, line_breaks_in_fields), source)

        paths = extract_paths(folder)
        stored = layer.write_all({source: partial(read, source, path) for source, path in paths.items()})
        return cls(*[stored[source] for source in V.SOURCE_COLUMNS])

    def table(self, source: str) -> DataFrame:
        return dict(zip(V.SOURCE_COLUMNS, (self.applicants, self.applications, self.events)))[source]

    def history(self) -> DataFrame:
        """Events per application; rows without an application belong to none."""
        read = self.events.filter(F.col("application_id").isNotNull()).select(
            *[c for c in V.SOURCE_COLUMNS["onboarding_events"] if c not in ("event_sequence", "event_timestamp")],
            F.col("event_sequence_read").alias("event_sequence"),
            F.col("event_timestamp_read").alias("event_timestamp"),
        )
        return event_history(read, unnumbered_is_latest=True)


ROW_RULES = {
    "applicants": {"applicants.applicant_type.accepted": P.outside("applicant_type", V.APPLICANT_TYPES)},
    "onboarding_applications": {
        "onboarding_applications.application_status.accepted": P.outside("application_status", V.APPLICATION_STATUSES),
        "onboarding_applications.decision.only_when_decided": "decision IS NOT NULL AND NOT "
        + P.within("application_status", V.DECIDED_STATUSES),
        "onboarding_applications.decision.present_when_decided": "decision IS NULL AND "
        + P.within("application_status", V.DECIDED_STATUSES),
        "onboarding_applications.submitted_at.present": "submitted_at_read IS NULL AND "
        + P.within("application_status", V.SUBMITTED_STATUSES),
        "onboarding_applications.completed_at.present": "completed_at_read IS NULL AND "
        + P.within("application_status", V.TERMINAL_STATUSES),
        "onboarding_applications.completed_at.absent": "completed_at_read IS NOT NULL AND NOT "
        + P.within("application_status", V.TERMINAL_STATUSES),
        "onboarding_applications.milestones.ordered": "submitted_at_read < started_at_read"
        " OR completed_at_read < coalesce(submitted_at_read, started_at_read)",
    },
    "onboarding_events": {
        "onboarding_events.event_outcome.accepted": P.outside("event_outcome", V.EVENT_OUTCOMES),
        "onboarding_events.event_metadata.json": f"NOT ({P.is_json('event_metadata')})",
    },
}


def row_rules(source: str) -> dict[str, str]:
    """Rules that look at one row, as conditions for a bad one."""
    required = {f"{source}.{c}.required": f"{c} IS NULL" for c in V.REPORT_REQUIRED[source]}
    return required | ROW_RULES[source]


# Rules that count applications whose events are in disorder.
HISTORY_RULES = {
    "onboarding_events.event_sequence.contiguous": "numbered_events > 0 AND NOT (first_number = 1"
    " AND last_number = numbered_events AND repeated_numbers = 0 AND fractional_numbers = 0)",
    "onboarding_events.event_timestamp.increasing": "undated_events > 0 OR timestamp_faults > 0",
}

LAST_STATE = "onboarding_applications.application_status.matches_last_event"


def last_state_mismatches(applications: DataFrame, history: DataFrame) -> DataFrame:
    """Applications without events, and submitted or finished ones whose last event ended elsewhere."""
    last = history.select(F.col("application_id").alias("__history_id"), F.col("latest.to_status").alias("__ended"))
    joined = applications.join(last, F.col("application_id") == F.col("__history_id"), "left")
    settled = P.within("application_status", ["SUBMITTED", *V.TERMINAL_STATUSES])
    elsewhere = "__ended IS NOT NULL AND NOT (__ended <=> application_status) AND NOT (__ended <=> current_step)"
    return joined.filter(f"__history_id IS NULL OR ({elsewhere} AND {settled})").drop("__history_id", "__ended")


def volume_counts(
    source: str, min_rows: dict[str, int] | None = None, min_days: int = V.MIN_EVENT_SPAN_DAYS
) -> dict[str, str]:
    """Row count and event span as aggregates: what is missing to the minimum."""
    floor = V.MIN_ROWS if min_rows is None else min_rows
    counts = {f"{source}.row_count.minimum": f"greatest({floor[source]} - count(*), 0)"}
    if source == "onboarding_events":
        # Without any readable time the span is unknown, which fails whatever the minimum.
        at = "event_timestamp_read"
        counts["onboarding_events.event_timestamp.span"] = (
            f"CASE WHEN count({at}) = 0 THEN {max(min_days, 1)}"
            f" ELSE greatest({min_days} - timestampdiff(DAY, min({at}), max({at})), 0) END"
        )
    return counts


def volume_rules(
    extracts: Extracts, min_rows: dict[str, int] | None = None, min_days: int = V.MIN_EVENT_SPAN_DAYS
) -> DataFrame:
    return counting.union(
        [
            counting.counted(extracts.table(source), volume_counts(source, min_rows, min_days))
            for source in V.SOURCE_COLUMNS
        ]
    )


def figures(extracts: Extracts) -> DataFrame:
    """(source, row_count, span_days, first_date, last_date): what the volume rules judge; no span where no time is."""
    frames = []
    for source in V.SOURCE_COLUMNS:
        at = F.col("event_timestamp_read") if source == "onboarding_events" else F.lit(None).cast("timestamp")
        counted = extracts.table(source).agg(F.count("*").alias("row_count"), F.min(at).alias("a"), F.max(at).alias("b"))
        frames.append(
            counted.select(
                F.lit(source).alias("source"),
                "row_count",
                F.expr("timestampdiff(DAY, a, b)").alias("span_days"),
                F.to_date("a").alias("first_date"),
                F.to_date("b").alias("last_date"),
            )
        )
    return counting.union(frames)


REFERENCES = {
    "onboarding_applications.applicant_id.exists": ("onboarding_applications", "applicant_id", "applicants"),
    "onboarding_events.application_id.exists": (
        "onboarding_events",
        "application_id",
        "onboarding_applications",
    ),
}


def report(
    extracts: Extracts,
    history: DataFrame | None = None,
    min_rows: dict[str, int] | None = None,
    min_days: int = V.MIN_EVENT_SPAN_DAYS,
) -> DataFrame:
    """(check_name, status, bad_count) for all rules. Pass a stored ``history`` to fold the events only once."""
    if history is None:
        history = extracts.history()
    frames = []
    for source, key in V.PRIMARY_KEYS.items():
        table = extracts.table(source)
        frames.append(counting.duplicate_rows(table, key, f"{source}.{key}.unique"))
        rules = counting.row_counts(row_rules(source)) | volume_counts(source, min_rows, min_days)
        frames.append(counting.counted(table, rules))
    for name, (child, key, parent) in REFERENCES.items():
        frames.append(counting.orphans(extracts.table(child), key, extracts.table(parent), key, name))
    frames.append(counting.failing_rows(history, HISTORY_RULES))
    frames.append(counting.counted(last_state_mismatches(extracts.applications, history), {LAST_STATE: "count(*)"}))
    return with_status(counting.union(frames))


def with_status(checks: DataFrame) -> DataFrame:
    status = F.when(F.col("bad_count") > 0, F.lit("FAIL")).otherwise(F.lit("PASS"))
    return checks.select("check_name", status.alias("status"), "bad_count")


def totals(checks: DataFrame) -> DataFrame:
    """One row: passed, failed, total."""
    passed = F.col("status") == "PASS"
    return checks.agg(
        F.count_if(passed).alias("passed"), F.count_if(~passed).alias("failed"), F.count("*").alias("total")
    )


def offending(
    extracts: Extracts, check_name: str, history: DataFrame | None = None, table: DataFrame | None = None
) -> DataFrame:
    """All rows that break one rule. Rules on the event order give one row per application.

    A ``table`` given stands for the rule's own one; a rule on repeated keys needs all rows of the keys in it.
    """
    source = check_name.split(".")[0]
    table = extracts.table(source) if table is None else table
    if check_name in HISTORY_RULES:
        folded = extracts.history() if history is None else history
        return folded.filter(HISTORY_RULES[check_name]).select("application_id")
    if check_name == LAST_STATE:
        return last_state_mismatches(table, extracts.history() if history is None else history)
    if check_name in REFERENCES:
        child, key, parent = REFERENCES[check_name]
        parents = extracts.table(parent).select(F.col(key).alias("__parent"))
        return table.join(parents, F.col(key) == F.col("__parent"), "left_anti")
    if check_name == f"{source}.{V.PRIMARY_KEYS[source]}.unique":
        key = V.PRIMARY_KEYS[source]
        repeated = counting.key_sizes(table, key).filter("n > 1").select(F.col("key").alias("__repeated"))
        return table.join(repeated, F.col(key).eqNullSafe(F.col("__repeated")), "left_semi")
    return table.filter(row_rules(source)[check_name])


# Rules that judge a table as a whole; no row offends against them.
WHOLE_TABLE = ("minimum", "span")


def examples(
    extracts: Extracts, check_names: list[str], history: DataFrame | None = None, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(check_name, place, key, offender): the first few offending rows of each rule by key, as JSON, in one job.

    A first look reads only what a rule judges and finds the first few keys that break it: no task sorts or moves whole
    rows, however many offend. Then the rows of these keys are fetched and judged, those of all row rules of a table in
    one scan. Each task keeps the first few of a rule before anything is shuffled, so what meets in one task is a few
    rows from every other one.
    """
    if history is None and any(name in HISTORY_RULES or name == LAST_STATE for name in check_names):
        history = extracts.history()
    frames, left = [], [name for name in check_names if name.split(".")[-1] not in WHOLE_TABLE]
    for source, key in V.PRIMARY_KEYS.items():
        rules = {name: rule for name, rule in row_rules(source).items() if name in left}
        if rules:
            table = extracts.table(source)
            keys = counting.union([_first_keys(table.filter(rule), key, rows) for rule in rules.values()])
            broken = F.array_compact(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in rules.items()]))
            frames.append(_first_of_each(_having(table, key, keys), key, F.explode(broken), rows))
            left = [name for name in left if name not in rules]
    for name in left:
        source = name.split(".")[0]
        bad, key, table = offending(extracts, name, history), V.PRIMARY_KEYS[source], extracts.table(source)
        if key in bad.columns:
            if name == f"{source}.{key}.unique":
                bad = counting.key_sizes(table, key).filter("n > 1").withColumnRenamed("key", key)
            bad = offending(extracts, name, history, _having(table, key, _first_keys(bad, key, rows)))
        else:
            key, bad = "application_id", _first_keys(bad, "application_id", rows)
        frames.append(_first_of_each(bad, key, F.lit(name), rows))
    if not frames:
        return extracts.events.sparkSession.createDataFrame([], "check_name string, place int, key string, offender string")
    return counting.union(frames)


def _first_keys(bad: DataFrame, key: str, rows: int) -> DataFrame:
    """The keys of the first few offenders. Each task holds no more than so many."""
    return bad.select(key).orderBy(F.col(key).asc_nulls_last()).limit(rows)


def _having(table: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """All rows of ``table`` with one of the ``keys``, a few per rule."""
    wanted = F.broadcast(keys.select(F.col(key).alias("__wanted")))
    return table.join(wanted, F.col(key).eqNullSafe(F.col("__wanted")), "left_semi")


def _first_of_each(bad: DataFrame, key: str, check: Column, rows: int) -> DataFrame:
    named = bad.select(check.alias("check_name"), F.col(key).alias("key"), F.struct("*").alias("row"))
    by_key = Window.partitionBy("check_name").orderBy(F.col("key").asc_nulls_last(), "row")
    placed = named.withColumn("place", F.row_number().over(by_key)).where(F.col("place") <= rows)
    return placed.select(
        "check_name", "place", "key", F.to_json("row", {"ignoreNullFields": "false"}).alias("offender")
    )


def sample(bad: DataFrame, key: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The first few offending rows by key."""
    return bad.orderBy(F.col(key).asc_nulls_last()).limit(rows)
