"""One query per operator or operator group, over the driver's tables or tables Spark derives from them."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from admitflow import session
from admitflow import vocabulary as V
from admitflow.functions import predicates as P
from admitflow.functions import scalars as X
from admitflow.operators import counting, keys, ordered, skew
from admitflow.plans import dimensions, facts, flow, gates, outcomes, report
from admitflow.plans.history import event_history
from admitflow.sources import extracts
from admitflow.sources.tables import Layer, export
from workload.standins import StandIns

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[StandIns], DataFrame]) -> Callable[[StandIns], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(StandIns(session.prepare(spark), sf_dir))

    QUERIES[build.__name__] = run
    return build


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table that several parts of a query read, as the flow does between its steps."""
    return Layer(df.sparkSession, session.scratch_path(df.sparkSession, "tables")).write(name, df)


def spread(df: DataFrame, rows_per_task: int) -> DataFrame:
    """The rows dealt over tasks by their number: few bytes are few splits, whatever is then made from each row."""
    return df.repartition(max(1, math.ceil(df.count() / rows_per_task)))


# --- staging and sources ---


@query
def staging_applicants(s: StandIns) -> DataFrame:
    return s.applicants


@query
def staging_typed(s: StandIns) -> DataFrame:
    return s.applications


@query
def staging_events(s: StandIns) -> DataFrame:
    return s.events


@query
def lenient_parse(s: StandIns) -> DataFrame:
    return s.extracts.events.select("event_id", "event_sequence_read", "event_timestamp_read")


@query
def csv_ingest(s: StandIns) -> DataFrame:
    path = session.scratch_path(s.spark, "extract")
    raw = s.raw()["onboarding_events"]
    raw.write.option("header", True).option("escape", '"').csv(path)
    return extracts.read_csv(s.spark, path)


@query
def csv_line_breaks(s: StandIns) -> DataFrame:
    """Events whose metadata goes on over line ends, read back from CSV files that are split inside records."""
    path = session.scratch_path(s.spark, "extract")
    raw = s.raw()["onboarding_events"]
    broken = raw.withColumn("event_metadata", F.concat("event_metadata", F.lit(',\n"'), "event_id", F.lit('"\r\n\n.')))
    broken.write.option("header", True).option("escape", '"').csv(path)
    return extracts.read_csv(s.spark, path).select("event_id", "to_status", "event_metadata")


@query
def ingest_counts(s: StandIns) -> DataFrame:
    """The rows per table after the ingest of all three sources, counted in the stored tables."""
    source, warehouse = (session.scratch_path(s.spark, name) for name in ("extracts", "warehouse"))
    for name, raw in s.raw().items():
        raw.write.option("header", True).option("escape", '"').csv(f"{source}/{name}.csv")
    ingested = flow.Flow(s.spark, source, warehouse, warehouse)
    ingested.ingest_raw()
    return counting.union(
        [
            ingested.layer("raw").read(name).agg(F.lit(name).alias("source"), F.count("*").alias("row_count"))
            for name in V.SOURCE_COLUMNS
        ]
    )


@query
def report_figures(s: StandIns) -> DataFrame:
    """Rows, span and dates of the untidy raw tables."""
    return report.figures(_stored_extracts(s))


@query
def parquet_export(s: StandIns) -> DataFrame:
    path = session.scratch_path(s.spark, "funnel")
    export(_funnel(s), path)
    return s.spark.read.parquet(path)


# --- dimensions ---


@query
def calendar_dim(s: StandIns) -> DataFrame:
    return dimensions.calendar(s.table("lineitem"), "l_shipdate")


@query
def channel_dim(s: StandIns) -> DataFrame:
    return dimensions.conformed_channels(s.applicants, s.applications, s.events)


@query
def applicant_dim(s: StandIns) -> DataFrame:
    return dimensions.applicants(s.applicants)


@query
def application_dim(s: StandIns) -> DataFrame:
    return dimensions.applications(s.applications)


# --- facts ---


EVENT_LOOKUPS = ["dim_application", "dim_channel"]
SNAPSHOT_LOOKUPS = [*EVENT_LOOKUPS, "dim_applicant"]
ALL_DIMENSIONS = [*SNAPSHOT_LOOKUPS, "dim_date"]


def _dimensions(s: StandIns, events: DataFrame, names: list[str]) -> dict[str, DataFrame]:
    """The named dimensions, stored as in the flow."""
    builds = dimensions.all_dimensions(s.applicants, s.applications, events)
    layer = Layer(s.spark, session.scratch_path(s.spark, "dimensions"))
    return layer.write_all({name: builds[name] for name in names})


def _event_fact(s: StandIns, events: DataFrame) -> DataFrame:
    dims = _dimensions(s, events, EVENT_LOOKUPS)
    return facts.event_fact(events, dims["dim_application"], dims["dim_channel"])


def _snapshot(s: StandIns, events: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    return facts.application_snapshot(
        s.applications, event_history(events), dims["dim_application"], dims["dim_applicant"], dims["dim_channel"]
    )


@query
def event_fact(s: StandIns) -> DataFrame:
    return _event_fact(s, s.events)


@contextmanager
def _small_limits(df: DataFrame, parts: int = 20) -> Iterator[DataFrame]:
    """Limits at which ``df`` takes the paths of large tables. The operators read them while a plan is built."""
    conf, limit = df.sparkSession.conf, str(max(df.count() // parts, 1))
    for name in (skew.HOT_ROWS_CONF, keys.PIECE_ROWS_CONF):
        conf.set(name, limit)
    try:
        yield df
    finally:
        for name in (skew.HOT_ROWS_CONF, keys.PIECE_ROWS_CONF):
            conf.unset(name)


@query
def event_fact_in_pieces(s: StandIns) -> DataFrame:
    """The event fact with a hot application and many events without one; dimensions numbered in pieces."""
    with _small_limits(store(s.skewed_lines, "skewed_lines")) as lines:
        return _event_fact(s, lines)


@query
def application_dim_in_pieces(s: StandIns) -> DataFrame:
    with _small_limits(store(s.applications, "applications")) as applications:
        return dimensions.applications(applications)


@query
def event_history_in_pieces(s: StandIns) -> DataFrame:
    """Order faults where an application and the missing application are hot."""
    with _small_limits(store(s.skewed_lines, "skewed_lines")) as lines:
        return gates.history_faults(event_history(lines))


@query
def event_fact_gap(s: StandIns) -> DataFrame:
    """Gaps in the driver's event stream; its users are no applications, so every lookup falls back to -1."""
    return _event_fact(s, s.clicks)


@query
def application_snapshot(s: StandIns) -> DataFrame:
    return _snapshot(s, s.events, _dimensions(s, s.events, SNAPSHOT_LOOKUPS))


@query
def snapshot_of_crowded_applicants(s: StandIns) -> DataFrame:
    """The snapshot where one applicant has a third of all applications and many have no applicant."""
    dims = _dimensions(s, s.events, SNAPSHOT_LOOKUPS)
    with _small_limits(store(s.crowded_applications, "applications")) as applications:
        return facts.application_snapshot(
            applications, event_history(s.events), dims["dim_application"], dims["dim_applicant"], dims["dim_channel"]
        )


@query
def order_line_snapshot(s: StandIns) -> DataFrame:
    """Snapshot with order lines as events: some orders have none and must show zero, not NULL."""
    return _snapshot(s, s.lines, _dimensions(s, s.lines, SNAPSHOT_LOOKUPS))


# --- outputs ---


def _funnel(s: StandIns) -> DataFrame:
    dims = _dimensions(s, s.events, ALL_DIMENSIONS)
    snapshot = _snapshot(s, s.events, dims)
    return outcomes.funnel(snapshot, dims["dim_application"], dims["dim_date"], dims["dim_channel"])


@query
def funnel_by_date_channel(s: StandIns) -> DataFrame:
    return _funnel(s)


@query
def funnel_on_checked_grain(s: StandIns) -> DataFrame:
    """The cheaper form for a snapshot known to have one row per application."""
    dims = _dimensions(s, s.events, ALL_DIMENSIONS)
    cube = outcomes.outcome_cube(_snapshot(s, s.events, dims), dims["dim_application"])
    return outcomes.funnel_from_cube(cube, dims["dim_date"], dims["dim_channel"])


@query
def duration_failure_by_channel(s: StandIns) -> DataFrame:
    dims = _dimensions(s, s.events, SNAPSHOT_LOOKUPS)
    return outcomes.durations(_snapshot(s, s.events, dims), dims["dim_application"], dims["dim_channel"])


@query
def step_time(s: StandIns) -> DataFrame:
    return outcomes.step_times(_event_fact(s, s.clicks))


# --- order of events ---


@query
def latest_event(s: StandIns) -> DataFrame:
    """Latest event per user, folded before the shuffle."""
    row = ordered.latest(["event_sequence"], ["event_id", "event_type", "event_timestamp"])
    return s.clicks.groupBy("application_id").agg(row.alias("latest")).select("application_id", "latest.*")


@query
def previous_event(s: StandIns) -> DataFrame:
    """Previous time, status and number for every order line."""
    split = skew.split(s.lines, "application_id")
    split = ordered.with_previous(
        split,
        ["event_sequence", "event_timestamp", "event_id"],
        {"previous_timestamp": "event_timestamp", "previous_to_status": "to_status"},
    )
    split = ordered.with_previous(
        split, ["event_timestamp", "event_sequence", "event_id"], {"previous_sequence": "event_sequence"}
    )
    return split.union().select("event_id", "previous_timestamp", "previous_to_status", "previous_sequence")


@query
def milestones(s: StandIns) -> DataFrame:
    return event_history(s.lines).select(
        "application_id", "event_count", "submitted_event_at", "terminal_event_at"
    )


@query
def sequence_check(s: StandIns) -> DataFrame:
    return gates.history_faults(event_history(s.lines))


@query
def contiguity_check(s: StandIns) -> DataFrame:
    return counting.failing_rows(event_history(s.lines), report.HISTORY_RULES)


@query
def first_event_check(s: StandIns) -> DataFrame:
    name = "first_event_creates"
    return counting.failing_rows(s.events, {name: gates.EVENT_RULES[name]})


@query
def transition_check(s: StandIns) -> DataFrame:
    name = "transition_allowed"
    rules = counting.failing_rows(s.clicks, {name: gates.EVENT_RULES[name]})
    return rules.unionByName(gates.history_faults(event_history(s.clicks)).filter("check_name LIKE 'from%'"))


@query
def terminal_check(s: StandIns) -> DataFrame:
    return gates.history_faults(event_history(s.clicks)).filter("check_name = 'nothing_after_terminal'")


# --- state against events ---


@query
def latest_state_check(s: StandIns) -> DataFrame:
    history = store(event_history(s.lines).select("application_id", *_STATE), "history")
    strict = gates.latest_state_faults(s.applications, history)
    soft = report.last_state_mismatches(s.applications, history)
    return strict.unionByName(counting.counted(soft, {report.LAST_STATE: "count(*)"}))


_STATE = ["event_count", "latest", "submitted_event_at", "terminal_event_at"]


@query
def status_rule_check(s: StandIns) -> DataFrame:
    rules = report.ROW_RULES["onboarding_applications"]
    chosen = {name: rule for name, rule in rules.items() if "decision" in name or "_at." in name}
    return counting.failing_rows(s.extracts.applications, chosen)


@query
def milestone_order_check(s: StandIns) -> DataFrame:
    lines = event_history(s.lines).select(F.col("application_id").alias("line_of"), "terminal_event_at")
    shipped = s.applications.join(lines, F.col("application_id") == F.col("line_of"), "left")
    name = "milestones_in_order"
    raw_name = "onboarding_applications.milestones.ordered"
    return counting.union(
        [
            counting.failing_rows(s.applications, {name: gates.APPLICATION_RULES[name]}),
            counting.failing_rows(s.extracts.applications, {raw_name: report.row_rules(raw_name.split(".")[0])[raw_name]}),
            counting.failing_rows(
                shipped.select(X.seconds_between(F.col("started_at"), F.col("terminal_event_at")).alias("seconds")),
                {"seconds_to_last_line_not_negative": "seconds < 0"},
            ),
        ]
    )


# --- keys, values, fields ---


@query
def uniqueness_check(s: StandIns) -> DataFrame:
    lines = s.table("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("line"))
    key = {"line_key": lines.withColumnRenamed("line", "line_key")}
    return counting.union(
        [
            counting.duplicate_groups(lines, "line", "line_groups"),
            counting.duplicate_rows(lines, "line", "line_rows"),
            gates.key_repeats(key, "line_surplus"),
            counting.duplicate_groups(s.events, "event_id", "event_id_unique"),
        ]
    )


@query
def orphan_check(s: StandIns) -> DataFrame:
    orders, lines = s.table("orders"), s.table("lineitem")
    return counting.union(
        [
            counting.orphans(orders, "o_orderkey", lines, "l_orderkey", "orders_without_lines"),
            counting.orphans(lines, "l_orderkey", orders, "o_orderkey", "lines_without_order"),
            counting.orphans(s.events, "application_id", s.applications, "application_id", "events_without_parent"),
        ]
    )


@query
def accepted_values_check(s: StandIns) -> DataFrame:
    return counting.union(
        [
            counting.failing_rows(s.table("orders"), {"order_status": P.outside("o_orderstatus", ["F", "O"])}),
            counting.failing_rows(s.table("events"), {"event_type": P.outside("event_type", ["signup", "view"])}),
            counting.failing_rows(s.table("lineitem"), {"return_flag": P.outside("l_returnflag", ["A", "N"])}),
        ]
    )


@query
def required_fields_check(s: StandIns) -> DataFrame:
    x = s.extracts
    frames = []
    for source in V.SOURCE_COLUMNS:
        rules = {name: rule for name, rule in report.row_rules(source).items() if name.endswith(".required")}
        frames.append(counting.failing_rows(x.table(source), rules))
    return counting.union(frames)


@query
def json_validity_check(s: StandIns) -> DataFrame:
    """The driver's properties as they are, and each with a fault made from it."""
    variants = {
        "as_is": "props",
        "text_after": "concat(props, ' x')",
        "cut_off": "substring(props, 1, length(props) - 1)",
        "two_values": "concat(props, props)",
        "closes_wrapper": "concat(props, '],[', props)",
        "in_list": "concat('[', props, ', null]')",
    }
    texts = [
        s.table("events").selectExpr("event_id", f"'{name}' AS variant", f"{sql} AS text")
        for name, sql in variants.items()
    ]
    return counting.union(texts).selectExpr("event_id", "variant", f"{P.is_json('text')} AS valid")


@query
def json_limits_check(s: StandIns) -> DataFrame:
    """Every customer as JSON beyond a parser's usual limits on depth and length, sound and with a fault."""
    variants = {
        "deep": "concat(repeat('[', 1010), '\"', c_name, '\"', repeat(']', 1010))",
        "deep_open": "concat(repeat('[', 1010), '\"', c_name, '\"', repeat(']', 1009))",
        "deep_objects": "concat(repeat('{\"a\":', 1010), c_custkey, repeat('}', 1010))",
        "long_number": "concat(c_custkey, repeat('7', 1010))",
        "long_no_number": "concat(c_custkey, repeat('7', 1010), '.')",
    }
    made = ", ".join(f"struct('{name}' AS variant, {sql} AS text)" for name, sql in variants.items())
    texts = spread(s.table("customer").select("c_custkey", "c_name"), 2000).selectExpr(
        "c_custkey", f"inline(array({made}))"
    )
    return texts.selectExpr("c_custkey", "variant", f"{P.is_json('text')} AS valid")


@query
def time_text_parse(s: StandIns) -> DataFrame:
    """Every order's date written in other ways and read again."""
    date = F.col("o_orderdate")
    return s.table("orders").select(
        "o_orderkey",
        X.strict_timestamp(F.date_format(date, "yyyy/MM/dd HH:mm:ss")).alias("slashes"),
        X.strict_timestamp(F.concat(F.lit("  "), F.date_format(date, "yyyy-M-d"))).alias("blanks"),
        X.lenient_timestamp(F.date_format(date, "yyyyMMdd")).alias("digits"),
        X.lenient_timestamp(F.date_format(date, "MM/dd/yyyy")).alias("month_first"),
        X.lenient_timestamp(F.date_format(date, "yyyy")).alias("year_only"),
    )


@query
def number_text_parse(s: StandIns) -> DataFrame:
    """Every order's key as text that is a number, and as text that only a programming language reads."""
    key = F.col("o_orderkey").cast("string")
    return s.table("orders").select(
        "o_orderkey",
        X.lenient_number(F.concat(F.lit(" "), key, F.lit(" "))).alias("blanks"),
        X.lenient_number(F.concat(key, F.lit(".5e1"))).alias("exponent"),
        X.lenient_number(F.concat(key, F.lit("d"))).alias("suffix_d"),
        X.lenient_number(F.concat(key, F.lit("f"))).alias("suffix_f"),
        X.lenient_number(F.concat(F.lit("0x"), key, F.lit("p1"))).alias("hex"),
    )


@query
def offending_sample(s: StandIns) -> DataFrame:
    x = s.extracts
    bad = report.offending(x, "onboarding_events.event_outcome.accepted")
    return report.sample(bad, "event_id").select("event_id", "application_id", "event_outcome")


@query
def offenders_by_rule(s: StandIns) -> DataFrame:
    """The first five offenders of every rule, broken or not, from one job."""
    x = _stored_extracts(s)
    names = [name for source in V.SOURCE_COLUMNS for name in report.row_rules(source)]
    names += [f"{source}.{key}.unique" for source, key in V.PRIMARY_KEYS.items()]
    names += [*report.REFERENCES, *report.HISTORY_RULES, report.LAST_STATE]
    return report.examples(x, names, store(x.history(), "event_history")).drop("offender")


@query
def offending_references(s: StandIns) -> DataFrame:
    bad = report.offending(s.extracts, "onboarding_applications.applicant_id.exists")
    return bad.select("application_id", "applicant_id")


@query
def rowcount_check(s: StandIns) -> DataFrame:
    orders, lines = s.table("orders"), s.table("lineitem")
    return gates.row_count_gap(lines, orders, "row_gap").unionByName(report.volume_rules(s.extracts))


@query
def date_key_check(s: StandIns) -> DataFrame:
    """Order days against the calendar of shipping days."""
    calendar = dimensions.calendar(s.table("lineitem"), "l_shipdate")
    orders = s.table("orders").select(X.date_key(F.col("o_orderdate")).alias("ordered"))
    lines = s.table("lineitem").select(X.date_key(F.col("l_shipdate")).alias("shipped"))
    return counting.union(
        [
            counting.counted(gates.unmatched_keys(orders, ["ordered"], calendar, "date_key"), {"ordered": "sum(n)"}),
            counting.counted(gates.unmatched_keys(lines, ["shipped"], calendar, "date_key"), {"shipped": "sum(n)"}),
        ]
    )


# --- whole gates, on stored tables as in the flow ---


def _stored_staging(s: StandIns) -> list[DataFrame]:
    layer = Layer(s.spark, session.scratch_path(s.spark, "staging"))
    builds = {"applicants": s.applicants, "applications": s.applications, "events": s.events}
    return list(layer.write_all({name: lambda df=df: df for name, df in builds.items()}).values())


def _stored_extracts(s: StandIns) -> report.Extracts:
    layer = Layer(s.spark, session.scratch_path(s.spark, "raw"))
    return report.Extracts.of(layer.write_all({name: lambda df=df: df for name, df in s.raw(untidy=True).items()}))


@query
def staging_gate(s: StandIns) -> DataFrame:
    """All 26 checks on the staged tables."""
    applicants, applications, events = _stored_staging(s)
    history = store(event_history(events).select(*flow.STORED_HISTORY), "event_history")
    return gates.staging_gate(applicants, applications, events, history)


@query
def marts_gate(s: StandIns) -> DataFrame:
    """All 8 checks on stored marts."""
    applicants, applications, events = _stored_staging(s)
    layer = Layer(s.spark, session.scratch_path(s.spark, "marts"))
    dims = layer.write_all(dimensions.all_dimensions(applicants, applications, events))
    application, channel = dims["dim_application"], dims["dim_channel"]
    stored = layer.write_all(
        {
            "event_fact": lambda: facts.event_fact(events, application, channel),
            "snapshot": lambda: facts.application_snapshot(
                applications, event_history(events), application, dims["dim_applicant"], channel
            ),
        }
    )
    return gates.marts_gate(**dims, **stored, applications=applications, events=events)


@query
def extra_checks(s: StandIns) -> DataFrame:
    dims = _dimensions(s, s.events, ALL_DIMENSIONS)
    application = dims["dim_application"]
    fact = facts.event_fact(s.events, application, dims["dim_channel"])
    return gates.extra_checks(s.applications, fact, _snapshot(s, s.events, dims), application)


@query
def quality_report(s: StandIns) -> DataFrame:
    """All 35 rules on the untidy raw tables."""
    x = _stored_extracts(s)
    return report.report(x, store(x.history(), "event_history"))


@query
def report_totals(s: StandIns) -> DataFrame:
    x = _stored_extracts(s)
    return report.totals(report.report(x, store(x.history(), "event_history")))
