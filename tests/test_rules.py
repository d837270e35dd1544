"""Break the clean process one way at a time; exactly the matching rules may fire."""

import json

import pytest
from pyspark.sql import functions as F

from admitflow.plans import dimensions, facts, gates, report, staging
from admitflow.plans.history import event_history
from tests.sample_process import Process


def staged(spark, process):
    raw = process.frames(spark)
    return [staging.stage(raw[source], source) for source in raw]


def fired(checks):
    return {r["check_name"]: r["bad_count"] for r in checks.collect() if r["bad_count"]}


def gate(spark, process):
    return fired(gates.staging_gate(*staged(spark, process)))


def rules(spark, process):
    """Report without the volume rules; rule names cut to what follows the table."""
    no_minimum = dict.fromkeys(["applicants", "onboarding_applications", "onboarding_events"], 0)
    rows = report.report(report.Extracts.of(process.frames(spark)), min_rows=no_minimum, min_days=0)
    return fired(rows)


def marts(spark, process):
    applicants, applications, events = staged(spark, process)
    dim_channel = dimensions.conformed_channels(applicants, applications, events)
    dim_applicant = dimensions.applicants(applicants)
    dim_application = dimensions.applications(applications)
    return {
        "dim_date": dimensions.calendar(events),
        "dim_channel": dim_channel,
        "dim_applicant": dim_applicant,
        "dim_application": dim_application,
        "event_fact": facts.event_fact(events, dim_application, dim_channel),
        "snapshot": facts.application_snapshot(
            applications, event_history(events), dim_application, dim_applicant, dim_channel
        ),
        "applications": applications,
        "events": events,
    }


def test_clean_process_passes_everything(spark):
    process = Process()
    checks = gates.staging_gate(*staged(spark, process)).collect()
    assert len(checks) == 26 and len({c["check_name"] for c in checks}) == 26
    assert all(c["bad_count"] == 0 for c in checks)
    mart_checks = gates.marts_gate(**marts(spark, process)).collect()
    assert len(mart_checks) == 8 and all(c["bad_count"] == 0 for c in mart_checks)
    extracts = report.Extracts.of(process.frames(spark))
    rows = report.report(extracts)
    assert rows.count() == 35 and len({r["check_name"] for r in rows.collect()}) == 35
    assert fired(rows) == {
        "applicants.row_count.minimum": 998,
        "onboarding_applications.row_count.minimum": 1197,
        "onboarding_events.row_count.minimum": 7990,
        "onboarding_events.event_timestamp.span": 89,
    }
    assert report.totals(rows).first().asDict() == {"passed": 31, "failed": 4, "total": 35}


APPS = "onboarding_applications"
EVENTS = "onboarding_events"
MUTATIONS = {
    "event copied": (
        lambda p: p.add_event("E3"),
        {"event_id_unique": 1, "event_sequence_increases": 1, "event_timestamp_increases": 1},
        {f"{EVENTS}.event_id.unique": 2, f"{EVENTS}.event_sequence.contiguous": 1,
         f"{EVENTS}.event_timestamp.increasing": 1},
    ),
    "event of an unknown application": (
        lambda p: p.event("E10", application_id="PX"),
        {"event_application_exists": 1, "state_matches_latest_event": 1},
        {f"{EVENTS}.application_id.exists": 1, f"{EVENTS}.event_sequence.contiguous": 1},
    ),
    "application of an unknown applicant": (
        lambda p: p.application("P2", applicant_id="AX"),
        {"application_applicant_exists": 1},
        {f"{APPS}.applicant_id.exists": 1},
    ),
    "unknown outcome": (
        lambda p: p.event("E3", event_outcome="BROKEN"),
        {"event_outcome_accepted": 1},
        {f"{EVENTS}.event_outcome.accepted": 1},
    ),
    "unknown device": (lambda p: p.application("P1", device_type="TV"), {"device_type_accepted": 1}, {}),
    "empty region": (lambda p: p.applicant("A2", region=""), {"applicants_required": 1}, {}),
    "times swapped": (
        lambda p: (
            p.event("E2", event_timestamp="2025-01-01 10:02:30"),
            p.event("E3", event_timestamp="2025-01-01 10:01:00"),
        ),
        {"event_sequence_increases": 1, "event_timestamp_increases": 1},
        {f"{EVENTS}.event_timestamp.increasing": 1},
    ),
    "number skipped": (
        lambda p: p.event("E10", event_sequence="3"), {}, {f"{EVENTS}.event_sequence.contiguous": 1},
    ),
    "first event lost": (lambda p: p.delete_events("E9"), {}, {f"{EVENTS}.event_sequence.contiguous": 1}),
    "text after JSON": (
        lambda p: p.event("E2", event_metadata='{"a":1} x'),
        {"event_metadata_json": 1},
        {f"{EVENTS}.event_metadata.json": 1},
    ),
    "decision too early": (
        lambda p: p.application("P3", decision="APPROVED"),
        {"decision_only_when_decided": 1},
        {f"{APPS}.decision.only_when_decided": 1},
    ),
    "decision lost": (
        lambda p: p.application("P1", decision=""), {}, {f"{APPS}.decision.present_when_decided": 1},
    ),
    "source status lost": (
        lambda p: p.event("E4", from_status=""), {"from_status_continues": 1, "transition_allowed": 1}, {},
    ),
    "event after the decision": (
        lambda p: p.add_event("E6", event_id="E11", event_sequence="7", from_status="APPROVED",
                              to_status="IN_PROGRESS", event_timestamp="2025-01-02 10:05:00", step_name="PROFILE"),
        {"transition_allowed": 1, "nothing_after_terminal": 1, "state_matches_latest_event": 1},
        {report.LAST_STATE: 1},
    ),
    "submitted before the start": (
        lambda p: p.application("P1", submitted_at="2025-01-01 09:00:00"),
        {"milestones_match_events": 1, "milestones_in_order": 1},
        {f"{APPS}.milestones.ordered": 1},
    ),
    "completion lost": (
        lambda p: p.application("P2", completed_at=""),
        {"milestones_match_events": 1},
        {f"{APPS}.completed_at.present": 1},
    ),
    "all events of an application lost": (
        lambda p: p.delete_events("E9", "E10"), {}, {},
    ),
    "settled application without events": (
        lambda p: p.delete_events("E7", "E8"), {}, {report.LAST_STATE: 1},
    ),
    "first event is another": (
        lambda p: p.event("E9", event_type="STEP_STARTED"), {"first_event_creates": 1}, {},
    ),
    "unknown codes": (
        lambda p: (
            p.applicant("A1", applicant_type="ROBOT"),
            p.application("P3", application_status="LOST", application_type="GIFT", source_channel="FAX"),
            p.event("E2", event_type="NAP"),
        ),
        {"applicant_type_accepted": 1, "application_status_accepted": 1, "application_type_accepted": 1,
         "source_channel_accepted": 1, "event_type_accepted": 1, "state_matches_latest_event": 1},
        {"applicants.applicant_type.accepted": 1, f"{APPS}.application_status.accepted": 1},
    ),
    "copied applicant and application": (
        lambda p: (
            p.tables["applicants"].append(dict(p.row("applicants", "A2"))),
            p.tables[APPS].append(dict(p.row(APPS, "P3"))),
        ),
        {"applicant_id_unique": 1, "application_id_unique": 1},
        {"applicants.applicant_id.unique": 2, f"{APPS}.application_id.unique": 2},
    ),
    "completed while open": (
        lambda p: p.application("P3", completed_at="2025-01-03 09:00:45"),
        {"milestones_match_events": 1},
        {f"{APPS}.completed_at.absent": 1},
    ),
}
# An application that lost all events fails the report even when it is still open.
MUTATIONS["all events of an application lost"][2].update({report.LAST_STATE: 1})


@pytest.mark.parametrize("name", MUTATIONS)
def test_mutation(spark, name):
    change, gate_faults, report_faults = MUTATIONS[name]
    process = Process()
    change(process)
    assert gate(spark, process) == gate_faults
    assert rules(spark, process) == report_faults


def test_required_fields_of_all_tables(spark):
    process = Process()
    process.application("P3", current_step="")
    process.event("E2", session_id="", event_outcome="")
    assert gate(spark, process) == {"applications_required": 1, "events_required": 1}
    assert rules(spark, process) == {f"{EVENTS}.event_outcome.required": 1}


def test_unreadable_time_stops_staging_but_not_the_report(spark):
    process = Process()
    process.application("P3", started_at="not a time")
    _, applications, _ = staged(spark, process)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        applications.collect()
    assert rules(spark, process) == {}

    process = Process()
    process.event("E2", event_timestamp="soon", event_sequence="two")
    assert rules(spark, process) == {
        f"{EVENTS}.event_sequence.contiguous": 1,
        f"{EVENTS}.event_timestamp.increasing": 1,
        report.LAST_STATE: 1,  # an unnumbered event counts as the last one
    }


def test_no_readable_event_time_fails_the_span(spark):
    process = Process()
    for event in process.tables[EVENTS]:
        event["event_timestamp"] = "?"
    extracts = report.Extracts.of(process.frames(spark))
    found = fired(report.volume_rules(extracts, dict.fromkeys(process.tables, 0), 0))
    assert found == {f"{EVENTS}.event_timestamp.span": 1}


def test_date_key_outside_the_calendar(spark):
    process = Process()
    process.delete_events("E9", "E10")
    assert fired(gates.marts_gate(**marts(spark, process))) == {"date_key_exists": 1}


def test_marts_gate_counts_each_fault(spark):
    tables = marts(spark, Process())
    fact, snapshot = tables["event_fact"], tables["snapshot"]
    broken = tables | {
        "event_fact": fact.union(fact.limit(1)).replace({3: 77}, subset=["application_key"]),
        "snapshot": snapshot.union(snapshot.filter("application_id = 'P2'")).replace(
            {1800: -5}, subset=["seconds_to_complete"]
        ),
        "dim_date": tables["dim_date"].union(tables["dim_date"].limit(1)),
    }
    assert fired(gates.marts_gate(**broken)) == {
        "snapshot_application_unique": 1,
        "event_application_key_exists": 2,
        "snapshot_rows_match_staging": 1,
        "seconds_to_complete_not_negative": 2,
        "event_fact_event_unique": 1,
        "event_fact_rows_match_staging": 1,
        "dimension_keys_unique": 1,
    }


def test_enforce_lists_every_violation(spark):
    checks = spark.createDataFrame([("a", 2), ("b", 0), ("c", 1)], "check_name string, bad_count bigint")
    with pytest.raises(gates.DataQualityError) as error:
        gates.enforce(checks)
    assert error.value.failures == {"a": 2, "c": 1}
    gates.enforce(checks.filter("bad_count = 0"))


def test_offending_rows(spark):
    process = Process()
    process.add_event("E3")
    process.event("E10", application_id="PX")
    process.event("E5", event_outcome="?")
    process.application("P2", applicant_id="AX")
    extracts = report.Extracts.of(process.frames(spark))

    def ids(rule, column):
        return sorted(r[column] for r in report.offending(extracts, rule).collect())

    assert ids(f"{EVENTS}.event_id.unique", "event_id") == ["E3", "E3"]
    assert ids(f"{EVENTS}.application_id.exists", "event_id") == ["E10"]
    assert ids(f"{EVENTS}.event_outcome.accepted", "event_id") == ["E5"]
    assert ids(f"{APPS}.applicant_id.exists", "application_id") == ["P2"]
    assert ids(f"{EVENTS}.event_sequence.contiguous", "application_id") == ["P1", "PX"]
    assert ids(report.LAST_STATE, "application_id") == []
    bad = report.offending(extracts, f"{EVENTS}.event_id.unique")
    assert [r["event_id"] for r in report.sample(bad, "event_id", 1).collect()] == ["E3"]


def test_examples_of_all_rules_come_in_one_plan(spark):
    process = Process()
    process.add_event("E3")
    process.event("E10", application_id="PX")
    process.event("E5", event_outcome="?")
    process.application("P2", applicant_id="AX", application_status="?")
    extracts = report.Extracts.of(process.frames(spark))
    failed = [r["check_name"] for r in report.report(extracts).collect() if r["status"] == "FAIL"]
    found = report.examples(extracts, failed)
    rows = {(r["check_name"], r["place"]): (r["key"], json.loads(r["offender"])) for r in found.collect()}
    assert {name for name, _ in rows} == {n for n in failed if n.split(".")[-1] not in report.WHOLE_TABLE}
    assert [rows[f"{EVENTS}.event_id.unique", place][0] for place in (1, 2)] == ["E3", "E3"]
    assert rows[f"{EVENTS}.event_outcome.accepted", 1][1]["event_outcome"] == "?"
    assert rows[f"{APPS}.applicant_id.exists", 1][1]["applicant_id"] == "AX"
    assert rows[f"{APPS}.application_status.accepted", 1][0] == "P2"
    assert rows[f"{EVENTS}.event_sequence.contiguous", 1][1] == {"application_id": "P1"}
    few = report.examples(extracts, failed, rows=1)
    assert {(r["check_name"], r["place"]) for r in few.collect()} == {key for key in rows if key[1] == 1}
    # The first few of a rule are kept in every task before the shuffle.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit [check_name" in plan and "Partial" in plan
    assert report.examples(extracts, ["applicants.row_count.minimum"]).collect() == []


def test_examples_are_the_first_offenders_whatever_their_keys(spark):
    """Repeated and missing keys, more offenders than asked for; whole rows are only fetched for the keys found."""
    process = Process()
    process.add_event("E3")
    process.add_event("E3")
    for i, event in enumerate(["E1", "E2", "E4", "E5", "E6", "E7", "E8"]):
        process.event(event, event_outcome="?", application_id=f"PX{i}")
    process.application("P2", applicant_id="AX", application_status="?")
    frames = process.frames(spark)
    events = frames["onboarding_events"]
    unkeyed = events.where("event_id IN ('E1', 'E5', 'E9')").withColumn("event_id", F.lit(None).cast("string"))
    frames["onboarding_events"] = events.union(unkeyed).union(unkeyed.limit(1))
    extracts = report.Extracts.of(frames)
    names = [name for source in frames for name in report.row_rules(source)]
    names += [f"{EVENTS}.event_id.unique", *report.REFERENCES, *report.HISTORY_RULES, report.LAST_STATE]
    found = report.examples(extracts, names, rows=3)
    got = sorted((r["check_name"], r["place"], r["key"], r["offender"]) for r in found.collect())
    expected = []
    for name in names:
        bad = report.offending(extracts, name)
        key = {"applicants": "applicant_id", APPS: "application_id", EVENTS: "event_id"}[name.split(".")[0]]
        key = key if key in bad.columns else "application_id"
        first = bad.orderBy(F.col(key).asc_nulls_last(), *bad.columns).limit(3)
        rows = first.select(key, F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("o")).collect()
        expected += [(name, i, *row) for i, row in enumerate(rows, 1)]
    assert len(expected) > 20
    assert got == sorted(expected, key=lambda r: r[:2])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
