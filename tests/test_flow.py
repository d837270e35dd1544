import pytest

from admitflow import __main__ as command
from admitflow import session
from admitflow.plans import flow, report
from admitflow.plans.gates import DataQualityError
from admitflow.sources.tables import Layer
from tests.sample_process import Process


def run(spark, tmp_path, process):
    source = process.write_csv(tmp_path / "raw")
    return flow.Flow(spark, source, str(tmp_path / "warehouse"), str(tmp_path / "output"))


def table(spark, path, *columns):
    return [tuple(r) for r in spark.read.parquet(str(path)).select(*columns).collect()]


def test_clean_run(spark, tmp_path):
    counts = run(spark, tmp_path, Process()).run()
    assert counts == {
        "applicants": 2,
        "onboarding_applications": 3,
        "onboarding_events": 10,
        flow.FUNNEL_OUTPUT: 2,
        flow.DURATION_OUTPUT: 2,
    }
    marts = tmp_path / "warehouse" / "marts"
    days = table(spark, marts / "dim_date", "date_key", "day_of_week", "day_name")
    assert sorted(days) == [(20250101, 3, "Wednesday"), (20250102, 4, "Thursday"), (20250103, 5, "Friday")]
    assert sorted(table(spark, marts / "dim_channel", "channel_key", "channel_code")) == [
        (-1, "UNKNOWN"), (1, "ASSISTED"), (2, "MOBILE"), (3, "ORGANIC"), (4, "PAID"), (5, "WEB"),
    ]
    assert sorted(table(spark, marts / "dim_applicant", "applicant_key", "applicant_id", "applicant_type")) == [
        (-1, "UNKNOWN", None), (1, "A1", "INDIVIDUAL"), (2, "A2", "BUSINESS"),
    ]
    gaps = dict(table(spark, marts / "fact_onboarding_events", "event_id", "seconds_since_prev_event"))
    assert gaps == {
        "E1": 0, "E2": 60, "E3": 90, "E4": 150, "E5": 300, "E6": 85800, "E7": 0, "E8": 1800, "E9": 0, "E10": 45,
    }
    snapshot = table(
        spark, marts / "fact_application_snapshot",
        "application_id", "seconds_to_submit", "seconds_to_complete", "failure_event_count", "session_count",
    )
    assert sorted(snapshot) == [("P1", 600, 86400, 1, 2), ("P2", None, 1800, 0, 1), ("P3", None, None, 0, 1)]
    funnel = [tuple(map(str, r)) for r in table(spark, tmp_path / "output" / flow.FUNNEL_OUTPUT, "*")]
    assert funnel == [
        ("2025-01-01", "WEB", "STANDARD", "2", "1", "1", "0", "1"),
        ("2025-01-03", "MOBILE", "BUSINESS", "1", "0", "0", "0", "0"),
    ]
    assert table(spark, tmp_path / "output" / flow.DURATION_OUTPUT, "*") == [
        ("MOBILE", "BUSINESS", 1, None, None, 0.0, 1.0, 0.0),
        ("WEB", "STANDARD", 2, 10.0, 1440.0, 0.5, 1.5, 0.5),
    ]


def test_violated_gate_stops_before_the_marts(spark, tmp_path):
    process = Process()
    process.application("P1", device_type="TV")
    process.event("E2", event_metadata="{")
    with pytest.raises(DataQualityError) as error:
        run(spark, tmp_path, process).run()
    assert error.value.failures == {"device_type_accepted": 1, "event_metadata_json": 1}
    assert not (tmp_path / "warehouse" / "marts").exists()
    assert not (tmp_path / "output").exists()


def test_violated_marts_gate_stops_before_the_export(spark, tmp_path):
    process = Process()
    process.delete_events("E9", "E10")
    with pytest.raises(DataQualityError) as error:
        run(spark, tmp_path, process).run()
    assert error.value.failures == {"date_key_exists": 1}
    assert not (tmp_path / "output").exists()


def test_second_run_replaces_everything(spark, tmp_path):
    run(spark, tmp_path, Process()).run()
    process = Process()
    process.tables["onboarding_applications"].pop()
    process.delete_events("E9", "E10")
    counts = run(spark, tmp_path, process).run()
    assert counts["onboarding_events"] == 8 and counts[flow.FUNNEL_OUTPUT] == 1


def test_check_command(spark, tmp_path, capsys):
    process = Process()
    process.event("E3", event_outcome="BROKEN")
    folder = process.write_csv(tmp_path / "raw")
    assert command.main(["check", "--dir", folder]) == 1
    out = capsys.readouterr().out
    assert "[FAIL] onboarding_events.event_outcome.accepted: 1" in out
    assert "'event_id': 'E3'" in out
    assert "30 passed, 5 failed, 35 rules" in out
    assert "applicants: 2 rows\n" in out
    assert "onboarding_events: 10 rows, 1 days from 2025-01-01 to 2025-01-03" in out
    assert command.main(["check", "--dir", folder, "--line-breaks", "yes", "--warehouse", str(tmp_path / "landed")]) == 1
    assert (tmp_path / "landed" / "event_history").exists()
    assert command.main(["check", "--dir", str(tmp_path / "none")]) == 2


def test_check_reads_the_files_once(spark, tmp_path):
    folder = Process().write_csv(tmp_path / "raw")
    layer = Layer(spark, str(tmp_path / "landed"))
    landed = report.Extracts.landed(layer, folder)
    history = layer.write("event_history", landed.history())
    rules = [row["check_name"] for row in report.report(landed, history).collect()]
    frames = [report.report(landed, history), report.figures(landed)]
    frames += [report.offending(landed, r, history) for r in rules if r.split(".")[-1] not in ("minimum", "span")]
    for frame in frames:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "FileScan parquet" in plan and "FileScan csv" not in plan


def test_steps_prepare_the_session(spark, tmp_path):
    """Each step may run in a session that nobody prepared."""
    whole = run(spark, tmp_path, Process())
    steps = ("ingest_raw", "build_staging", "check_staging", "build_marts", "check_marts", "export_outputs")
    for step in steps:
        bare = spark.newSession()
        for name in session.RUNTIME_CONF:
            bare.conf.unset(name)
        bare.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        bare.conf.set("spark.sql.ansi.enabled", "false")
        bare.conf.set("spark.sql.shuffle.partitions", "2")
        getattr(flow.Flow(bare, whole.source_dir, whole.warehouse_dir, whole.output_dir), step)()
        assert {name: bare.conf.get(name) for name in session.RUNTIME_CONF} == session.RUNTIME_CONF
    days = table(spark, tmp_path / "warehouse" / "marts" / "dim_date", "date_key")
    assert sorted(days) == [(20250101,), (20250102,), (20250103,)]


def test_stored_bytes(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "tables"))
    assert layer.total_bytes() == 0
    layer.write_all({"a": lambda: spark.range(3), "b": lambda: spark.range(4)})
    files = (tmp_path / "tables").rglob("*.parquet")
    assert layer.total_bytes() == sum(f.stat().st_size for f in files if f.is_file()) > 0
