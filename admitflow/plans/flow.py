"""The whole run: extracts -> raw -> staging -> gate -> marts -> gate -> outputs."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from admitflow import session
from admitflow import vocabulary as V
from admitflow.plans import dimensions, facts, gates, outcomes, staging
from admitflow.plans.history import event_history
from admitflow.sources import extracts
from admitflow.sources.tables import Layer, export

FUNNEL_OUTPUT = "onboarding_funnel_by_date_channel.parquet"
DURATION_OUTPUT = "onboarding_duration_and_failure_by_channel.parquet"

# What the staging gate and the snapshot need from the event history.
STORED_HISTORY = [
    "application_id",
    "event_count",
    "sequence_faults",
    "timestamp_faults",
    "status_breaks",
    "after_terminal",
    "latest",
    "submitted_event_at",
    "terminal_event_at",
    "failure_event_count",
    "session_count",
]


@dataclass(frozen=True)
class Flow:
    """One run over a folder of extracts. Each step stores its tables and the next one reads them.

    A step may run in a session of its own: it prepares it and sizes its shuffles by what it reads.
    """

    spark: SparkSession
    source_dir: str
    warehouse_dir: str
    output_dir: str
    # Whether text fields of the extracts hold line breaks; None has the files looked at.
    line_breaks_in_fields: bool | None = None

    def layer(self, name: str) -> Layer:
        return Layer(self.spark, f"{self.warehouse_dir.rstrip('/')}/{name}")

    def _reading(self, *names: str) -> list[Layer]:
        """The layers a step reads, its session ready for them."""
        session.prepare(self.spark)
        layers = [self.layer(name) for name in names]
        session.fit_shuffles(self.spark, session.STORED_RATIO * sum(layer.total_bytes() for layer in layers))
        return layers

    def ingest_raw(self) -> dict[str, int]:
        """Copy the extracts as text; gives the rows per table."""
        session.prepare(self.spark)
        raw = self.layer("raw")
        paths = extracts.extract_paths(self.source_dir)
        session.fit_shuffles(self.spark, extracts.total_bytes(self.spark, self.source_dir))
        raw.write_all(
            {
                source: partial(extracts.read_csv, self.spark, path, self.line_breaks_in_fields)
                for source, path in paths.items()
            }
        )
        return {source: raw.count(source) for source in V.SOURCE_COLUMNS}

    def build_staging(self) -> None:
        (raw,) = self._reading("raw")
        staged = self.layer("staging")
        staged.write_all(
            {t: partial(staging.stage, raw.read(source), source) for source, t in staging.STAGED_NAMES.items()}
        )
        staged.write("event_history", event_history(staged.read("stg_events")).select(*STORED_HISTORY))

    def _staged(self) -> list[DataFrame]:
        return [self.layer("staging").read(table) for table in staging.STAGED_NAMES.values()]

    def check_staging(self) -> None:
        self._reading("staging")
        gates.enforce(gates.staging_gate(*self._staged(), history=self.layer("staging").read("event_history")))

    def build_marts(self) -> None:
        self._reading("staging")
        applicants, applications, events = self._staged()
        history = self.layer("staging").read("event_history")
        marts = self.layer("marts")
        dims = marts.write_all(dimensions.all_dimensions(applicants, applications, events))
        application, applicant, channel = dims["dim_application"], dims["dim_applicant"], dims["dim_channel"]
        marts.write_all(
            {
                "fact_onboarding_events": partial(facts.event_fact, events, application, channel),
                "fact_application_snapshot": partial(
                    facts.application_snapshot, applications, history, application, applicant, channel
                ),
            }
        )

    def check_marts(self) -> None:
        marts, _ = self._reading("marts", "staging")
        _, applications, events = self._staged()
        gates.enforce(
            gates.marts_gate(
                dim_date=marts.read("dim_date"),
                dim_channel=marts.read("dim_channel"),
                dim_applicant=marts.read("dim_applicant"),
                dim_application=marts.read("dim_application"),
                event_fact=marts.read("fact_onboarding_events"),
                snapshot=marts.read("fact_application_snapshot"),
                applications=applications,
                events=events,
            )
        )

    def export_outputs(self) -> dict[str, int]:
        """Write both outputs; gives the rows per output."""
        (marts,) = self._reading("marts")
        # Small (days x channels x types) and read by both outputs.
        cube = marts.write(
            "outcome_cube",
            outcomes.outcome_cube(marts.read("fact_application_snapshot"), marts.read("dim_application")),
        )
        channel = marts.read("dim_channel")
        results = {
            FUNNEL_OUTPUT: outcomes.funnel_from_cube(cube, marts.read("dim_date"), channel),
            DURATION_OUTPUT: outcomes.durations_from_cube(cube, channel),
        }
        return {name: export(df, f"{self.output_dir.rstrip('/')}/{name}") for name, df in results.items()}

    def run(self) -> dict[str, int]:
        """All steps in order; a violated gate raises ``DataQualityError`` and nothing later is written."""
        counts = self.ingest_raw()
        self.build_staging()
        self.check_staging()
        self.build_marts()
        self.check_marts()
        return counts | self.export_outputs()
