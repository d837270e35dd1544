"""A small clean process of two applicants, three applications and ten events, as raw text."""

from __future__ import annotations

import csv
from copy import deepcopy
from pathlib import Path

from admitflow import vocabulary as V


def _applicant(applicant_id, kind, acquisition):
    return {
        "applicant_id": applicant_id,
        "applicant_type": kind,
        "country_code": "TH",
        "region": "CENTRAL",
        "acquisition_channel": acquisition,
        "marketing_campaign": "",
        "preferred_language": "th",
        "created_at": "2024-12-01 08:00:00",
        "updated_at": "2024-12-01 08:00:00",
    }


def _application(*values):
    names = [
        "application_id",
        "applicant_id",
        "application_type",
        "source_channel",
        "device_type",
        "started_at",
        "submitted_at",
        "completed_at",
        "current_step",
        "application_status",
        "decision",
        "updated_at",
    ]
    return dict(zip(names, values)) | {"rejection_reason": ""}


def _event(*values):
    names = [
        "event_id",
        "application_id",
        "event_sequence",
        "event_timestamp",
        "event_type",
        "step_name",
        "from_status",
        "to_status",
        "event_outcome",
        "session_id",
        "source_channel",
        "event_metadata",
    ]
    return dict(zip(names, values)) | {"failure_reason": ""}


CLEAN = {
    "applicants": [_applicant("A1", "INDIVIDUAL", "ORGANIC"), _applicant("A2", "BUSINESS", "PAID")],
    "onboarding_applications": [
        _application("P1", "A1", "STANDARD", "WEB", "DESKTOP", "2025-01-01 10:00:00", "2025-01-01 10:10:00",
                     "2025-01-02 10:00:00", "DECISION", "APPROVED", "APPROVED", "2025-01-02 10:00:00"),
        _application("P2", "A1", "STANDARD", "WEB", "MOBILE", "2025-01-01 11:00:00", "",
                     "2025-01-01 11:30:00", "PROFILE", "ABANDONED", "", "2025-01-01 11:30:00"),
        _application("P3", "A2", "BUSINESS", "MOBILE", "TABLET", "2025-01-03 09:00:00", "", "", "PROFILE",
                     "IN_PROGRESS", "", "2025-01-03 09:00:45"),
    ],
    "onboarding_events": [
        _event("E1", "P1", "1", "2025-01-01 10:00:00", "APPLICATION_CREATED", "START", "", "STARTED", "SUCCESS",
               "S1", "WEB", '{"v": 1}'),
        _event("E2", "P1", "2", "2025-01-01 10:01:00", "STEP_STARTED", "PROFILE", "STARTED", "IN_PROGRESS", "PENDING",
               "S1", "WEB", ""),
        _event("E3", "P1", "3", "2025-01-01 10:02:30", "STEP_FAILED", "PROFILE", "IN_PROGRESS", "IN_PROGRESS",
               "FAILED", "S1", "WEB", '{"c": "a,b"}'),
        _event("E4", "P1", "4", "2025-01-01 10:05:00", "STEP_RETRIED", "PROFILE", "IN_PROGRESS", "IN_PROGRESS",
               "PENDING", "S2", "WEB", ""),
        _event("E5", "P1", "5", "2025-01-01 10:10:00", "STEP_COMPLETED", "REVIEW", "IN_PROGRESS", "SUBMITTED",
               "SUCCESS", "S2", "ASSISTED", ""),
        _event("E6", "P1", "6", "2025-01-02 10:00:00", "DECISION_RECORDED", "DECISION", "SUBMITTED", "APPROVED",
               "SUCCESS", "S2", "ASSISTED", ""),
        _event("E7", "P2", "1", "2025-01-01 11:00:00", "APPLICATION_CREATED", "START", "", "STARTED", "SUCCESS",
               "S3", "WEB", ""),
        _event("E8", "P2", "2", "2025-01-01 11:30:00", "APPLICATION_ABANDONED", "PROFILE", "STARTED", "ABANDONED",
               "PENDING", "S3", "WEB", ""),
        _event("E9", "P3", "1", "2025-01-03 09:00:00", "APPLICATION_CREATED", "START", "", "STARTED", "SUCCESS",
               "S4", "MOBILE", ""),
        _event("E10", "P3", "2", "2025-01-03 09:00:45", "STEP_STARTED", "PROFILE", "STARTED", "IN_PROGRESS",
               "PENDING", "S4", "MOBILE", ""),
    ],
}


class Process:
    """An editable copy of the clean process."""

    def __init__(self):
        self.tables = deepcopy(CLEAN)

    def row(self, source, row_id):
        return next(r for r in self.tables[source] if r[V.PRIMARY_KEYS[source]] == row_id)

    def applicant(self, row_id, **values):
        self.row("applicants", row_id).update(values)

    def application(self, row_id, **values):
        self.row("onboarding_applications", row_id).update(values)

    def event(self, row_id, **values):
        self.row("onboarding_events", row_id).update(values)

    def add_event(self, like, **values):
        self.tables["onboarding_events"].append(self.row("onboarding_events", like) | values)

    def delete_events(self, *row_ids):
        events = self.tables["onboarding_events"]
        self.tables["onboarding_events"] = [e for e in events if e["event_id"] not in row_ids]

    def frames(self, spark):
        """Raw tables as a CSV read gives them: empty fields are NULL."""
        result = {}
        for source, columns in V.SOURCE_COLUMNS.items():
            rows = [tuple(r[c] or None for c in columns) for r in self.tables[source]]
            result[source] = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
        return result

    def write_csv(self, folder: Path):
        folder.mkdir(parents=True, exist_ok=True)
        for source, columns in V.SOURCE_COLUMNS.items():
            with open(folder / f"{source}.csv", "w", newline="") as handle:
                writer = csv.DictWriter(handle, fieldnames=columns)
                writer.writeheader()
                writer.writerows(self.tables[source])
        return str(folder)
