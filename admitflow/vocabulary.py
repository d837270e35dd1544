"""Names, value lists and thresholds that define the application-process data model."""

# Accepted codes per column.
APPLICANT_TYPES = ["INDIVIDUAL", "BUSINESS"]
APPLICATION_TYPES = ["STANDARD", "PREMIUM", "BUSINESS", "PARTNER"]
SOURCE_CHANNELS = ["WEB", "MOBILE", "PARTNER", "ASSISTED"]
DEVICE_TYPES = ["DESKTOP", "MOBILE", "TABLET", "OTHER"]
APPLICATION_STATUSES = ["STARTED", "IN_PROGRESS", "SUBMITTED", "APPROVED", "REJECTED", "ABANDONED"]
EVENT_TYPES = [
    "APPLICATION_CREATED",
    "STEP_STARTED",
    "STEP_COMPLETED",
    "STEP_FAILED",
    "STEP_RETRIED",
    "SESSION_RESUMED",
    "DECISION_RECORDED",
    "APPLICATION_ABANDONED",
]
EVENT_OUTCOMES = ["SUCCESS", "FAILED", "PENDING"]

# Status groups and allowed status changes after the first event.
DECIDED_STATUSES = ["APPROVED", "REJECTED"]
TERMINAL_STATUSES = ["APPROVED", "REJECTED", "ABANDONED"]
SUBMITTED_STATUSES = ["SUBMITTED", "APPROVED", "REJECTED"]
TRANSITIONS = [
    ("STARTED", "IN_PROGRESS"),
    ("STARTED", "ABANDONED"),
    ("IN_PROGRESS", "IN_PROGRESS"),
    ("IN_PROGRESS", "SUBMITTED"),
    ("IN_PROGRESS", "ABANDONED"),
    ("SUBMITTED", "APPROVED"),
    ("SUBMITTED", "REJECTED"),
    ("SUBMITTED", "ABANDONED"),
]

# Source columns, in file order.
SOURCE_COLUMNS = {
    "applicants": [
        "applicant_id",
        "applicant_type",
        "country_code",
        "region",
        "acquisition_channel",
        "marketing_campaign",
        "preferred_language",
        "created_at",
        "updated_at",
    ],
    "onboarding_applications": [
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
        "rejection_reason",
        "updated_at",
    ],
    "onboarding_events": [
        "event_id",
        "application_id",
        "event_sequence",
        "event_timestamp",
        "event_type",
        "step_name",
        "from_status",
        "to_status",
        "event_outcome",
        "failure_reason",
        "session_id",
        "source_channel",
        "event_metadata",
    ],
}
PRIMARY_KEYS = {
    "applicants": "applicant_id",
    "onboarding_applications": "application_id",
    "onboarding_events": "event_id",
}

# Columns that may not be empty, for the staged tables and for the raw rule report.
STAGED_REQUIRED = {
    "applicants": [
        "applicant_id",
        "applicant_type",
        "country_code",
        "region",
        "acquisition_channel",
        "preferred_language",
        "created_at",
        "updated_at",
    ],
    "onboarding_applications": [
        "application_id",
        "applicant_id",
        "application_type",
        "source_channel",
        "device_type",
        "started_at",
        "current_step",
        "application_status",
        "updated_at",
    ],
    "onboarding_events": [
        "event_id",
        "application_id",
        "event_sequence",
        "event_timestamp",
        "event_type",
        "step_name",
        "to_status",
        "event_outcome",
        "session_id",
        "source_channel",
    ],
}
REPORT_REQUIRED = {
    "applicants": ["applicant_id", "applicant_type", "created_at"],
    "onboarding_applications": ["application_id", "applicant_id", "started_at", "application_status"],
    "onboarding_events": [
        "event_id",
        "application_id",
        "event_sequence",
        "event_timestamp",
        "event_type",
        "event_outcome",
    ],
}

# Smallest accepted delivery.
MIN_ROWS = {"applicants": 1000, "onboarding_applications": 1200, "onboarding_events": 8000}
MIN_EVENT_SPAN_DAYS = 90

# The member that stands for a failed lookup.
UNKNOWN_KEY = -1
UNKNOWN_CODE = "UNKNOWN"
