"""The same results in plain SQL for the comparison engine."""

from __future__ import annotations

import re

from admitflow import vocabulary as V
from workload import standins as S
from workload.standins import for_oracle


def _cast(source: str, **columns: str) -> str:
    return ", ".join(columns.get(c, c) + (f" AS {c}" if c in columns else "") for c in V.SOURCE_COLUMNS[source])


def _time(column: str) -> str:
    return f"CAST(NULLIF({column}, '') AS TIMESTAMP)"


def _filled(column: str) -> str:
    return f"NULLIF({column}, '')"


def _listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_SEQUENCE_ORDER = "event_sequence, event_timestamp, to_status, from_status, step_name"
_TIME_ORDER = "event_timestamp, event_sequence, to_status, from_status, step_name"


def _neighbours(events: str) -> str:
    return f"""
    SELECT *, lag(event_timestamp) OVER by_number AS p_time, lag(to_status) OVER by_number AS p_status,
           lag(event_sequence) OVER by_time AS p_number
    FROM {events}
    WINDOW by_number AS (PARTITION BY application_id ORDER BY {_SEQUENCE_ORDER}),
           by_time AS (PARTITION BY application_id ORDER BY {_TIME_ORDER})"""


def _latest(events: str, nulls: str) -> str:
    order = ", ".join(f"{c} DESC NULLS {nulls}" for c in _SEQUENCE_ORDER.split(", "))
    return f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY application_id ORDER BY {order}) AS rn FROM {events})
    WHERE rn = 1"""


def _milestones(events: str) -> str:
    return f"""
    SELECT application_id, count(*) AS event_count,
           min(event_timestamp) FILTER (to_status = 'SUBMITTED') AS submitted_event_at,
           min(event_timestamp) FILTER (to_status IN {_listed(V.TERMINAL_STATUSES)}) AS terminal_event_at
    FROM {events} GROUP BY application_id"""


def _calendar(events: str, column: str) -> str:
    return f"""
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS calendar_date,
           year(d) AS year, month(d) AS month, day(d) AS day, dayofweek(d) AS day_of_week, dayname(d) AS day_name
    FROM (SELECT unnest(generate_series(min(CAST({column} AS DATE)), max(CAST({column} AS DATE)),
                                        INTERVAL '1' DAY)) AS d FROM {events})"""


def _event_fact(events: str, channels: str) -> str:
    return f"""
    SELECT event_id, coalesce(a.application_key, -1) AS application_key, coalesce(c.channel_key, -1) AS channel_key,
           CAST(strftime(event_timestamp, '%Y%m%d') AS INTEGER) AS date_key,
           event_sequence, event_timestamp, event_type, step_name, from_status, to_status, event_outcome,
           failure_reason, session_id, event_metadata,
           coalesce(date_diff('second', lag(event_timestamp) OVER (PARTITION BY e.application_id
                    ORDER BY event_sequence, event_timestamp, event_id), event_timestamp), 0)
               AS seconds_since_prev_event
    FROM {events} AS e
    LEFT JOIN dim_application AS a ON e.application_id = a.application_id
    LEFT JOIN {channels} AS c ON e.source_channel = c.channel_code AND c.channel_key <> -1"""


def _channels(events: str) -> str:
    return f"""
    SELECT row_number() OVER (ORDER BY channel_code) AS channel_key, channel_code
    FROM (SELECT source_channel AS channel_code FROM stg_applications
          UNION SELECT acquisition_channel FROM stg_applicants
          UNION SELECT source_channel FROM {events})
    WHERE channel_code IS NOT NULL
    UNION ALL SELECT -1, 'UNKNOWN'"""


def _snapshot(events: str, channels: str) -> str:
    keys = ", ".join(
        f"CAST(strftime({m}_at, '%Y%m%d') AS INTEGER) AS {m}_date_key" for m in ("started", "submitted", "completed")
    )
    return f"""
    SELECT p.application_id, coalesce(a.application_key, -1) AS application_key,
           coalesce(o.applicant_key, -1) AS applicant_key, coalesce(c.channel_key, -1) AS channel_key, {keys},
           started_at, submitted_at, completed_at, application_status, decision, rejection_reason,
           date_diff('second', started_at, submitted_at) AS seconds_to_submit,
           date_diff('second', started_at, completed_at) AS seconds_to_complete,
           coalesce(failures, 0) AS failure_event_count, coalesce(sessions, 0) AS session_count
    FROM stg_applications AS p
    LEFT JOIN (SELECT application_id, count(*) FILTER (event_outcome = 'FAILED') AS failures,
                      count(DISTINCT session_id) AS sessions FROM {events} GROUP BY application_id) AS h
           ON p.application_id = h.application_id
    LEFT JOIN dim_application AS a ON p.application_id = a.application_id
    LEFT JOIN dim_applicant AS o ON p.applicant_id = o.applicant_id AND o.applicant_key <> -1
    LEFT JOIN {channels} AS c ON p.source_channel = c.channel_code AND c.channel_key <> -1"""


_PARTS = {
    "raw_applicants": for_oracle(S.APPLICANTS),
    "raw_applications": for_oracle(S.APPLICATIONS),
    "raw_events": for_oracle(S.EVENTS),
    "untidy_events": for_oracle(S.UNTIDY_EVENTS),
    "clicks": for_oracle(S.CLICKS),
    "lines": for_oracle(S.LINES),
    "skewed_lines": for_oracle(S.SKEWED_LINES),
    "stg_applicants": "SELECT "
    + _cast(
        "applicants",
        marketing_campaign=_filled("marketing_campaign"),
        created_at=_time("created_at"),
        updated_at=_time("updated_at"),
    )
    + " FROM raw_applicants",
    "stg_applications": "SELECT "
    + _cast(
        "onboarding_applications",
        decision=_filled("decision"),
        rejection_reason=_filled("rejection_reason"),
        **{c: _time(c) for c in ("started_at", "submitted_at", "completed_at", "updated_at")},
    )
    + " FROM raw_applications",
    "stg_events": "SELECT "
    + _cast(
        "onboarding_events",
        event_sequence="CAST(event_sequence AS INTEGER)",
        event_timestamp=_time("event_timestamp"),
        **{c: _filled(c) for c in ("from_status", "failure_reason", "event_metadata")},
    )
    + " FROM raw_events",
    "read_applications": "SELECT *, "
    + ", ".join(f"TRY_CAST({c} AS TIMESTAMP) AS {c}_read" for c in ("started_at", "submitted_at", "completed_at"))
    + " FROM (SELECT "
    + ", ".join(f"{_filled(c)} AS {c}" for c in V.SOURCE_COLUMNS["onboarding_applications"])
    + " FROM raw_applications)",
    "read_text_events": "SELECT "
    + ", ".join(f"{_filled(c)} AS {c}" for c in V.SOURCE_COLUMNS["onboarding_events"])
    + " FROM untidy_events",
    "read_events": "SELECT "
    + _cast(
        "onboarding_events",
        event_sequence="TRY_CAST(event_sequence AS DOUBLE)",
        event_timestamp="TRY_CAST(event_timestamp AS TIMESTAMP)",
    )
    + " FROM read_text_events",
    "dim_channel": _channels("stg_events"),
    "click_channel": _channels("clicks"),
    "line_channel": _channels("lines"),
    "dim_applicant": """
    SELECT row_number() OVER (ORDER BY applicant_id) AS applicant_key, applicant_id, applicant_type, country_code,
           region, acquisition_channel, marketing_campaign, preferred_language FROM stg_applicants
    UNION ALL SELECT -1, 'UNKNOWN', NULL, NULL, NULL, NULL, NULL, NULL""",
    "dim_application": """
    SELECT row_number() OVER (ORDER BY application_id) AS application_key, application_id, application_type,
           device_type, current_step FROM stg_applications""",
    "dim_date": _calendar("stg_events", "event_timestamp"),
    "ship_date": _calendar("lineitem", "l_shipdate"),
    "events_fact": _event_fact("stg_events", "dim_channel"),
    "skewed_channel": _channels("skewed_lines"),
    "skewed_fact": _event_fact("skewed_lines", "skewed_channel"),
    "skewed_neighbours": _neighbours("skewed_lines"),
    "clicks_fact": _event_fact("clicks", "click_channel"),
    "snapshot": _snapshot("stg_events", "dim_channel"),
    "lines_snapshot": _snapshot("lines", "line_channel"),
    "crowded_applications": f"SELECT * REPLACE ({S.CROWDED['applicant_id']}) FROM stg_applications",
    "crowded_snapshot": _snapshot("stg_events", "dim_channel").replace("stg_applications", "crowded_applications"),
    "event_neighbours": _neighbours("stg_events"),
    "click_neighbours": _neighbours("clicks"),
    "line_neighbours": _neighbours("lines"),
    "read_neighbours": _neighbours("read_events"),
    "event_latest": _latest("stg_events", "LAST"),
    "line_latest": _latest("lines", "LAST"),
    "read_latest": _latest("read_events", "FIRST"),
    "event_milestones": _milestones("stg_events"),
    "line_milestones": _milestones("lines"),
}


def _sql(final: str) -> str:
    """``final`` behind the parts it mentions, directly or not."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in _PARTS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(_PARTS[name])

    visit(final)
    parts = ",\n".join(f"{name} AS ({sql})" for name, sql in _PARTS.items() if name in needed)
    return f"WITH {parts}\n{final}" if parts else final


def _counts(table: str, rules: dict[str, str]) -> str:
    """Rows of ``table`` per rule as (check_name, bad_count)."""
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS check_name, count(*) AS bad_count FROM {table} WHERE {condition}"
        for name, condition in rules.items()
    )


def _all(*parts: str) -> str:
    return "\nUNION ALL\n".join(parts)


def _scalar(name: str, sql: str) -> str:
    return f"SELECT '{name}' AS check_name, CAST(coalesce(({sql}), 0) AS BIGINT) AS bad_count"


def _duplicates(name: str, table: str, key: str) -> str:
    return _scalar(name, f"SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)")


def _orphans(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return _scalar(
        name,
        f"SELECT count(*) FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key})",
    )


def _unaccepted(column: str, values) -> str:
    return f"{column} IS NOT NULL AND NOT list_contains([{_listed(values)[1:-1]}], {column})"


def _missing(source: str) -> str:
    return " OR ".join(f"{c} IS NULL" for c in V.STAGED_REQUIRED[source])


_FIRST_EVENT = (
    "event_sequence = 1 AND NOT (event_type = 'APPLICATION_CREATED' AND from_status IS NULL AND to_status = 'STARTED')"
)
_ALLOWED = _listed(f"{a}>{b}" for a, b in V.TRANSITIONS)
_TRANSITION = f"event_sequence > 1 AND coalesce(from_status || '>' || to_status, '?') NOT IN {_ALLOWED}"
_NOT_INCREASING = "event_sequence <= p_number"
_NOT_LATER = "event_timestamp <= p_time"
_BROKEN_STATUS = "p_status IS NOT NULL AND from_status IS DISTINCT FROM p_status"
_AFTER_END = f"p_status IN {_listed(V.TERMINAL_STATUSES)}"
_HISTORY = {
    "event_sequence_increases": _NOT_INCREASING,
    "event_timestamp_increases": _NOT_LATER,
    "from_status_continues": _BROKEN_STATUS,
    "nothing_after_terminal": _AFTER_END,
}
_MILESTONES = "started_at > least(submitted_at, completed_at, updated_at) OR submitted_at > completed_at"
_LAST_STATE = "onboarding_applications.application_status.matches_last_event"


def _state_checks(latest: str, milestones: str) -> str:
    return _all(
        _scalar(
            "state_matches_latest_event",
            f"""SELECT count(*) FROM stg_applications a JOIN {latest} l ON a.application_id = l.application_id
                WHERE NOT (a.application_status = l.to_status AND a.current_step = l.step_name
                           AND a.updated_at = l.event_timestamp)""",
        ),
        _scalar(
            "milestones_match_events",
            f"""SELECT count(*) FROM stg_applications a JOIN {milestones} m ON a.application_id = m.application_id
                WHERE (a.submitted_at, a.completed_at)
                      IS DISTINCT FROM (m.submitted_event_at, m.terminal_event_at)""",
        ),
    )


def _last_state(applications: str, latest: str) -> str:
    settled = _listed(["SUBMITTED", *V.TERMINAL_STATUSES])
    return _scalar(
        _LAST_STATE,
        f"""SELECT count(*) FROM {applications} a LEFT JOIN {latest} l ON a.application_id = l.application_id
            WHERE l.application_id IS NULL
               OR (l.to_status IS NOT NULL AND a.application_status IN {settled}
                   AND l.to_status IS DISTINCT FROM a.application_status
                   AND l.to_status IS DISTINCT FROM a.current_step)""",
    )


def _history_rules(events: str, neighbours: str) -> str:
    return _all(
        _scalar(
            "onboarding_events.event_sequence.contiguous",
            f"""SELECT count(*) FROM (
                  SELECT application_id, list_sort(list(event_sequence) FILTER (event_sequence IS NOT NULL)) AS numbers
                  FROM {events} WHERE application_id IS NOT NULL GROUP BY application_id)
                WHERE numbers IS DISTINCT FROM range(1, len(numbers) + 1) AND len(numbers) > 0""",
        ),
        _scalar(
            "onboarding_events.event_timestamp.increasing",
            f"""SELECT count(DISTINCT application_id) FROM {neighbours}
                WHERE event_timestamp IS NULL OR event_timestamp <= p_time""",
        ),
    )


_DECIDED, _TERMINAL = _listed(V.DECIDED_STATUSES), _listed(V.TERMINAL_STATUSES)
_STATUS_RULES = {
    "onboarding_applications.decision.only_when_decided": "decision IS NOT NULL AND"
    f" (application_status IS NULL OR application_status NOT IN {_DECIDED})",
    "onboarding_applications.decision.present_when_decided": f"application_status IN {_DECIDED} AND decision IS NULL",
    "onboarding_applications.submitted_at.present": f"application_status IN {_listed(V.SUBMITTED_STATUSES)}"
    " AND submitted_at_read IS NULL",
    "onboarding_applications.completed_at.present": f"application_status IN {_TERMINAL} AND completed_at_read IS NULL",
    "onboarding_applications.completed_at.absent": "completed_at_read IS NOT NULL AND"
    f" (application_status IS NULL OR application_status NOT IN {_TERMINAL})",
}
_ORDERED = {
    "onboarding_applications.milestones.ordered": "submitted_at_read < started_at_read"
    " OR completed_at_read < submitted_at_read OR (submitted_at_read IS NULL AND completed_at_read < started_at_read)"
}
_RAW = {
    "applicants": "raw_applicants",
    "onboarding_applications": "raw_applications",
    "onboarding_events": "raw_events",
}
_READ = {
    "applicants": "raw_applicants",
    "onboarding_applications": "read_applications",
    "onboarding_events": "read_text_events",
}


def _required(source: str) -> str:
    return _counts(
        _READ[source], {f"{source}.{c}.required": f"coalesce({c}, '') = ''" for c in V.REPORT_REQUIRED[source]}
    )


def _volumes() -> str:
    rows = [
        _scalar(f"{s}.row_count.minimum", f"SELECT greatest({n} - count(*), 0) FROM {_READ[s]}")
        for s, n in V.MIN_ROWS.items()
    ]
    # Full days: the part of a day that is left over does not count.
    span = "date_sub('day', min(event_timestamp), max(event_timestamp))"
    return _all(
        *rows,
        _scalar(
            "onboarding_events.event_timestamp.span",
            f"SELECT CASE WHEN count(event_timestamp) = 0 THEN {V.MIN_EVENT_SPAN_DAYS}"
            f" ELSE greatest({V.MIN_EVENT_SPAN_DAYS} - {span}, 0) END FROM read_events",
        ),
    )


def _duplicate_rows(name: str, table: str, key: str) -> str:
    return _scalar(name, f"SELECT sum(n) FROM (SELECT count(*) AS n FROM {table} GROUP BY {key}) WHERE n > 1")


def _report() -> str:
    return _all(
        _volumes(),
        *[_duplicate_rows(f"{s}.{k}.unique", _READ[s], k) for s, k in V.PRIMARY_KEYS.items()],
        *[_required(s) for s in V.SOURCE_COLUMNS],
        _orphans(
            "onboarding_applications.applicant_id.exists",
            "read_applications",
            "applicant_id",
            "raw_applicants",
            "applicant_id",
        ),
        _orphans(
            "onboarding_events.application_id.exists",
            "read_text_events",
            "application_id",
            "raw_applications",
            "application_id",
        ),
        _counts(
            "raw_applicants",
            {"applicants.applicant_type.accepted": _unaccepted("applicant_type", V.APPLICANT_TYPES)},
        ),
        _counts(
            "read_applications",
            {
                "onboarding_applications.application_status.accepted": _unaccepted(
                    "application_status", V.APPLICATION_STATUSES
                )
            }
            | _STATUS_RULES
            | _ORDERED,
        ),
        _counts(
            "read_text_events",
            {
                "onboarding_events.event_outcome.accepted": _unaccepted("event_outcome", V.EVENT_OUTCOMES),
                "onboarding_events.event_metadata.json": "event_metadata IS NOT NULL AND NOT json_valid(event_metadata)",
            },
        ),
        _history_rules("read_events", "read_neighbours"),
        _last_state("read_applications", "read_latest"),
    )


def _offenders() -> str:
    """The first five keys per rule of the report that judges rows, as (check_name, place, key)."""
    rules = {
        source: {f"{source}.{c}.required": f"coalesce({c}, '') = ''" for c in V.REPORT_REQUIRED[source]}
        | {f"{source}.{key}.unique": f"{key} IN (SELECT {key} FROM {_READ[source]} GROUP BY {key} HAVING count(*) > 1)"}
        for source, key in V.PRIMARY_KEYS.items()
    }
    rules["applicants"]["applicants.applicant_type.accepted"] = _unaccepted("applicant_type", V.APPLICANT_TYPES)
    rules["onboarding_applications"] |= (
        {
            "onboarding_applications.application_status.accepted": _unaccepted(
                "application_status", V.APPLICATION_STATUSES
            ),
            "onboarding_applications.applicant_id.exists": "NOT EXISTS (SELECT 1 FROM raw_applicants p"
            " WHERE p.applicant_id = t.applicant_id)",
            _LAST_STATE: f"""NOT EXISTS (SELECT 1 FROM read_latest l WHERE l.application_id = t.application_id)
                OR application_status IN {_listed(["SUBMITTED", *V.TERMINAL_STATUSES])} AND EXISTS (
                    SELECT 1 FROM read_latest l WHERE l.application_id = t.application_id AND l.to_status IS NOT NULL
                    AND l.to_status IS DISTINCT FROM t.application_status
                    AND l.to_status IS DISTINCT FROM t.current_step)""",
        }
        | _STATUS_RULES
        | _ORDERED
    )
    rules["onboarding_events"] |= {
        "onboarding_events.event_outcome.accepted": _unaccepted("event_outcome", V.EVENT_OUTCOMES),
        "onboarding_events.event_metadata.json": "event_metadata IS NOT NULL AND NOT json_valid(event_metadata)",
        "onboarding_events.application_id.exists": "NOT EXISTS (SELECT 1 FROM raw_applications p"
        " WHERE p.application_id = t.application_id)",
    }
    found = [
        f"SELECT '{name}' AS check_name, {V.PRIMARY_KEYS[source]} AS key FROM {_READ[source]} AS t WHERE {condition}"
        for source, own in rules.items()
        for name, condition in own.items()
    ]
    found.append(
        """SELECT 'onboarding_events.event_sequence.contiguous' AS check_name, application_id AS key FROM (
             SELECT application_id, list_sort(list(event_sequence) FILTER (event_sequence IS NOT NULL)) AS numbers
             FROM read_events WHERE application_id IS NOT NULL GROUP BY application_id)
           WHERE numbers IS DISTINCT FROM range(1, len(numbers) + 1) AND len(numbers) > 0"""
    )
    found.append(
        """SELECT DISTINCT 'onboarding_events.event_timestamp.increasing' AS check_name, application_id AS key
           FROM read_neighbours WHERE application_id IS NOT NULL
             AND (event_timestamp IS NULL OR event_timestamp <= p_time)"""
    )
    return f"""SELECT check_name, CAST(place AS INTEGER) AS place, key FROM (
        SELECT *, row_number() OVER (PARTITION BY check_name ORDER BY key NULLS LAST) AS place FROM ({_all(*found)}))
    WHERE place <= 5"""


_STAGING_GATE = _all(
    _duplicates("applicant_id_unique", "stg_applicants", "applicant_id"),
    _duplicates("application_id_unique", "stg_applications", "application_id"),
    _duplicates("event_id_unique", "stg_events", "event_id"),
    _orphans("application_applicant_exists", "stg_applications", "applicant_id", "stg_applicants", "applicant_id"),
    _orphans("event_application_exists", "stg_events", "application_id", "stg_applications", "application_id"),
    _counts(
        "stg_applicants",
        {
            "applicant_type_accepted": _unaccepted("applicant_type", V.APPLICANT_TYPES),
            "applicants_required": _missing("applicants"),
        },
    ),
    _counts(
        "stg_applications",
        {
            "application_status_accepted": _unaccepted("application_status", V.APPLICATION_STATUSES),
            "application_type_accepted": _unaccepted("application_type", V.APPLICATION_TYPES),
            "source_channel_accepted": _unaccepted("source_channel", V.SOURCE_CHANNELS),
            "device_type_accepted": _unaccepted("device_type", V.DEVICE_TYPES),
            "decision_only_when_decided": f"decision IS NOT NULL AND application_status NOT IN {_DECIDED}",
            "applications_required": _missing("onboarding_applications"),
            "milestones_in_order": _MILESTONES,
        },
    ),
    _counts(
        "stg_events",
        {
            "event_outcome_accepted": _unaccepted("event_outcome", V.EVENT_OUTCOMES),
            "event_type_accepted": _unaccepted("event_type", V.EVENT_TYPES),
            "event_metadata_json": "event_metadata IS NOT NULL AND NOT json_valid(event_metadata)",
            "events_required": _missing("onboarding_events"),
            "first_event_creates": _FIRST_EVENT,
            "transition_allowed": _TRANSITION,
        },
    ),
    _counts("event_neighbours", _HISTORY),
    _state_checks("event_latest", "event_milestones"),
)


def _surplus(table: str, key: str) -> str:
    return f"(SELECT count(*) - count(DISTINCT {key}) FROM {table})"


_NO_DATE = "NOT IN (SELECT date_key FROM dim_date)"
_MARTS_GATE = _all(
    _duplicates("snapshot_application_unique", "snapshot", "application_id"),
    _scalar(
        "event_application_key_exists",
        """SELECT count(*) FROM events_fact WHERE application_key <> -1
           AND application_key NOT IN (SELECT application_key FROM dim_application)""",
    ),
    _scalar(
        "snapshot_rows_match_staging",
        "SELECT abs((SELECT count(*) FROM snapshot) - (SELECT count(*) FROM stg_applications))",
    ),
    _counts("snapshot", {"seconds_to_complete_not_negative": "seconds_to_complete < 0"}),
    _duplicates("event_fact_event_unique", "events_fact", "event_id"),
    _scalar(
        "event_fact_rows_match_staging",
        "SELECT abs((SELECT count(*) FROM events_fact) - (SELECT count(*) FROM stg_events))",
    ),
    _scalar(
        "dimension_keys_unique",
        f"SELECT {_surplus('dim_applicant', 'applicant_key')} + {_surplus('dim_application', 'application_key')}"
        f" + {_surplus('dim_channel', 'channel_key')} + {_surplus('dim_date', 'date_key')}",
    ),
    _scalar(
        "date_key_exists",
        f"""SELECT (SELECT count(*) FROM events_fact WHERE date_key {_NO_DATE})
                 + (SELECT count(*) FROM snapshot WHERE started_date_key {_NO_DATE}
                    OR submitted_date_key {_NO_DATE} OR completed_date_key {_NO_DATE})""",
    ),
)

_FUNNEL = """
SELECT calendar_date, channel_code, application_type,
       count(DISTINCT f.application_id) AS applications_started,
       count(DISTINCT f.application_id) FILTER (submitted_at IS NOT NULL) AS applications_submitted,
       count(DISTINCT f.application_id) FILTER (application_status = 'APPROVED') AS applications_approved,
       count(DISTINCT f.application_id) FILTER (application_status = 'REJECTED') AS applications_rejected,
       count(DISTINCT f.application_id) FILTER (application_status = 'ABANDONED') AS applications_abandoned
FROM snapshot f
JOIN dim_date d ON f.started_date_key = d.date_key
JOIN dim_channel c ON f.channel_key = c.channel_key
JOIN dim_application a ON f.application_key = a.application_key
GROUP BY ALL ORDER BY ALL"""

_JSON_VARIANTS = {
    "as_is": "props",
    "text_after": "props || ' x'",
    "cut_off": "left(props, length(props) - 1)",
    "two_values": "props || props",
    "closes_wrapper": "props || '],[' || props",
    "in_list": "'[' || props || ', null]'",
}

_JSON_LIMITS = {
    "deep": "repeat('[', 1010) || '\"' || c_name || '\"' || repeat(']', 1010)",
    "deep_open": "repeat('[', 1010) || '\"' || c_name || '\"' || repeat(']', 1009)",
    "deep_objects": "repeat('{\"a\": ', 1010) || c_custkey || repeat('}', 1010)",
    "long_number": "c_custkey || repeat('7', 1010)",
    "long_no_number": "c_custkey || repeat('7', 1010) || '.'",
}

ORACLE = {
    "staging_applicants": _sql("SELECT * FROM stg_applicants"),
    "staging_typed": _sql("SELECT * FROM stg_applications"),
    "staging_events": _sql("SELECT * FROM stg_events"),
    "lenient_parse": _sql(
        "SELECT event_id, event_sequence AS event_sequence_read, event_timestamp AS event_timestamp_read"
        " FROM read_events"
    ),
    "csv_ingest": _sql(
        "SELECT " + ", ".join(f"{_filled(c)} AS {c}" for c in V.SOURCE_COLUMNS["onboarding_events"]) + " FROM raw_events"
    ),
    "csv_line_breaks": _sql(
        f"SELECT {_filled('event_id')} AS event_id, {_filled('to_status')} AS to_status,"
        " event_metadata || ',' || chr(10) || '\"' || event_id || '\"' || chr(13) || chr(10) || chr(10) || '.' AS event_metadata"
        " FROM raw_events"
    ),
    "ingest_counts": _sql(
        _all(*[f"SELECT '{source}' AS source, count(*) AS row_count FROM {raw}" for source, raw in _RAW.items()])
    ),
    "report_figures": _sql(
        _all(
            "SELECT 'applicants' AS source, count(*) AS row_count, CAST(NULL AS BIGINT) AS span_days,"
            " CAST(NULL AS DATE) AS first_date, CAST(NULL AS DATE) AS last_date FROM raw_applicants",
            "SELECT 'onboarding_applications', count(*), NULL, NULL, NULL FROM raw_applications",
            "SELECT 'onboarding_events', count(*), date_sub('day', min(event_timestamp), max(event_timestamp)),"
            " CAST(min(event_timestamp) AS DATE), CAST(max(event_timestamp) AS DATE) FROM read_events",
        )
    ),
    "parquet_export": _sql(_FUNNEL),
    "calendar_dim": _sql("SELECT * FROM ship_date"),
    "channel_dim": _sql("SELECT * FROM dim_channel"),
    "applicant_dim": _sql("SELECT * FROM dim_applicant"),
    "application_dim": _sql("SELECT * FROM dim_application"),
    "event_fact": _sql("SELECT * FROM events_fact"),
    "event_fact_in_pieces": _sql("SELECT * FROM skewed_fact"),
    "application_dim_in_pieces": _sql("SELECT * FROM dim_application"),
    "event_history_in_pieces": _sql(_counts("skewed_neighbours", _HISTORY)),
    "event_fact_gap": _sql("SELECT * FROM clicks_fact"),
    "application_snapshot": _sql("SELECT * FROM snapshot"),
    "snapshot_of_crowded_applicants": _sql("SELECT * FROM crowded_snapshot"),
    "order_line_snapshot": _sql("SELECT * FROM lines_snapshot"),
    "funnel_by_date_channel": _sql(_FUNNEL),
    "funnel_on_checked_grain": _sql(_FUNNEL),
    "duration_failure_by_channel": _sql(
        """
SELECT channel_code, application_type, count(*) AS n_applications,
       avg(seconds_to_submit) / 60.0 AS avg_minutes_to_submit,
       avg(seconds_to_complete) FILTER (decision IS NOT NULL) / 60.0 AS avg_minutes_to_decision,
       avg(failure_event_count) AS avg_failure_events,
       avg(session_count) AS avg_sessions,
       count(*) FILTER (application_status = 'ABANDONED') / CAST(count(*) AS DOUBLE) AS abandonment_rate
FROM snapshot f
JOIN dim_channel c ON f.channel_key = c.channel_key
JOIN dim_application a ON f.application_key = a.application_key
GROUP BY ALL ORDER BY ALL"""
    ),
    "step_time": _sql(
        "SELECT step_name, count(*) AS n_events, avg(seconds_since_prev_event) AS avg_seconds"
        " FROM clicks_fact GROUP BY step_name"
    ),
    "latest_event": _sql(
        "SELECT application_id, arg_max(event_id, event_sequence) AS event_id,"
        " arg_max(event_type, event_sequence) AS event_type, max(event_timestamp) AS event_timestamp"
        " FROM clicks GROUP BY application_id"
    ),
    "previous_event": _sql(
        """
SELECT event_id, lag(event_timestamp) OVER n AS previous_timestamp, lag(to_status) OVER n AS previous_to_status,
       lag(event_sequence) OVER t AS previous_sequence
FROM lines
WINDOW n AS (PARTITION BY application_id ORDER BY event_sequence, event_timestamp, event_id),
       t AS (PARTITION BY application_id ORDER BY event_timestamp, event_sequence, event_id)"""
    ),
    "milestones": _sql("SELECT * FROM line_milestones"),
    "sequence_check": _sql(_counts("line_neighbours", _HISTORY)),
    "contiguity_check": _sql(_history_rules("lines", "line_neighbours")),
    "first_event_check": _sql(_counts("stg_events", {"first_event_creates": _FIRST_EVENT})),
    "transition_check": _sql(
        _all(
            _counts("clicks", {"transition_allowed": _TRANSITION}),
            _counts("click_neighbours", {"from_status_continues": _BROKEN_STATUS}),
        )
    ),
    "terminal_check": _sql(_counts("click_neighbours", {"nothing_after_terminal": _AFTER_END})),
    "latest_state_check": _sql(
        _all(_state_checks("line_latest", "line_milestones"), _last_state("stg_applications", "line_latest"))
    ),
    "status_rule_check": _sql(_counts("read_applications", _STATUS_RULES)),
    "milestone_order_check": _sql(
        _all(
            _counts("stg_applications", {"milestones_in_order": _MILESTONES}),
            _counts("read_applications", _ORDERED),
            _scalar(
                "seconds_to_last_line_not_negative",
                "SELECT count(*) FROM stg_applications a JOIN line_milestones m"
                " ON a.application_id = m.application_id WHERE date_diff('second', started_at, terminal_event_at) < 0",
            ),
        )
    ),
    "uniqueness_check": _sql(
        _all(
            _duplicates("line_groups", "lineitem", "l_orderkey, l_linenumber"),
            _duplicate_rows("line_rows", "lineitem", "l_orderkey, l_linenumber"),
            _scalar("line_surplus", "SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem"),
            _duplicates("event_id_unique", "stg_events", "event_id"),
        )
    ),
    "orphan_check": _sql(
        _all(
            _orphans("orders_without_lines", "orders", "o_orderkey", "lineitem", "l_orderkey"),
            _orphans("lines_without_order", "lineitem", "l_orderkey", "orders", "o_orderkey"),
            _orphans("events_without_parent", "stg_events", "application_id", "stg_applications", "application_id"),
        )
    ),
    "accepted_values_check": _all(
        _counts("orders", {"order_status": _unaccepted("o_orderstatus", ["F", "O"])}),
        _counts("events", {"event_type": _unaccepted("event_type", ["signup", "view"])}),
        _counts("lineitem", {"return_flag": _unaccepted("l_returnflag", ["A", "N"])}),
    ),
    "required_fields_check": _sql(_all(*[_required(s) for s in V.SOURCE_COLUMNS])),
    "json_validity_check": _all(
        *[
            f"SELECT event_id, '{name}' AS variant, json_valid({text}) AS valid FROM events"
            for name, text in _JSON_VARIANTS.items()
        ]
    ),
    "json_limits_check": _all(
        *[
            f"SELECT c_custkey, '{name}' AS variant, json_valid({text}) AS valid FROM customer"
            for name, text in _JSON_LIMITS.items()
        ]
    ),
    "time_text_parse": (
        "SELECT o_orderkey, date_trunc('second', o_orderdate) AS slashes,"
        " CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS blanks, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS digits,"
        " CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS month_first, CAST(NULL AS TIMESTAMP) AS year_only FROM orders"
    ),
    "number_text_parse": (
        "SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS blanks, CAST(o_orderkey || '.5e1' AS DOUBLE) AS exponent,"
        " CAST(NULL AS DOUBLE) AS suffix_d, CAST(NULL AS DOUBLE) AS suffix_f, CAST(NULL AS DOUBLE) AS hex FROM orders"
    ),
    "offending_sample": _sql(
        "SELECT event_id, application_id, event_outcome FROM read_text_events"
        f" WHERE {_unaccepted('event_outcome', V.EVENT_OUTCOMES)} ORDER BY event_id LIMIT 5"
    ),
    "offenders_by_rule": _sql(_offenders()),
    "offending_references": _sql(
        "SELECT application_id, applicant_id FROM read_applications a"
        " WHERE NOT EXISTS (SELECT 1 FROM raw_applicants p WHERE p.applicant_id = a.applicant_id)"
    ),
    "rowcount_check": _sql(
        _all(
            _scalar("row_gap", "SELECT abs((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders))"),
            _volumes(),
        )
    ),
    "date_key_check": _sql(
        _all(
            _scalar(
                "ordered",
                "SELECT count(*) FROM orders WHERE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER)"
                " NOT IN (SELECT date_key FROM ship_date)",
            ),
            _scalar(
                "shipped",
                "SELECT count(*) FROM lineitem WHERE CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER)"
                " NOT IN (SELECT date_key FROM ship_date)",
            ),
        )
    ),
    "staging_gate": _sql(_STAGING_GATE),
    "marts_gate": _sql(_MARTS_GATE),
    "extra_checks": _sql(
        _all(
            _counts("stg_applications", {"updated_not_before_completed": "updated_at < completed_at"}),
            _counts("snapshot", {"seconds_to_submit_not_negative": "seconds_to_submit < 0"}),
            _counts("events_fact", {"seconds_since_prev_not_negative": "seconds_since_prev_event < 0"}),
            _scalar(
                "snapshot_application_key_exists",
                """SELECT count(*) FROM snapshot WHERE application_key <> -1
                   AND application_key NOT IN (SELECT application_key FROM dim_application)""",
            ),
        )
    ),
    "quality_report": _sql(
        f"SELECT check_name, CASE WHEN bad_count > 0 THEN 'FAIL' ELSE 'PASS' END AS status, bad_count FROM ({_report()})"
    ),
    "report_totals": _sql(
        "SELECT count(*) FILTER (bad_count = 0) AS passed, count(*) FILTER (bad_count > 0) AS failed,"
        f" count(*) AS total FROM ({_report()})"
    ),
}
