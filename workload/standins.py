"""Application-process tables derived from the driver's tables.

The text of each table is plain SQL that Spark and the comparison engine both run; ``@name`` stands for a driver
table. Orders play the applications, customers the applicants. An order's status and priority choose one of a few
courses, whose steps become its events. Small bands of the total price carry one kind of fault each, so that every
check has something to count.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from admitflow.plans import report, staging

APPLICANTS = """
SELECT concat('C', c_custkey) AS applicant_id,
       CASE WHEN c_acctbal > 9900 THEN 'TRUST'
            WHEN c_mktsegment IN ('MACHINERY', 'BUILDING') THEN 'BUSINESS'
            ELSE 'INDIVIDUAL' END AS applicant_type,
       n_name AS country_code,
       r_name AS region,
       c_mktsegment AS acquisition_channel,
       CASE WHEN c_acctbal > 5000 THEN 'SPRING' ELSE '' END AS marketing_campaign,
       CASE WHEN c_acctbal < -900 THEN NULL WHEN n_regionkey = 2 THEN 'th' ELSE 'en' END AS preferred_language,
       CAST(CAST('1994-01-01 00:00:00' AS TIMESTAMP) + INTERVAL '1' MINUTE * c_custkey AS STRING) AS created_at,
       CAST(CAST('1994-02-01 12:30:15' AS TIMESTAMP) + INTERVAL '1' MINUTE * c_custkey AS STRING) AS updated_at
FROM @customer
JOIN @nation ON c_nationkey = n_nationkey
JOIN @region ON n_regionkey = r_regionkey
"""


# One applicant with a third of all applications, and many applications without one.
CROWDED = {
    "applicant_id": "CASE WHEN CAST(substring(application_id, 2) AS bigint) % 3 = 0 THEN 'C1'"
    " WHEN CAST(substring(application_id, 2) AS bigint) % 7 = 0 THEN NULL ELSE applicant_id END AS applicant_id"
}


def _band(start: int) -> str:
    return f"o_totalprice >= {start} AND o_totalprice < {start + 2000}"


# Minutes from the start until submission, end and latest event, times the order's pace.
_COURSES = """
    SELECT * FROM (VALUES
        ('APPROVED', 40, 1600, 1600, 'APPROVED', 'APPROVED', '', 'DECISION'),
        ('REJECTED', 25, 700, 700, 'REJECTED', 'REJECTED', 'INCOMPLETE', 'DECISION'),
        ('SUBMITTED', 33, NULL, 33, 'SUBMITTED', '', '', 'REVIEW'),
        ('IN_PROGRESS', NULL, NULL, 3000, 'IN_PROGRESS', '', '', 'PROFILE'),
        ('STARTED', NULL, NULL, 0, 'STARTED', '', '', 'START'),
        ('EARLY_EXIT', NULL, 90, 90, 'ABANDONED', '', '', 'PROFILE'),
        ('LATE_EXIT', 12, 5000, 5000, 'ABANDONED', '', '', 'REVIEW'),
        ('RETURNED', NULL, 90, 5000, 'ABANDONED', '', '', 'PROFILE')
    ) AS c(course, submit_after, end_after, last_after, status, decision, reason, step)
"""

_STEPS = """
    SELECT * FROM (VALUES
        ('APPROVED', 1, 'APPLICATION_CREATED', 'START', '', 'STARTED', 'SUCCESS', 0),
        ('APPROVED', 2, 'STEP_STARTED', 'PROFILE', 'STARTED', 'IN_PROGRESS', 'PENDING', 2),
        ('APPROVED', 3, 'STEP_FAILED', 'DOCUMENTS', 'IN_PROGRESS', 'IN_PROGRESS', 'FAILED', 9),
        ('APPROVED', 4, 'STEP_RETRIED', 'DOCUMENTS', 'IN_PROGRESS', 'IN_PROGRESS', 'PENDING', 15),
        ('APPROVED', 5, 'STEP_COMPLETED', 'REVIEW', 'IN_PROGRESS', 'SUBMITTED', 'SUCCESS', 40),
        ('APPROVED', 6, 'DECISION_RECORDED', 'DECISION', 'SUBMITTED', 'APPROVED', 'SUCCESS', 1600),
        ('REJECTED', 1, 'APPLICATION_CREATED', 'START', '', 'STARTED', 'SUCCESS', 0),
        ('REJECTED', 2, 'STEP_STARTED', 'PROFILE', 'STARTED', 'IN_PROGRESS', 'PENDING', 3),
        ('REJECTED', 3, 'STEP_COMPLETED', 'REVIEW', 'IN_PROGRESS', 'SUBMITTED', 'SUCCESS', 25),
        ('REJECTED', 4, 'DECISION_RECORDED', 'DECISION', 'SUBMITTED', 'REJECTED', 'SUCCESS', 700),
        ('SUBMITTED', 1, 'APPLICATION_CREATED', 'START', '', 'STARTED', 'SUCCESS', 0),
        ('SUBMITTED', 2, 'STEP_STARTED', 'PROFILE', 'STARTED', 'IN_PROGRESS', 'PENDING', 4),
        ('SUBMITTED', 3, 'STEP_COMPLETED', 'REVIEW', 'IN_PROGRESS', 'SUBMITTED', 'SUCCESS', 33),
        ('IN_PROGRESS', 1, 'APPLICATION_CREATED', 'START', '', 'STARTED', 'SUCCESS', 0),
        ('IN_PROGRESS', 2, 'STEP_STARTED', 'PROFILE', 'STARTED', 'IN_PROGRESS', 'PENDING', 7),
        ('IN_PROGRESS', 3, 'SESSION_RESUMED', 'PROFILE', 'IN_PROGRESS', 'IN_PROGRESS', 'PENDING', 3000),
        ('STARTED', 1, 'APPLICATION_CREATED', 'START', '', 'STARTED', 'SUCCESS', 0),
        ('EARLY_EXIT', 1, 'APPLICATION_CREATED', 'START', '', 'STARTED', 'SUCCESS', 0),
        ('EARLY_EXIT', 2, 'STEP_FAILED', 'PROFILE', 'STARTED', 'IN_PROGRESS', 'FAILED', 5),
        ('EARLY_EXIT', 3, 'APPLICATION_ABANDONED', 'PROFILE', 'IN_PROGRESS', 'ABANDONED', 'PENDING', 90),
        ('LATE_EXIT', 1, 'APPLICATION_CREATED', 'START', '', 'STARTED', 'SUCCESS', 0),
        ('LATE_EXIT', 2, 'STEP_STARTED', 'PROFILE', 'STARTED', 'IN_PROGRESS', 'PENDING', 1),
        ('LATE_EXIT', 3, 'STEP_COMPLETED', 'REVIEW', 'IN_PROGRESS', 'SUBMITTED', 'SUCCESS', 12),
        ('LATE_EXIT', 4, 'APPLICATION_ABANDONED', 'REVIEW', 'SUBMITTED', 'ABANDONED', 'PENDING', 5000),
        ('RETURNED', 1, 'APPLICATION_CREATED', 'START', '', 'STARTED', 'SUCCESS', 0),
        ('RETURNED', 2, 'STEP_STARTED', 'PROFILE', 'STARTED', 'IN_PROGRESS', 'PENDING', 6),
        ('RETURNED', 3, 'APPLICATION_ABANDONED', 'PROFILE', 'IN_PROGRESS', 'ABANDONED', 'PENDING', 90),
        ('RETURNED', 4, 'SESSION_RESUMED', 'PROFILE', 'ABANDONED', 'IN_PROGRESS', 'PENDING', 5000)
    ) AS s(course, seq, event_type, step_name, from_status, to_status, outcome, minutes)
"""

_CHANNEL = """CASE o_orderpriority WHEN '1-URGENT' THEN 'WEB' WHEN '2-HIGH' THEN 'MOBILE'
                    WHEN '3-MEDIUM' THEN 'PARTNER' WHEN '4-NOT SPECIFIED' THEN 'ASSISTED' ELSE 'WEB' END"""

_ORDERS = f"""
    SELECT *,
           CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'REJECTED'
                WHEN o_orderstatus = 'F' THEN 'APPROVED'
                WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'STARTED'
                WHEN o_orderstatus = 'O' AND o_orderpriority = '2-HIGH' THEN 'SUBMITTED'
                WHEN o_orderstatus = 'O' THEN 'IN_PROGRESS'
                WHEN {_band(230000)} THEN 'RETURNED'
                WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'EARLY_EXIT'
                ELSE 'LATE_EXIT' END AS course,
           1 + o_custkey % 7 AS pace
    FROM @orders
"""

APPLICATIONS = f"""
SELECT concat('P', o_orderkey) AS application_id,
       concat(CASE WHEN {_band(10000)} THEN 'X' ELSE 'C' END, o_custkey) AS applicant_id,
       CASE WHEN {_band(20000)} THEN 'LEGACY' WHEN o_totalprice < 150000 THEN 'STANDARD'
            WHEN o_totalprice < 300000 THEN 'PREMIUM' WHEN o_totalprice < 400000 THEN 'BUSINESS'
            ELSE 'PARTNER' END AS application_type,
       CASE WHEN {_band(30000)} THEN 'FAX' ELSE {_CHANNEL} END AS source_channel,
       CASE WHEN {_band(40000)} THEN 'TV' WHEN o_custkey % 3 = 0 THEN 'DESKTOP'
            WHEN o_custkey % 3 = 1 THEN 'MOBILE' ELSE 'TABLET' END AS device_type,
       CAST(o_orderdate AS STRING) AS started_at,
       CASE WHEN {_band(90000)} THEN CAST(o_orderdate - INTERVAL '1' HOUR AS STRING)
            ELSE coalesce(CAST(o_orderdate + INTERVAL '1' MINUTE * (submit_after * pace) AS STRING), '')
            END AS submitted_at,
       CASE WHEN {_band(100000)} THEN ''
            ELSE coalesce(CAST(o_orderdate + INTERVAL '1' MINUTE * (end_after * pace) AS STRING), '')
            END AS completed_at,
       CASE WHEN {_band(70000)} THEN NULL ELSE step END AS current_step,
       CASE WHEN {_band(50000)} THEN 'LOST' ELSE status END AS application_status,
       CASE WHEN {_band(60000)} THEN 'APPROVED' WHEN {_band(110000)} THEN '' ELSE decision END AS decision,
       reason AS rejection_reason,
       CASE WHEN {_band(80000)} THEN CAST(o_orderdate - INTERVAL '1' DAY AS STRING)
            ELSE CAST(o_orderdate + INTERVAL '1' MINUTE * (last_after * pace) AS STRING) END AS updated_at
FROM ({_ORDERS}) AS o
JOIN ({_COURSES}) AS k ON o.course = k.course
"""

EVENTS = f"""
SELECT concat('E', o_orderkey, '-', CASE WHEN seq = 2 AND {_band(190000)} THEN 1 ELSE seq END) AS event_id,
       concat(CASE WHEN seq = 2 AND {_band(180000)} THEN 'Z' ELSE 'P' END, o_orderkey) AS application_id,
       CAST(CASE WHEN seq > 1 AND {_band(210000)} THEN seq + 1 ELSE seq END AS STRING) AS event_sequence,
       CAST(o_orderdate + INTERVAL '1' MINUTE * (minutes * CASE WHEN {_band(140000)} THEN 0
            WHEN {_band(220000)} THEN -pace ELSE pace END) AS STRING) AS event_timestamp,
       CASE WHEN seq = 1 AND {_band(130000)} THEN 'NAP' ELSE event_type END AS event_type,
       step_name,
       CASE WHEN seq = 3 AND {_band(150000)} THEN '' ELSE from_status END AS from_status,
       CASE WHEN seq = 1 AND {_band(200000)} THEN 'IN_PROGRESS' ELSE to_status END AS to_status,
       CASE WHEN seq = 2 AND {_band(120000)} THEN 'BROKEN' ELSE outcome END AS event_outcome,
       CASE WHEN outcome = 'FAILED' THEN 'UNREADABLE' ELSE '' END AS failure_reason,
       CASE WHEN seq = 2 AND {_band(170000)} THEN NULL
            ELSE concat('S', o_orderkey, '-', CASE WHEN seq > 3 THEN 2 ELSE 1 END) END AS session_id,
       {_CHANNEL} AS source_channel,
       CASE WHEN seq = 2 AND {_band(160000)} THEN concat('{{"price": ', CAST(floor(o_totalprice) AS BIGINT), '}} x')
            WHEN seq > 2 THEN ''
            ELSE concat('{{"price": ', CAST(floor(o_totalprice) AS BIGINT), ', "note": "a,b"}}') END AS event_metadata
FROM ({_ORDERS}) AS o
JOIN ({_STEPS}) AS s ON o.course = s.course
"""

# Events some of whose times and numbers cannot be read.
UNTIDY_EVENTS = f"""
SELECT event_id, application_id,
       CASE WHEN event_type = 'STEP_RETRIED' AND event_metadata = '' AND session_id LIKE '%7-2' THEN 'n/a'
            WHEN event_type = 'STEP_COMPLETED' AND session_id LIKE '%3-1' THEN concat(event_sequence, '.0')
            ELSE event_sequence END AS event_sequence,
       CASE WHEN event_type = 'SESSION_RESUMED' AND session_id LIKE '%5-1' THEN 'soon'
            ELSE event_timestamp END AS event_timestamp,
       event_type, step_name, from_status, to_status, event_outcome, failure_reason, session_id, source_channel,
       event_metadata
FROM ({EVENTS}) AS e
"""

# The driver's event stream as an event log: one application per user, numbers follow event_id.
CLICKS = """
SELECT CAST(event_id AS STRING) AS event_id,
       concat('U', user_id) AS application_id,
       CAST(event_id + 1 AS INT) AS event_sequence,
       ts AS event_timestamp,
       event_type,
       CASE WHEN value < 10 THEN 'SHORT' WHEN value < 100 THEN 'MEDIUM' ELSE 'LONG' END AS step_name,
       CASE WHEN value < 5 THEN NULL WHEN value < 20 THEN 'STARTED' WHEN value < 60 THEN 'IN_PROGRESS'
            ELSE 'SUBMITTED' END AS from_status,
       CASE event_type WHEN 'signup' THEN 'STARTED' WHEN 'purchase' THEN 'APPROVED' WHEN 'error' THEN 'ABANDONED'
            WHEN 'click' THEN 'SUBMITTED' ELSE 'IN_PROGRESS' END AS to_status,
       CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'SUCCESS' ELSE 'PENDING' END AS event_outcome,
       CASE WHEN event_type = 'error' THEN 'ERROR' END AS failure_reason,
       CAST(CAST(ts AS DATE) AS STRING) AS session_id,
       CASE WHEN value < 30 THEN 'WEB' ELSE 'MOBILE' END AS source_channel,
       props AS event_metadata
FROM @events
"""

# Order lines as an event log of their order: numbers repeat and leave gaps, times are unrelated to them.
LINES = """
SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS event_id,
       concat('P', l_orderkey) AS application_id,
       l_linenumber AS event_sequence,
       l_shipdate AS event_timestamp,
       l_returnflag AS event_type,
       l_linestatus AS step_name,
       CASE l_linestatus WHEN 'F' THEN 'STARTED' ELSE 'IN_PROGRESS' END AS from_status,
       CASE l_returnflag WHEN 'R' THEN 'ABANDONED' WHEN 'A' THEN 'SUBMITTED' ELSE 'IN_PROGRESS' END AS to_status,
       CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS event_outcome,
       CAST(NULL AS STRING) AS failure_reason,
       concat('S', l_suppkey) AS session_id,
       'WEB' AS source_channel,
       CAST(NULL AS STRING) AS event_metadata
FROM @lineitem
"""

# One application with a seventh of all lines, and as many lines without any.
SKEWED_LINES = LINES.replace(
    "concat('P', l_orderkey)",
    "CASE l_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'P1' ELSE concat('P', l_orderkey) END",
)

TABLES = ["region", "nation", "customer", "orders", "lineitem", "events"]


def for_oracle(sql: str) -> str:
    return _bind(sql, lambda table: table)


def _bind(sql: str, name_of) -> str:
    for table in TABLES:
        sql = sql.replace(f"@{table}", name_of(table))
    return sql


class StandIns:
    """The derived tables over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def sql(self, text: str) -> DataFrame:
        def view(name: str) -> str:
            self.table(name).createOrReplaceTempView(f"standin_{name}")
            return f"standin_{name}"

        for name in TABLES:
            if f"@{name}" in text:
                text = text.replace(f"@{name}", view(name))
        return self.spark.sql(text)

    def raw(self, untidy: bool = False) -> dict[str, DataFrame]:
        return {
            "applicants": self.sql(APPLICANTS),
            "onboarding_applications": self.sql(APPLICATIONS),
            "onboarding_events": self.sql(UNTIDY_EVENTS if untidy else EVENTS),
        }

    @cached_property
    def applicants(self) -> DataFrame:
        return staging.stage(self.sql(APPLICANTS), "applicants")

    @cached_property
    def applications(self) -> DataFrame:
        return staging.stage(self.sql(APPLICATIONS), "onboarding_applications")

    @cached_property
    def crowded_applications(self) -> DataFrame:
        return self.applications.selectExpr(*[CROWDED.get(c, c) for c in self.applications.columns])

    @cached_property
    def events(self) -> DataFrame:
        return staging.stage(self.sql(EVENTS), "onboarding_events")

    @cached_property
    def clicks(self) -> DataFrame:
        return self.sql(CLICKS)

    @cached_property
    def lines(self) -> DataFrame:
        return self.sql(LINES)

    @cached_property
    def skewed_lines(self) -> DataFrame:
        return self.sql(SKEWED_LINES)

    @cached_property
    def extracts(self) -> report.Extracts:
        return report.Extracts.of(self.raw(untidy=True))
