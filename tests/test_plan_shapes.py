"""Properties of the physical plans that decide how the work scales."""

from pyspark.sql import functions as F

from admitflow.plans import facts, gates, outcomes
from admitflow.plans.history import event_history
from admitflow.operators import counting
from workload.queries import QUERIES, store
from workload.standins import StandIns

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_event_history_shuffles_events_once(spark):
    events = store(StandIns(spark, SF).events, "events")
    text = plan(event_history(events))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Window [") == 3
    assert text.count("SortAggregate") <= 2  # no extra levels for a distinct count
    assert "event_metadata" not in text  # columns that are not needed are not read


def test_unneeded_parts_of_the_history_vanish(spark):
    events = store(StandIns(spark, SF).events, "events")
    text = plan(event_history(events).select("application_id", "failure_event_count"))
    assert "Window [" not in text and "session_id" not in text


def test_event_fact_lookups_add_no_shuffle_of_events(spark):
    s = StandIns(spark, SF)
    events = store(s.events, "events")
    application = spark.range(10).selectExpr("id AS application_key", "concat('P', id) AS application_id")
    channel = spark.createDataFrame([(1, "WEB")], "channel_key bigint, channel_code string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(facts.event_fact(events, application, channel))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2  # events and applications, both by application
    assert "BroadcastHashJoin" in text  # channels, counted small


def test_orphans_use_an_anti_join_on_counted_keys(spark):
    s = StandIns(spark, SF)
    text = plan(counting.orphans(s.table("lineitem"), "l_orderkey", s.table("orders"), "o_orderkey", "x"))
    assert "LeftAnti" in text and "NestedLoop" not in text


def test_date_keys_avoid_nested_loops(spark):
    s = StandIns(spark, SF)
    orders = s.table("orders").select(F.col("o_custkey").alias("a"), F.col("o_orderkey").alias("b"))
    text = plan(gates.unmatched_keys(orders, ["a", "b"], s.table("customer"), "c_custkey"))
    assert "NestedLoop" not in text and "CartesianProduct" not in text


def test_funnel_needs_no_expand(spark):
    snapshot = spark.createDataFrame(
        [],
        "application_id string, application_key bigint, channel_key bigint, started_date_key int,"
        " submitted_at timestamp_ntz, application_status string",
    )
    application = spark.range(1).selectExpr("id AS application_key", "'S' AS application_type")
    date = spark.range(1).selectExpr("int(id) AS date_key", "DATE'2025-01-01' AS calendar_date")
    channel = spark.range(1).selectExpr("id AS channel_key", "'WEB' AS channel_code")
    assert "Expand" not in plan(outcomes.funnel(snapshot, application, date, channel))


def test_json_limits_texts_are_made_by_many_tasks(spark, tmp_path):
    customers = spark.range(5000).selectExpr("id AS c_custkey", "concat('Customer', id) AS c_name")
    customers.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    found = QUERIES["json_limits_check"](spark, str(tmp_path))
    assert found.count() == 25_000
    assert found.select(F.spark_partition_id()).distinct().count() == 3
