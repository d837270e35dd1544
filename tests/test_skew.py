"""Hot keys are worked on in pieces and give the same results as one window or one task."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from admitflow.operators import keys, ordered, skew
from admitflow.plans import dimensions, facts
from admitflow.plans.history import event_history


@pytest.fixture
def limits(spark):
    def set_limits(hot_rows=None, piece_rows=None):
        for name, value in {skew.HOT_ROWS_CONF: hot_rows, keys.PIECE_ROWS_CONF: piece_rows}.items():
            if value is not None:
                spark.conf.set(name, str(value))

    yield set_limits
    spark.conf.unset(skew.HOT_ROWS_CONF)
    spark.conf.unset(keys.PIECE_ROWS_CONF)


def rows(df):
    return sorted(repr(r) for r in df.collect())


@pytest.fixture(scope="module")
def log(spark):
    """A third of all rows belongs to one key, some to no key; numbers repeat, are missing, and whole rows are copied."""
    pick = random.Random(7)
    data = []
    for i in range(3000):
        key = pick.choice(["hot", None if i % 2 else "hot", f"k{pick.randrange(200)}"])
        number = None if pick.random() < 0.02 else pick.randrange(400)
        data.append((key, number, pick.choice("abc")))
    data += [("hot", 17, "a")] * 300
    return spark.createDataFrame(data, "k string, n int, v string").repartition(5).cache()


def test_split_finds_exactly_the_hot_keys(spark, log, limits):
    assert skew.split(log, "k").hot is None
    limits(hot_rows=400)
    parts = skew.split(log, "k")
    assert set(parts.hot_keys) == {"hot", None}
    assert parts.cold.count() + parts.hot.count() == log.count()
    assert parts.cold.filter("k IS NULL OR k = 'hot'").isEmpty()
    assert parts.pieces >= 4


@pytest.mark.parametrize("times", [1, 2, 8])
def test_work_per_piece_stays_as_the_table_grows(log, limits, times):
    limits(hot_rows=400)
    larger = log.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times))))
    parts = skew.split(larger, "k")
    assert parts.hot.count() / parts.pieces <= 400
    assert parts.cold.groupBy("k").count().filter("count > 400").isEmpty()


def test_keys_are_counted_where_a_sketch_is_too_coarse(log, limits, monkeypatch):
    limits(hot_rows=400)
    sketched = skew.split(log, "k")
    monkeypatch.setattr(skew, "SKETCHED_LIMITS", 1)
    counted = skew.split(log, "k")
    assert set(counted.hot_keys) == set(sketched.hot_keys) and counted.pieces == sketched.pieces
    assert rows(counted.hot) == rows(sketched.hot)


def test_lookups_too_large_to_broadcast(spark, log, limits, monkeypatch):
    order, values = ["n", "v"], {"previous_n": "n"}
    limits(hot_rows=150, piece_rows=100)
    numbered = log.select("n").distinct()
    before = rows(ordered.with_previous(skew.split(log, "k"), order, values).union()), rows(keys.add_dense_key(numbered, "i", "n"))
    monkeypatch.setattr(ordered, "BROADCAST_STARTS", 0)
    monkeypatch.setattr(keys, "BROADCAST_PIECES", 0)
    after = rows(ordered.with_previous(skew.split(log, "k"), order, values).union()), rows(keys.add_dense_key(numbered, "i", "n"))
    assert before == after


def test_previous_value_in_pieces_equals_one_window(log, limits):
    order, values = ["n", "v"], {"previous_n": "n", "previous_v": "v"}
    spec = Window.partitionBy("k").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    expected = log.select("*", *[F.lag(c).over(spec).alias(name) for name, c in values.items()])
    limits(hot_rows=150)
    parts = ordered.with_previous(skew.split(log, "k"), order, values)
    assert parts.hot is not None
    assert rows(parts.union()) == rows(expected)


def test_no_piece_holds_a_whole_hot_key(log, limits):
    limits(hot_rows=150)
    parts = skew.split(log.filter("k = 'hot' AND n = 17"), "k")  # copies only
    result = ordered.with_previous(parts, ["n", "v"], {"p": "v"}).hot
    assert parts.pieces >= 2
    assert result.filter("p IS NULL").count() == 1
    assert result.count() == parts.hot.count()


def test_history_and_fact_with_a_hot_application(spark, limits):
    pick = random.Random(3)
    statuses = ["STARTED", "IN_PROGRESS", "SUBMITTED", "APPROVED"]
    data = []
    for i in range(900):
        application = "P1" if i % 3 == 0 else f"P{pick.randrange(2, 60)}"
        data.append(
            (f"E{i}", application, i + 1, f"2025-01-01 {pick.randrange(24):02}:{pick.randrange(60):02}:00",
             "STEP_STARTED", pick.choice("xy"), pick.choice(statuses), pick.choice(statuses),
             pick.choice(["FAILED", "SUCCESS"]), None, f"S{pick.randrange(9)}", "WEB", None)
        )
    names = (
        "event_id application_id event_sequence event_timestamp event_type step_name from_status to_status"
        " event_outcome failure_reason session_id source_channel event_metadata"
    ).split()
    schema = ", ".join(f"{n} {'int' if n == 'event_sequence' else 'string'}" for n in names)
    events = spark.createDataFrame(data, schema).withColumn(
        "event_timestamp", F.col("event_timestamp").cast("timestamp_ntz")
    )
    applications = events.select("application_id").distinct().selectExpr(
        "application_id", "'STANDARD' AS application_type", "'TV' AS device_type", "'x' AS current_step"
    )
    dim_application = dimensions.applications(applications).cache()
    dim_channel = dimensions.channels([events.select("source_channel")]).cache()

    def both():
        return rows(event_history(events)), rows(facts.event_fact(events, dim_application, dim_channel))

    whole = both()
    limits(hot_rows=40)
    assert skew.split(events, "application_id").hot is not None
    assert both() == whole


def test_dense_key_in_pieces_equals_row_number(spark, limits):
    ids = [f"id{i * 7919 % 5000}" for i in range(5000)]
    df = spark.createDataFrame([(i, len(i)) for i in ids], "id string, size int").repartition(6)
    expected = df.select(F.row_number().over(Window.orderBy("id")).cast("bigint").alias("key"), "id", "size")
    assert rows(keys.add_dense_key(df, "key", "id")) == rows(expected)
    limits(piece_rows=400)
    result = keys.add_dense_key(df, "key", "id")
    assert result.columns == ["key", "id", "size"]
    assert rows(result) == rows(expected)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan


def test_dense_key_of_nothing(spark):
    empty = spark.createDataFrame([], "id string")
    assert keys.add_dense_key(empty, "key", "id").collect() == []


def test_a_lookup_spreads_frequent_keys(spark, limits):
    data = [(i, "hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{i % 50}") for i in range(3000)]
    log = spark.createDataFrame(data, "id long, k string")
    members = spark.createDataFrame([("hot", 1), ("hot", 2), ("k2", 3), ("none", 4)], "m string, v int")
    expected = rows(log.join(members, F.col("k") == F.col("m"), "left"))
    assert rows(skew.lookup(log, "k", members, "m", skew.hot_keys(log, "k"), by="id")) == expected
    limits(hot_rows=100)
    hot = skew.hot_keys(log, "k")
    assert set(hot) == {"hot", None}
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
             "spark.sql.shuffle.partitions": "40"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        found = skew.lookup(log, "k", members, "m", hot, by="id")
        assert found.columns == ["id", "k", "m", "v"] and rows(found) == expected
        sizes = found.groupBy(F.spark_partition_id()).agg(F.countDistinct("id").alias("n")).agg(F.max("n")).first()[0]
        assert sizes < 600  # two thirds of the rows have a hot key or none
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
