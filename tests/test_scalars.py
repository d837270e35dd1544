import time

import pytest
from pyspark.sql import functions as F

from admitflow import session
from admitflow.functions import predicates as P
from admitflow.functions import scalars as X


def on_text(spark, convert, text):
    value = spark.range(1).select(F.lit(text).cast("string").alias("t")).select(convert(F.col("t")).alias("x")).first()
    return value["x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2025-01-01 10:00:00", "2025-01-01 10:00:00"),
        ("2025-01-01T10:00:00+07:00", "2025-01-01 03:00:00"),
        ("2025-01-01 10:00:00.25", "2025-01-01 10:00:00.250000"),
        ("2025-01-01", "2025-01-01 00:00:00"),
        ("2025/01/02 10:00:00", "2025-01-02 10:00:00"),
        (" 2025-01-02 10:00:00", "2025-01-02 10:00:00"),
        ("2025-1-2", "2025-01-02 00:00:00"),
        (None, None),
    ],
)
def test_readable_times(spark, text, expected):
    for convert in (X.strict_timestamp, X.lenient_timestamp):
        value = on_text(spark, convert, text)
        assert (None if value is None else str(value)) == expected


@pytest.mark.parametrize("text", ["not a time", "2025", "2025-01", "10:00:00", "", "2025-13-01 00:00:00"])
def test_unreadable_times(spark, text):
    assert on_text(spark, X.lenient_timestamp, text) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        on_text(spark, X.strict_timestamp, text)


def test_numbers(spark):
    assert on_text(spark, X.strict_int, "12") == 12
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        on_text(spark, X.strict_int, "1.5")
    assert [on_text(spark, X.lenient_number, t) for t in ("1.0", "1.5", "x", "NaN", None)] == [1.0, 1.5, None, None, None]


@pytest.mark.parametrize("text, expected", [("20250102", "2025-01-02"), ("01/02/2025", "2025-01-02"), ("1/2/2025 10:00", "2025-01-02")])
def test_other_dates_are_read_leniently(spark, text, expected):
    assert str(on_text(spark, X.lenient_timestamp, text)).startswith(expected)


@pytest.mark.parametrize("text", ["1d", "1f", "2D", "0x1p3", "1_0", "", " ", ".", "1e", "--1"])
def test_what_is_no_number(spark, text):
    assert on_text(spark, X.lenient_number, text) is None


@pytest.mark.parametrize("text, expected", [(" 7 ", 7.0), ("-.5", -0.5), ("1e3", 1000.0), ("3.", 3.0)])
def test_what_is_a_number(spark, text, expected):
    assert on_text(spark, X.lenient_number, text) == expected


def test_blank_to_null(spark):
    assert [on_text(spark, X.blank_to_null, t) for t in ("", " ", "a", None)] == [None, " ", "a", None]


def test_times_as_keys_and_gaps(spark):
    row = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-02-29 23:59:59.9' AS a, TIMESTAMP_NTZ'2024-03-01 00:00:00.1' AS b,"
        " CAST(NULL AS TIMESTAMP_NTZ) AS n"
    )
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    result = row.select(
        X.date_key(a).alias("key"), X.date_key(n).alias("no_key"), X.seconds_between(a, b).alias("gap"),
        X.seconds_between(b, a).alias("back"), X.seconds_between(a, n).alias("no_gap"),
    ).first()
    assert result.asDict() == {"key": 20240229, "no_key": None, "gap": 1, "back": -1, "no_gap": None}


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"a": 1}', True), ("[1, null]", True), ('"x"', True), ("12", True), ("null", True), (None, None),
        ('{"a": 1, "a": 2}', True), ('{"a": "]}"}', True),
        ("", False), (" ", False), ("{", False), ('{"a": 1} x', False), ('{"a": 1}{"b": 2}', False), ("1] x", False),
        ("1} x", False), ("1,2", False), ("1],[2", False), ("{'a': 1}", False), ('{"a": 1,}', False), ("NaN", False),
    ],
)
def test_json(spark, text, expected):
    assert on_text(spark, lambda col: F.expr(P.is_json("t")), text) is expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("[" * 1200 + "]" * 1200, True), ("[" * 1200 + "]" * 1199, False), ('{"a":' * 1100 + "1" + "}" * 1100, True),
        ('{"a":' * 1100 + "1" + "}" * 1099 + "]", False), ("9" * 1200, True), ("-1." + "0" * 1200 + "e5", True),
        ("0" * 1200, False), ("1" * 1200 + ".", False), ('[{"k": [1, "x", null], "l": {}}, ' + "[" * 1200 + "]" * 1200 + "]", True),
        ("[1 " + "[" * 1200 + "]" * 1200 + "]", False), ("[" * 1200 + '"a":1' + "]" * 1200, False),
        ("[" * 1200 + "1,]" + "]" * 1199, False), ("[" * 1200 + "\\n" + "]" * 1200, False),
        ("[" * 1200 + '"\\n\\u00e9"' + "]" * 1200, True), ("[" * 1200 + "\ue001" + "]" * 1200, False),
        ("[" * 1200 + "truefalse" + "]" * 1200, False), ("[" * 1200 + '"a""b"' + "]" * 1200, False),
        ("[" * 1200 + '{"a":1 "b":2}' + "]" * 1200, False), ("[" * 1200 + "{1:2}" + "]" * 1200, False),
    ],
)
def test_json_beyond_the_parsers_limits(spark, text, expected):
    assert on_text(spark, lambda col: F.expr(P.is_json("t")), text) is expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"' + "k" * 60_000 + '": 1}', True), ('{"\\n' + "k" * 60_000 + '": ["a", {"b": "\\u00e9"}]}', True),
        ('{"' + "k" * 60_000 + '\t": 1}', False), ('{"' + "k" * 60_000 + '\\x": 1}', False),
        ('{"' + "k" * 60_000 + '": 1 "', False), ('{"' + "k" * 60_000 + '" "a": 1}', False),
        ('{"' + "k" * 60_000 + '": 1}, {"a": 2}', False), ('"' + "\ue000" * 60_000 + '"', True),
        ('{"' + "\ue001" * 60_000 + '": "\ue002"}', True), ("{'" + "k" * 60_000 + "': 1}", False),
    ],
)
def test_json_with_very_long_names(spark, text, expected):
    assert on_text(spark, lambda col: F.expr(P.is_json("t")), text) is expected


@pytest.mark.parametrize(
    "deep, expected",
    [
        ("concat(repeat('[', 1000000), repeat(']', 1000000))", True),
        ("concat(repeat('[', 1000000), repeat(']', 999999))", False),
        ("concat(repeat('{\"a\": [1, ', 500000), '2', repeat(']}', 500000))", True),
        ("concat(repeat('{\"a\": [1, ', 500000), '2', repeat('}]', 500000))", False),
        ("concat(repeat('[{}, ', 500000), '\\t', repeat(']', 500000))", False),
    ],
)
def test_a_million_brackets_take_seconds(spark, deep, expected):
    made = spark.range(1).selectExpr(f"{deep} AS t")
    begin = time.perf_counter()
    assert made.select(F.expr(P.is_json("t"))).first()[0] is expected
    assert time.perf_counter() - begin < 20


def test_json_with_a_very_long_string(spark):
    long = spark.range(1).select(F.concat(F.lit('{"a": "'), F.repeat(F.lit("x"), 21_000_000), F.lit('"}')).alias("t"))
    assert long.select(F.expr(P.is_json("t"))).first()[0] is True
    assert long.select(F.concat("t", F.lit("x")).alias("t")).select(F.expr(P.is_json("t"))).first()[0] is False


def test_shuffles_fit_the_input(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    try:
        session.fit_shuffles(spark, 1000)
        assert spark.conf.get(name) == before
        session.fit_shuffles(spark, 10 * session.SHUFFLE_BYTES)
        assert spark.conf.get(name) == "10"
        # What a partition holds stays the same, however large the input.
        session.fit_shuffles(spark, 10**14)
        assert 10**14 / int(spark.conf.get(name)) <= session.SHUFFLE_BYTES
    finally:
        spark.conf.set(name, before)
