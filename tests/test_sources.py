import pytest
from pyspark.errors import AnalysisException

from admitflow import session
from admitflow.sources import extracts
from admitflow.sources.tables import Layer, export


def write(path, text):
    path.write_text(text)
    return str(path)


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_every_column_is_text_and_blank_is_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'id,n,note\n1,007,"{""a"": ""x,y""}"\n2,,""\n')
    df = extracts.read_csv(spark, path)
    assert [t for _, t in df.dtypes] == ["string"] * 3
    assert values(df) == [("1", "007", '{"a": "x,y"}'), ("2", None, None)]


def test_line_breaks_inside_fields(spark, tmp_path):
    plain = write(tmp_path / "plain.csv", 'id,note\n1,"a ""quoted"" word"\n')
    broken = write(tmp_path / "broken.csv", 'id,note\n1,"two\nlines"\n2,x\n')
    assert not extracts.has_line_breaks_in_fields(spark, plain)
    assert extracts.has_line_breaks_in_fields(spark, broken)
    assert values(extracts.read_csv(spark, plain)) == [("1", 'a "quoted" word')]
    assert values(extracts.read_csv(spark, broken)) == [("1", "two\nlines"), ("2", "x")]


def test_long_fields_are_read_whole(spark, tmp_path):
    path = write(tmp_path / "long.csv", "id,note\n1," + "x" * 300_000 + "\n")
    assert len(extracts.read_csv(spark, path).first()["note"]) == 300_000


def test_many_part_files_are_one_source(spark, tmp_path):
    folder = tmp_path / "parts.csv"
    folder.mkdir()
    write(folder / "0.csv", "id,n\n1,2\n")
    write(folder / "1.csv", "id,n\n3,4\n")
    assert values(extracts.read_csv(spark, str(folder))) == [("1", "2"), ("3", "4")]


def test_missing_and_malformed_sources_raise(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        extracts.read_csv(spark, str(tmp_path / "none.csv"))
    short = write(tmp_path / "short.csv", "id,n\n1\n")
    with pytest.raises(Exception, match="MALFORMED"):
        extracts.read_csv(spark, short).collect()


def test_layer_replaces_whole_tables(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "raw"))
    assert layer.write("t", spark.range(5)).count() == 5
    layer.write("t", spark.range(2))
    assert layer.count("t") == 2
    stored = layer.write_all({"a": lambda: spark.range(3), "b": lambda: spark.range(4)})
    assert [df.count() for df in stored.values()] == [3, 4]
    with pytest.raises(ZeroDivisionError):
        layer.write_all({"a": lambda: spark.range(3), "b": lambda: spark.range(1 // 0)})


def test_export_keeps_the_order_in_one_file(spark, tmp_path):
    path = str(tmp_path / "out.parquet")
    assert export(spark.range(1000).orderBy("id", ascending=False), path) == 1000
    files = list((tmp_path / "out.parquet").glob("*.parquet"))
    assert len(files) == 1
    assert [r["id"] for r in spark.read.parquet(path).take(3)] == [999, 998, 997]


def test_export_of_a_large_result_keeps_its_files(spark, tmp_path):
    path = str(tmp_path / "out.parquet")
    assert export(spark.range(1000, numPartitions=4).repartitionByRange(4, "id"), path, single_file_rows=999) == 1000
    assert len(list((tmp_path / "out.parquet").glob("*.parquet"))) > 1


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
