import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from admitflow.sources.replace import Slot
from admitflow.sources.tables import Layer, export


def ids(df):
    return sorted(r["id"] for r in df.collect())


def failing_midway(spark):
    """Four tasks, the last of which fails after the others have written."""
    broken = F.when(F.col("id") == 99, F.raise_error(F.lit("killed"))).otherwise(F.col("id")).cast("long")
    return spark.range(0, 100, 1, 4).select(broken.alias("id"))


def test_a_write_that_dies_midway_leaves_the_old_table(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "raw"))
    layer.write("t", spark.range(3))
    with pytest.raises(Exception, match="killed"):
        layer.write("t", failing_midway(spark))
    assert ids(layer.read("t")) == [0, 1, 2]
    assert ids(spark.read.parquet(layer.path("t"))) == [0, 1, 2]
    assert layer.total_bytes() == sum(f.stat().st_size for f in (tmp_path / "raw" / "t").glob("*.parquet"))
    layer.write("t", spark.range(5))
    assert ids(layer.read("t")) == [0, 1, 2, 3, 4]


def test_a_first_write_that_dies_leaves_no_table(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "raw"))
    with pytest.raises(Exception, match="killed"):
        layer.write("t", failing_midway(spark))
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        layer.read("t")


@pytest.mark.parametrize("step, expected", [(0, [0, 1, 2]), (1, [0, 1]), (2, [0, 1])])
def test_a_writer_that_dies_between_its_steps(spark, tmp_path, monkeypatch, step, expected):
    slot = Slot(spark, str(tmp_path / "t"))
    slot.write(spark.range(3))
    rename, renames = Slot._rename, []

    def dying(self, source, target):
        if len(renames) == step:
            raise KeyboardInterrupt
        renames.append(target)
        rename(self, source, target)

    monkeypatch.setattr(Slot, "_rename", dying)
    if step == 2:  # both renames done; only the old content is left over
        monkeypatch.setattr(Slot, "_delete", lambda self, text: None)
        slot.write(spark.range(2))
    else:
        with pytest.raises(KeyboardInterrupt):
            slot.write(spark.range(2))
    monkeypatch.undo()
    assert ids(slot.read()) == expected
    slot.write(spark.range(7))
    assert ids(slot.read()) == list(range(7))
    assert not (tmp_path / "_replaced" / "t").exists() and not (tmp_path / "_staged" / "t").exists()


def test_an_exchange_goes_back_if_the_new_content_is_not_whole(spark, tmp_path):
    slot = Slot(spark, str(tmp_path / "t"))
    spark.range(3).write.parquet(str(tmp_path / "_replaced" / "t"))
    spark.range(9).write.parquet(str(tmp_path / "_staged" / "t"))
    (tmp_path / "_staged" / "t" / "_SUCCESS").unlink()
    assert ids(slot.read()) == [0, 1, 2]


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    layer = Layer(spark, str(tmp_path / "raw"))
    kept = layer.write("t", spark.range(10)).where("id % 2 = 0")
    assert ids(layer.write("t", kept)) == [0, 2, 4, 6, 8]


def test_an_export_that_dies_leaves_the_old_output(spark, tmp_path):
    path = str(tmp_path / "out.parquet")
    export(spark.range(4), path)
    with pytest.raises(Exception, match="killed"):
        export(failing_midway(spark).coalesce(4), path)
    assert ids(spark.read.parquet(path)) == [0, 1, 2, 3]
