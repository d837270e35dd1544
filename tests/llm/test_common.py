from pyspark.sql import Window
from pyspark.sql import functions as F

from admitflow.llm.common import first_by_hash


def test_smallest_hashes_of_each_value(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 100 == 0).cast("int").alias("k"))
    place = F.row_number().over(Window.partitionBy("k").orderBy(F.xxhash64("doc_id"), "doc_id"))
    for most in (1, 40, 51, 700):
        expected = rows.withColumn("place", place).where(F.col("place") <= most).drop("place")
        assert sorted(first_by_hash(rows, "k", most).collect()) == sorted(expected.collect())


def test_repeated_ids_and_empty_tables(spark):
    rows = spark.createDataFrame([(7, "a"), (7, "a"), (None, "a"), (8, "b")], "doc_id long, k string")
    assert first_by_hash(rows, "k", 9).count() == 4
    assert first_by_hash(rows, "k", 1).count() == 2
    assert first_by_hash(rows.limit(0), "k", 3).count() == 0
