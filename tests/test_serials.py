"""Dense numbers."""

import pytest
from pyspark.sql import functions as F

from orderflow.sinks.serials import with_serials


def numbered(rows, order, folder, **more):
    return [tuple(r) for r in with_serials(rows, order, "n", str(folder), **more).orderBy("n").collect()]


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_numbers_follow_the_order(spark, tmp_path, partitions):
    rows = spark.range(1000).selectExpr("nullif(id * 7919 % 1000, 5) x", "string(id) y").repartition(4)
    found = numbered(rows, ["x", "y"], tmp_path, partitions=partitions)
    assert [n for n, *_ in found] == list(range(1000))
    assert [x for _, x, _ in found] == [None, *[x for x in range(1000) if x != 5]]


def test_equal_rows_are_split_between_ranges(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("x"))
    found = numbered(rows, ["x"], tmp_path, partitions=8)
    assert [n for n, _ in found] == list(range(3000))
    assert [x for _, x in found] == sorted(x for _, x in found)
    sizes = spark.read.parquet(f"{tmp_path}/numbered").groupBy("range").count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 900


def test_empty_tables_and_names_that_are_taken(spark, tmp_path):
    rows = spark.createDataFrame([("b", 9), ("a", 8)], "`odd name` string, N int")
    assert numbered(rows.limit(0), ["odd name"], tmp_path / "none") == []
    assert numbered(rows, ["odd name"], tmp_path / "two") == [(0, "a"), (1, "b")]
    assert numbered(rows, ["N"], tmp_path / "taken") == [(0, "a"), (1, "b")]
