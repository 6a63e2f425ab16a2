"""The monthly refresh as an available-now stream with dynamic partition overwrite (S9)."""

from pyspark.sql import functions as F

from starmart.sources.parquet import read_table, write_table
from starmart.streaming.refresh import refresh_from_landing

SCHEMA = "id int, amount int, year int, month int"


def test_refresh_replaces_only_landed_months(spark, scratch):
    landing, target, ckpt = scratch("landing"), scratch("target"), scratch("ckpt")
    first = spark.createDataFrame([(1, 10, 2016, 1), (2, 20, 2016, 1), (3, 30, 2016, 2)], SCHEMA)
    write_table(first, landing, partition_by=["year", "month"], mode="append")
    refresh_from_landing(spark, landing, first.schema, target, ckpt, ["year", "month"])
    got = {(r.year, r.month): r.n for r in read_table(spark, target).groupBy("year", "month")
           .agg(F.count("*").alias("n")).collect()}
    assert got == {(2016, 1): 2, (2016, 2): 1}

    # a restated February and a new March land; January must stay as it was
    second = spark.createDataFrame([(4, 40, 2016, 2), (5, 50, 2016, 3)], SCHEMA)
    write_table(second, landing, partition_by=["year", "month"], mode="append")
    refresh_from_landing(spark, landing, first.schema, target, ckpt, ["year", "month"])
    rows = sorted((r.id, r.year, r.month) for r in read_table(spark, target).collect())
    assert rows == [(1, 2016, 1), (2, 2016, 1), (4, 2016, 2), (5, 2016, 3)]


def test_dynamic_overwrite_keeps_other_partitions(spark, scratch):
    path = scratch("table")
    df = spark.createDataFrame([(1, 1, 2016, 1), (2, 2, 2016, 2)], SCHEMA)
    write_table(df, path, partition_by=["year", "month"])
    write_table(spark.createDataFrame([(3, 3, 2016, 2)], SCHEMA), path,
                partition_by=["year", "month"], dynamic=True)
    assert sorted(r.id for r in read_table(spark, path).collect()) == [1, 3]
    write_table(spark.createDataFrame([(9, 9, 2017, 5)], SCHEMA), path, partition_by=["year", "month"])
    assert sorted(r.id for r in read_table(spark, path).collect()) == [9]   # static: all replaced


def test_refresh_restart_without_new_files_changes_nothing(spark, scratch):
    landing, target, ckpt = scratch("landing"), scratch("target"), scratch("ckpt")
    df = spark.createDataFrame([(1, 10, 2016, 1), (2, 20, 2016, 2)], SCHEMA)
    write_table(df, landing, partition_by=["year", "month"], mode="append")
    refresh_from_landing(spark, landing, df.schema, target, ckpt, ["year", "month"])
    first = sorted(map(tuple, read_table(spark, target).collect()))
    # a restart of the same query (same checkpoint) finds no new files and writes nothing
    refresh_from_landing(spark, landing, df.schema, target, ckpt, ["year", "month"])
    assert sorted(map(tuple, read_table(spark, target).collect())) == first
