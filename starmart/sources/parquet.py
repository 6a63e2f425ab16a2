"""Parquet sinks: plain, partitioned, and dynamically overwritten (monthly refresh)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                dynamic: bool = False, mode: str = "overwrite") -> None:
    """Write a Parquet table.

    * no ``partition_by``: plain overwrite.
    * ``partition_by``: the rows are first rebalanced on the partition columns (an AQE
      ``REBALANCE``: it splits skewed partitions and merges small ones), so each
      ``year=/month=`` folder gets a few right-sized files instead of one file per task.
    * ``dynamic``: only the partitions present in ``df`` are replaced; all other months stay
      (monthly refresh).  Static overwrite replaces the whole dataset.
    """
    parts = list(partition_by)
    writer_df = df.hint("rebalance", *parts) if parts else df
    w = writer_df.write.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a Parquet table; with ``schema`` the columns and types are declared, not taken
    from the files.  Partition columns come last when read back."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Put a staged folder in the place of ``target`` by renaming it; between two renames there is no
    table under its name, but the old one stands aside until the new one is in place, and the next
    :func:`publish` or :func:`recover` puts it back after a crash.  (A store without renames copies; the
    old table then stays until the copy is done.)  Readers who must never miss a table read versions
    (:mod:`starmart.sources.versions`)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, old, aside = path(staged), path(target), path(f"{target}.replaced")
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(old.getParent())
    recover(spark, target)
    if fs.exists(aside):  # beside a whole table: what a crash after the second rename left
        fs.delete(aside, True)
    if fs.exists(old) and not fs.rename(old, aside):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(new, old):
        raise OSError(f"cannot publish {staged} as {target}")
    fs.delete(aside, True)


def recover(spark: SparkSession, target: str) -> bool:
    """Put the old table back if a crash left it aside and no new one in its place."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    old, aside = path(target), path(f"{target}.replaced")
    fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(old) or not fs.exists(aside):
        return False
    if not fs.rename(aside, old):
        raise OSError(f"cannot put {target}.replaced back")
    return True


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours (staged tables that have been published)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
