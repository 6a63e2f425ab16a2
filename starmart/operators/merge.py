"""Keyed merge into a versioned, partitioned table: copy on write of the touched partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.versions import Change, partition_folder
from .clean import col, dedupe


def merge_by_key(change: Change, name: str, schema: T.StructType, key: str, partition_by: Sequence[str],
                 upserts: DataFrame | None = None, deletes: DataFrame | None = None) -> list[str]:
    """Apply changed, new (``upserts``, rows of ``schema``) and deleted records (``deletes``, a column
    ``key``) to a table of ``change``; returns the partition folders rewritten.

    A record may move between partitions: its old row is found by its key wherever it lies, so the touched
    partitions are those of the old rows and those of the new ones.  Only they are read whole and written
    again; of all others only the key column is scanned, and their files stay in the next version.

    Old rows of any key given go, then the upserts come: a key in both stays with its new row.  Of
    several upserts with one key the first in the order of all columns counts; upserts without a key are
    an error of the caller and raise; deleting what is not there changes nothing.

    The joins are by key, which is unique in the table: no hot keys.  The touched partitions are named on
    the driver, at most as many as the table has.
    """
    spark, parts = change.versions.spark, list(partition_by)
    names = [f.name for f in schema.fields]
    frames = []
    if upserts is not None:
        upserts = upserts.select(*[col(n) for n in names])
        frames.append(upserts.select(col(key)))
        missing = F.when(col(key).isNull(), F.raise_error(F.lit(f"an upsert into {name} has no {key}")))
        upserts = dedupe(upserts.withColumn(key, F.coalesce(col(key), missing.cast(schema[key].dataType))), [key])
    if deletes is not None:
        frames.append(deletes.select(col(key).cast(schema[key].dataType).alias(key)))
    if not frames:
        return []
    keys = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    keys = keys.where(col(key).isNotNull()).distinct()

    old = change.read(name, schema)
    touched = old.join(keys, key, "left_semi").select(*map(col, parts))
    if upserts is not None:
        touched = touched.unionByName(upserts.select(*map(col, parts)))
    folders = [partition_folder(spark, parts, tuple(r)) for r in touched.distinct().collect()]
    if not folders:
        return []
    rows = change.read(name, schema, only=folders).join(keys, key, "left_anti").select(*[col(n) for n in names])
    if upserts is not None:
        rows = rows.unionByName(upserts)
    change.replace_partitions(name, rows, parts, drop=folders)
    return sorted(folders)
