"""Delimited text (CSV) sources and sinks with declared schemas."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.clean import col


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: T.StructType,
                   sep: str = ",", header: bool = True) -> DataFrame:
    """Read comma- or semicolon-separated text and return exactly the declared columns.

    With ``header`` the columns are matched **by name**, in any case (files may hold more columns,
    in any order; names with blanks such as ``Median Age`` stay as written) and every value is read
    as text, then ``try_cast`` to the declared type.  All files of one path must have the same
    header: a file whose header differs fails the job, it is never read by position.  Extracts that
    order their columns differently go under paths of their own; a list of paths reads each by its
    own header.  Without a header the schema applies by position.  Nothing is inferred from the
    data; malformed rows keep nulls (``PERMISSIVE``).
    """
    paths = [path] if isinstance(path, str) else list(path)
    return reduce(DataFrame.unionByName, [_read_one(spark, p, schema, sep, header) for p in paths])


def _read_one(spark: SparkSession, path: str, schema: T.StructType, sep: str, header: bool
              ) -> DataFrame:
    reader = spark.read.option("sep", sep).option("mode", "PERMISSIVE")
    if not header:
        return reader.schema(schema).option("header", False).csv(path)
    # enforceSchema=false checks every file's header against that of the first
    text = (reader.option("header", True).option("inferSchema", False)
            .option("enforceSchema", False).csv(path))
    found = {c.lower(): c for c in text.columns}
    if len(found) < len(text.columns):
        raise ValueError(f"{path}: columns that differ in case only: {text.columns}")
    missing = [f.name for f in schema.fields if f.name.lower() not in found]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    return text.select(*[col(found[f.name.lower()]).try_cast(f.dataType).alias(f.name)
                         for f in schema.fields])


def read_lines(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], sep: str = ",",
               header: bool = False, corrupt: str = "_corrupt_record") -> DataFrame:
    """Delimited text as text, nothing cast and nothing lost: the ``columns`` by position, and ``corrupt``
    with the whole line where it has more or fewer columns (or an unclosed quote), else null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, corrupt]])
    paths = [path] if isinstance(path, str) else list(path)
    return (spark.read.option("sep", sep).option("mode", "PERMISSIVE").option("header", header)
            .option("columnNameOfCorruptRecord", corrupt).schema(schema).csv(paths))


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True,
                    mode: str = "overwrite") -> None:
    """Write CSV text, one file per partition (the job commit is atomic)."""
    (df.write.mode(mode)
       .option("header", header)
       .option("sep", sep)
       .csv(path))
