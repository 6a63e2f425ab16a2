"""Arrivals source: a typed extract (Parquet or CSV) read with the declared ARRIVALS schema.

The original records come as SAS binary files; decoding that format row by row is not a Spark
job, so the extract is produced upstream and read here with a fixed schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.clean import project
from ..tables import ARRIVALS
from .delimited import read_delimited


def read_arrivals(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read arrivals with the declared schema; only the columns a query uses are scanned.

    Parquet columns are matched by name.  A CSV extract (with header) is matched by header
    name too, read as text and cast with ``try_cast`` (a malformed number becomes null).
    """
    if fmt == "parquet":
        return spark.read.schema(ARRIVALS).parquet(path)
    if fmt == "csv":
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in ARRIVALS.fields])
        return project(read_delimited(spark, path, text, sep=","), ARRIVALS)
    raise ValueError(f"unsupported arrivals format {fmt!r}")
