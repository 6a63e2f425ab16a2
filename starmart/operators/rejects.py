"""What a typed read drops, and why: every row is kept or rejected with its reasons, in one pass.

``project`` and ``require`` turn what does not fit into null and leave rows out without a word.  Here a
row is judged once (:func:`judged`), written once to a folder per outcome (:func:`write_judged`), and
counted in the same pass by observed metrics: rows read, kept, rejected, and rows per reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import col

KEPT, REJECTED = "kept", "rejected"
MALFORMED = "malformed row"


def judged(raw: DataFrame, schema: T.StructType, required: Sequence[str],
           mapping: Mapping[str, str | Column] | None = None, corrupt: str | None = None) -> DataFrame:
    """``schema``'s fields typed from ``raw`` (as ``project`` does), and three columns more: ``outcome``,
    ``reasons`` (all that hold, in the order below) and ``raw`` (the row as it was read; null if kept).

    * ``malformed row``: the reader could not cut the line into the columns (its ``corrupt`` column is
      set); nothing else is asked of such a row;
    * ``<field>: missing``: a field of ``required`` is null or NaN in the source;
    * ``<field>: not <type>``: a value is there but does not read as the type, or does not fit it.
      A field that is not required is then null in a kept row, as with ``project``, and has no reason.
    """
    mapping = dict(mapping or {})
    unknown = set(required) - set(schema.names)
    if unknown:
        raise ValueError(f"required fields that are not in the schema: {sorted(unknown)}")
    broken = col(corrupt).isNotNull() if corrupt else F.lit(False)
    typed, reasons = [], [F.when(broken, F.lit(MALFORMED))]
    for f in schema.fields:
        source = mapping.get(f.name, f.name)
        source = col(source) if isinstance(source, str) else source
        value = source.try_cast(f.dataType)
        typed.append(value.alias(f.name, metadata=f.metadata))
        if f.name in required:
            number = isinstance(f.dataType, (T.FloatType, T.DoubleType))
            nan = F.coalesce(F.isnan(value), F.lit(False)) if number else F.lit(False)
            reasons.append(F.when(~broken & (source.isNull() | nan), F.lit(f"{f.name}: missing")))
            reasons.append(F.when(~broken & source.isNotNull() & value.isNull(),
                                  F.lit(f"{f.name}: not {f.dataType.simpleString()}")))
    why = F.array_compact(F.array(*reasons))
    bad = F.size("_why") > 0
    whole = F.struct(*[col(c) for c in raw.columns])
    out = raw.select(*[t.alias(f"_t{i}") for i, t in enumerate(typed)], why.alias("_why"), whole.alias("_raw"))
    return out.select(
        *[F.col(f"_t{i}").alias(f.name, metadata=f.metadata) for i, f in enumerate(schema.fields)],
        F.when(bad, F.lit(REJECTED)).otherwise(F.lit(KEPT)).alias("outcome"), F.col("_why").alias("reasons"),
        F.when(bad, F.col("_raw")).alias("raw"))


def reasons_of(schema: T.StructType, required: Sequence[str]) -> list[str]:
    """All reasons that :func:`judged` may give."""
    return [MALFORMED] + [r for f in schema.fields if f.name in required
                          for r in (f"{f.name}: missing", f"{f.name}: not {f.dataType.simpleString()}")]


def write_judged(rows: DataFrame, path: str, reasons: Sequence[str]) -> dict[str, int]:
    """Write judged rows, a folder per outcome; returns ``read``, ``kept``, ``rejected`` and the rows per
    reason, observed in the pass that wrote them (a handful of numbers reach the driver)."""
    seen = Observation("judged")
    bad = F.col("outcome") == REJECTED
    metrics = [F.count(F.lit(1)).alias("read"), F.count_if(~bad).alias(KEPT), F.count_if(bad).alias(REJECTED)]
    metrics += [F.count_if(F.array_contains("reasons", r)).alias(f"r{i}") for i, r in enumerate(reasons)]
    rows.observe(seen, *metrics).write.mode("overwrite").partitionBy("outcome").parquet(path)
    got = seen.get
    counts = {k: int(got[k]) for k in ("read", KEPT, REJECTED)} | {r: int(got[f"r{i}"]) for i, r in enumerate(reasons)}
    if counts["read"] != counts[KEPT] + counts[REJECTED]:
        raise RuntimeError(f"rows lost: {counts}")
    return counts


def read_kept(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The kept rows, typed; only their folder is read."""
    return _outcome(spark, path, KEPT, schema)


def read_rejected(spark: SparkSession, path: str, raw_schema: T.StructType) -> DataFrame:
    """The rejected rows: ``reasons`` and the ``raw`` row."""
    return _outcome(spark, path, REJECTED, T.StructType([
        T.StructField("reasons", T.ArrayType(T.StringType())), T.StructField("raw", raw_schema)]))


def _outcome(spark: SparkSession, path: str, outcome: str, schema: T.StructType) -> DataFrame:
    whole = T.StructType([*schema.fields, T.StructField("outcome", T.StringType())])
    return spark.read.schema(whole).parquet(path).where(F.col("outcome") == outcome).drop("outcome")
