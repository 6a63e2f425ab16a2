"""Data-quality report over many tables: existence, rows, keys, types, completeness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import col


@dataclass(frozen=True)
class Check:
    """What a table must satisfy: a unique, non-null ``key``; with ``schema`` its columns and types;
    with ``source`` (any frame with the key columns) one row per distinct key of the source."""
    df: DataFrame
    key: Sequence[str]
    schema: T.StructType | None = None
    source: DataFrame | None = None


def type_mismatches(df: DataFrame, schema: T.StructType | None) -> int:
    """Declared columns that are missing or of another type, and columns that are not declared."""
    if schema is None:
        return 0
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    return sum(have.get(k) != want.get(k) for k in have.keys() | want.keys())


def _key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: rows, null_keys, distinct_keys.  ``count(distinct ...)`` ignores tuples with a null
    part; one aggregate, partial on the map side."""
    any_null = reduce(lambda a, b: a | b, [col(k).isNull() for k in keys])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(any_null).alias("null_keys"),
                  F.count_distinct(*[col(k) for k in keys]).alias("distinct_keys"))


def table_report(name: str, check: Check) -> DataFrame:
    """One row: ``table, rows, null_keys, duplicate_keys, type_mismatches, source_keys, ok``
    (``source_keys``: distinct keys of the source, null without one)."""
    if check.df is None:
        raise ValueError(f"table {name} does not exist")
    stats = _key_counts(check.df, check.key)
    if check.source is None:
        stats = stats.withColumn("source_keys", F.lit(None).cast("long"))
    else:  # two aggregates of one row each
        source = _key_counts(check.source, check.key).select(
            F.lit(1).alias("_one"), F.col("distinct_keys").alias("source_keys"))
        stats = stats.withColumn("_one", F.lit(1)).join(F.broadcast(source), "_one").drop("_one")
    wrong = type_mismatches(check.df, check.schema)
    return stats.select(
        F.lit(name).alias("table"), "rows", "null_keys",
        (F.col("rows") - F.col("null_keys") - F.col("distinct_keys")).alias("duplicate_keys"),
        F.lit(wrong).alias("type_mismatches"), "source_keys",
        ((F.col("rows") > 0) & (F.col("null_keys") == 0) & F.lit(wrong == 0)
         & (F.col("rows") == F.col("distinct_keys"))
         & (F.col("source_keys").isNull() | (F.col("source_keys") == F.col("rows")))).alias("ok"))


def check_tables(tables: Mapping[str, Check | tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Quality report for ``{name: Check}`` (or ``(df, key)``) as one DataFrame."""
    checks = {n: c if isinstance(c, Check) or c is None else Check(*c) for n, c in tables.items()}
    for name, check in checks.items():
        if check is None or check.df is None:
            raise ValueError(f"table {name} does not exist")
    return reduce(DataFrame.unionByName, [table_report(n, c) for n, c in checks.items()])


def require_ok(report: DataFrame) -> list:
    """The rows of a report (one small row per table); raises if a table fails."""
    rows = report.collect()
    bad = sorted(r["table"] for r in rows if not r["ok"])
    if bad:
        raise ValueError(f"data quality check failed for: {', '.join(bad)}")
    return rows


def orphan_report(fact: DataFrame,
                  checks: Sequence[tuple[str, str, DataFrame, str]]) -> DataFrame:
    """Referential integrity: per ``(fact_column, dimension_name, dimension, dimension_key)`` the
    number of fact rows whose non-null key has no dimension row.

    The fact is scanned once: one aggregate counts its rows per (column, value), combined map-side,
    so no fact row is shuffled and a hot value is one row per task.  Only these counts, as few as
    the columns have values, meet the dimension keys.
    """
    fks = list(dict.fromkeys(fk for fk, *_ in checks))
    pairs = F.array(*[F.struct(F.lit(fk).alias("fact_column"),
                               col(fk).cast("string").alias("value")) for fk in fks])
    counts = (fact.select(F.inline(pairs)).where("value is not null")
              .groupBy("fact_column", "value").agg(F.count(F.lit(1)).alias("n")))
    # per check: the values that count for it, and the keys it has, side by side
    wanted = F.array(*[F.struct(F.lit(fk).alias("fact_column"), F.lit(i).alias("check"))
                       for i, (fk, *_) in enumerate(checks)])
    needed = counts.select("fact_column", "value", "n",
                           F.inline(F.filter(wanted, lambda w: w["fact_column"] == F.col("fact_column")))
                           .alias("fk", "check")).drop("fk")
    keys = reduce(DataFrame.unionByName, [
        dim.select(F.lit(i).alias("check"), col(dk).cast("string").alias("value"))
        for i, (_, _, dim, dk) in enumerate(checks)])
    missing = needed.join(keys, ["check", "value"], "left_anti")
    # every check has a row, also without orphans
    none = fact.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("check"), F.lit(0).cast("long").alias("n")) for i in range(len(checks))])))
    names = {k: F.create_map(*[x for i, c in enumerate(checks) for x in (F.lit(i), F.lit(c[j]))])
             for j, k in enumerate(("fact_column", "dimension"))}
    return (missing.select("check", "n").unionByName(none).groupBy("check")
            .agg(F.sum("n").cast("long").alias("orphans"))
            .select(*[m[F.col("check")].alias(k) for k, m in names.items()], "orphans"))
