"""Lookups: dimension joins, orphan keys, star enrichment.

No join is forced to broadcast: Spark compares the size in bytes of each side, known from the
files or, under AQE, measured at run time, with ``spark.sql.autoBroadcastJoinThreshold``, and
shuffles beyond it.  Nothing runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .clean import col


def resolve(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "inner"
            ) -> DataFrame:
    """Join a dimension on shared key column(s).  ``inner`` drops unmatched fact rows (as the
    reference's port/state join does); ``left`` keeps them with null attributes."""
    return fact.join(dim, on=on, how=how)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None
            ) -> DataFrame:
    """Fact rows whose key has no dimension row (``left_anti``; a repeated dimension key does not
    multiply rows).  Null keys count as orphans only if the caller keeps them; they never match."""
    keys = dim.select(col(dim_key or fact_key).alias("_k"))
    return fact.join(keys, col(fact_key) == F.col("_k"), "left_anti")


def enrich(fact: DataFrame, dims: Sequence[tuple[DataFrame, str | Sequence[str]]],
           how: str = "left") -> DataFrame:
    """Chain of dimension joins around a fact table: ``(dim, key)`` each.

    Joins run in the order given (Catalyst does not reorder them without cost statistics): to
    snowflake a large fact, enrich the intermediate table first (``enrich(orders, [customer,
    nation])``) and join the fact to it once, so the fact is shuffled once."""
    out = fact
    for dim, key in dims:
        out = resolve(out, dim, key, how=how)
    return out
