"""Registry of the proof queries and the SQL helpers shared by their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators.clean import col
from ...sources.driver import table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


# --------------------------------------------------------------------- SQL helpers

def _sql_mean_half_up(s: str, c: str, out: str) -> str:
    """Exact SQL for Spark's ``avg(decimal(10,0))`` -> decimal(14,4) -> ``out`` (both HALF_UP),
    from an integer sum ``s`` and count ``c``."""
    m4 = (f"(case when {s} >= 0 then ({s} * 20000 + {c}) // (2 * {c}) "
          f"else -((-{s} * 20000 + {c}) // (2 * {c})) end)")
    m2 = f"(case when {m4} >= 0 then ({m4} + 50) // 100 else -((-{m4} + 50) // 100) end)"
    return f"case when {c} = 0 then null else try_cast(cast({m2} as double) / 100 as {out}) end"


_SUM_INT = "cast(sum(cast({v} as decimal(10,0))) as hugeint)"
_CNT = "count(cast({v} as decimal(10,0)))"


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return table(spark, sf, name)


def _money(c: str) -> F.Column:
    return F.sum(col(c).try_cast("decimal(18,2)")).cast("decimal(38,2)")
