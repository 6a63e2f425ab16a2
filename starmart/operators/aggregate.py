"""Aggregations: decimal means, listed-value pivots, counts and typed column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .clean import col


def mean_by(df: DataFrame, keys: Sequence[str], value: str, scale: int = 0,
            out: str = "decimal(4,2)", alias: str = "average_temperature") -> DataFrame:
    """Grouped mean of a text or numeric column read as ``decimal(10, scale)``.

    With the default ``scale=0`` each reading is rounded (HALF_UP) to a whole unit before the
    mean, the mean is exact ``decimal(14,4)``, then narrowed to ``out`` (HALF_UP again).  A
    value that does not fit becomes null (``try_cast``).  Hash aggregation with a map-side
    partial step, so skewed keys are combined before the shuffle.
    """
    reading = col(value).try_cast(f"decimal(10,{scale})")
    return (df.groupBy(*[col(k) for k in keys])
              .agg(F.avg(reading).try_cast(out).alias(alias)))


def pivot_first(df: DataFrame, keys: Sequence[str], on: str, values: Sequence[str], value: str,
                cast: str | None = None) -> DataFrame:
    """One row per ``keys`` and one column per listed ``values`` of ``on`` holding ``value``.

    The value list is given, so no job runs to discover the distinct values, and the pivot is
    written as one conditional ``min`` per value: a single aggregate with one shuffle on
    ``keys``, combined map-side (``DataFrame.pivot`` would aggregate by ``keys`` + ``on`` first
    and shuffle twice).  ``min`` replaces ``first``: equal when (keys, on) is unique, and
    deterministic otherwise.
    """
    v = col(value) if cast is None else col(value).try_cast(cast)
    piv = col(on)
    return df.groupBy(*[col(k) for k in keys]).agg(
        *[F.min(F.when(piv == F.lit(x), v)).alias(str(x)) for x in values])


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over the rows where both are present, null when it is undefined
    (fewer than two pairs or a constant side).

    ``corr`` itself divides by the product of the standard deviations and fails the job under
    ANSI mode when one of them is zero; this is the same co-moment quotient through
    ``try_divide``.
    """
    both = x.isNotNull() & y.isNotNull()
    xs, ys = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    # a constant side is told by its extremes: merged partial sums may leave it a spread of 1e-17
    vary = (F.min(xs) < F.max(xs)) & (F.min(ys) < F.max(ys))
    return F.when(vary, F.try_divide(F.covar_samp(xs, ys), F.stddev_samp(xs) * F.stddev_samp(ys)))


def count_by(df: DataFrame, keys: Sequence[str], alias: str = "n") -> DataFrame:
    """Row count per group (``count(lit(1))`` also works inside a pivot)."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias(alias))


def distinct_count(df: DataFrame, keys: Sequence[str], of: str, alias: str = "n_distinct",
                   rows: str | None = None) -> DataFrame:
    """Exact distinct count of ``of`` per group (global when ``keys`` is empty), and the row
    count under the name ``rows`` if given."""
    counts = [F.count(F.lit(1)).alias(rows)] if rows else []
    return df.groupBy(*[col(k) for k in keys]).agg(*counts, F.count_distinct(col(of)).alias(alias))


def profile(df: DataFrame, cols: Sequence[str], quantiles: Sequence[float] = (),
            accuracy: int = 1_000_000, digits: int | None = None, exact: bool = False
            ) -> DataFrame:
    """Typed column profile: one row per column with count, mean, stddev, min, max and
    optional quantiles (``describe()`` / ``summary()`` with real types instead of strings).

    Numeric columns are profiled as doubles.  As soon as one column is not numeric, ``min`` and
    ``max`` are text: the column's own smallest and largest value; its mean, deviation and
    quantiles are those of the values that read as numbers (null if none does), and ``count`` is
    that of its non-null values.

    All statistics of all columns come from one aggregate (one pass, partial aggregation), then
    ``stack`` turns the single wide row into one row per column.  Quantiles use
    ``percentile_approx``: its memory is bounded by ``accuracy`` whatever the data size, and the
    rank of the returned value is within about ``n / accuracy`` of the requested rank.
    ``exact=True`` joins :func:`order_statistics` instead (exact, in the same lazy plan).
    ``digits`` rounds the floating statistics.
    """
    def r(c: Column) -> Column:
        return F.round(c, digits) if digits is not None else c

    types = {f.name: f.dataType for f in df.schema.fields}
    mixed = any(not isinstance(types[c], T.NumericType) for c in cols)
    aggs = []
    for i, name in enumerate(cols):
        numeric = isinstance(types[name], T.NumericType)
        x = _number(col(name), types[name])
        low, high = (F.min(x), F.max(x)) if numeric else (F.min(col(name)), F.max(col(name)))
        if mixed:
            low, high = low.cast("string"), high.cast("string")
        aggs += [
            F.count(x if numeric else col(name)).alias(f"c{i}"),
            r(F.avg(x)).alias(f"m{i}"),
            r(F.stddev_samp(x)).alias(f"s{i}"),
            low.alias(f"lo{i}"),
            high.alias(f"hi{i}"),
        ]
        if quantiles and not exact:
            aggs.append(F.percentile_approx(x, list(quantiles), accuracy).alias(f"q{i}"))
    wide = df.agg(*aggs)
    q_names = [f"p{round(q * 100):02d}" for q in quantiles]
    rows = []
    for i, name in enumerate(cols):
        text = name.replace("\\", "\\\\").replace("'", "\\'")
        parts = [f"{i}", f"'{text}'", f"c{i}", f"m{i}", f"s{i}", f"lo{i}", f"hi{i}"]
        if not exact:
            parts += [f"q{i}[{j}]" for j in range(len(quantiles))]
        rows.append(", ".join(parts))
    names = ["column", "count", "mean", "stddev", "min", "max"]
    stacked = ["_i", *names, *([] if exact else q_names)]
    table = wide.selectExpr(f"stack({len(cols)}, {', '.join(rows)}) as ({', '.join(stacked)})")
    if exact and quantiles:
        found = order_statistics(df, cols, quantiles).groupBy(F.col("c").alias("_i")).agg(
            *[F.max(F.when(F.col("q") == j, F.col("value"))).alias(n) for j, n in enumerate(q_names)])
        table = table.join(F.broadcast(found), "_i", "left")  # one row per column
    return table.select(*names, *(q_names if not exact or quantiles else []))


def _number(c: Column, dtype: T.DataType) -> Column:
    """The value as a double, null if it does not read as one; -0.0 and 0.0 are one zero."""
    readable = isinstance(dtype, (T.NumericType, T.StringType))
    raw = c.try_cast("double") if readable else F.lit(None).cast("double")
    return F.when(raw == 0, F.lit(0.0)).otherwise(raw)


def exact_quantile(df: DataFrame, column: str, q: float, accuracy: int = 100_000) -> float | None:
    """:func:`exact_quantiles` for one quantile of one column."""
    return exact_quantiles(df, [column], [q], accuracy)[column][0]


def exact_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float], accuracy: int = 100_000
                    ) -> dict[str, list[float | None]]:
    """:func:`order_statistics` as a dict: one number per column and quantile reaches the driver."""
    found = {(r.c, r.q): r.value for r in order_statistics(df, cols, qs, accuracy).collect()}
    return {c: [found.get((i, j)) for j in range(len(qs))] for i, c in enumerate(cols)}


def order_statistics(df: DataFrame, cols: Sequence[str], qs: Sequence[float], accuracy: int = 100_000
                     ) -> DataFrame:
    """Exact discrete quantiles of several columns, lazily: ``(c, q, value)`` with the positions of
    column and quantile, the value at rank ``ceil(q * n)`` (1-based) of the column's non-null, non-NaN
    values (the ``percentile_approx`` / ``quantile_disc`` convention).  No row for a column without any.

    Selection by range partitioning, all columns and quantiles in one plan and three scans:

    1. a sketch per column gives splitters on both sides of every rank asked for;
    2. the rows are counted per range between two splitters (a few numbers, combined map-side), prefix
       sums over the ranges tell which one owns each rank, and the rank inside it;
    3. only the rows of the owning ranges - about ``2 / accuracy`` of all per quantile - are shuffled,
       counted per value before that, so a hot value is one row; a running sum picks the rank.

    The splitters decide how much is shuffled, never the result: the ranges cover everything, and their
    own ends are carried from step 2 to step 3.  Broadcast are one row per column and one per rank.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    xs = [F.when(~F.isnan(_number(col(c), types[c])), _number(col(c), types[c])) for c in cols]
    step = 1.0 / accuracy
    near = sorted({min(1.0, max(0.0, q + d)) for q in qs for d in (-step, step)})
    sketch = df.agg(*[F.percentile_approx(x, near, accuracy).alias(f"e{i}") for i, x in enumerate(xs)])
    splits = sketch.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), F.array_distinct(f"e{i}").alias("s")) for i in range(len(cols))])).alias("x")
    ).select("x.c", "x.s").where("s is not null")
    values = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("c"), x.alias("v")) for i, x in enumerate(xs)])).alias("x")
    ).select("x.c", "x.v").where("v is not null")

    below = F.size(F.filter("s", lambda e: e < F.col("v")))
    counts = (values.join(F.broadcast(splits), "c")
              .groupBy("c", F.get("s", below - 1).alias("lo"), F.get("s", below).alias("hi"))
              .agg(F.count(F.lit(1)).alias("n")))
    so_far = F.sum("n").over(Window.partitionBy("c").orderBy(F.col("lo").asc_nulls_first()))
    total = F.sum("n").over(Window.partitionBy("c"))
    asked = F.array(*[F.struct(F.lit(j).alias("q"), F.greatest(F.lit(1), F.ceil(F.lit(q) * F.col("total")))
                               .alias("rank")) for j, q in enumerate(qs)])
    owners = (counts.select("c", "lo", "hi", (so_far - F.col("n")).alias("before"), so_far.alias("until"),
                            total.alias("total"))
              .select("*", F.explode(asked).alias("a"))
              .where("a.rank > before and a.rank <= until")
              .select("c", F.col("a.q").alias("q"), "lo", "hi", (F.col("a.rank") - F.col("before")).alias("k")))

    at = (F.col("lo").isNull() | (F.col("v") > F.col("lo"))) & (F.col("hi").isNull() | (F.col("v") <= F.col("hi")))
    inside = (values.join(F.broadcast(owners.withColumnRenamed("c", "oc")), (F.col("c") == F.col("oc")) & at)
              .groupBy("c", "q", "k", "v").agg(F.count(F.lit(1)).alias("n")))
    run = F.sum("n").over(Window.partitionBy("c", "q").orderBy("v"))
    return (inside.select("c", "q", "v", "n", "k", run.alias("until"))
            .where("k > until - n and k <= until").select("c", "q", F.col("v").alias("value")))
