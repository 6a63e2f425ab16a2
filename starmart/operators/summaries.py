"""Stored summaries that merge: a state per group and partition (month) of a table, from which profiles and
correlations over any set of months follow without reading the table again.

A state is small and of fixed size: count, mean and centred sums of squares and products, extremes, a
HyperLogLog and a KLL sketch; for most frequent values, a frequent-items sketch.  Merging is an aggregate like any other, combined map-side.  After a refresh
only the states of the touched partitions are computed again (:func:`maintain`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.versions import Change
from .clean import col

#: 2^12 HyperLogLog buckets: 1.6 % standard error of a distinct count (few values are counted exactly)
DISTINCT_BITS = 12
#: size of the KLL sketch: ranks within about 0.7 % of the rows
RANK_SIZE = 400


def maintain(change: Change, source: str, schema: T.StructType, name: str, partition_by: Sequence[str],
             states: Callable[[DataFrame], DataFrame], touched: Iterable[str] | None = None) -> None:
    """Bring the summary table ``name`` of ``change`` up to date with its table ``source``.

    ``states`` maps rows of ``source`` to states whose columns include ``partition_by``, the partition
    columns of both.  ``touched`` are the partition folders changed (as :func:`merge_by_key` returns them):
    only these are read and replaced, and a partition without rows left loses its states.  None: all.
    """
    if touched is None:
        change.replace(name, states(change.read(source, schema)), partition_by)
        return
    folders = list(touched)
    if folders:
        rows = change.read(source, schema, only=_present(change, source, folders))
        change.replace_partitions(name, states(rows), partition_by, drop=folders)


def _present(change: Change, source: str, folders: Sequence[str]) -> list[str]:
    """Those of the folders that the table still has."""
    have = {f for kept in change.tables[source][1].values() for f in kept or []}
    return [f for f in folders if f in have]


def _mean(c: Column) -> Column:
    """The mean; of equal values that value itself, so that a constant group has no spread by rounding."""
    return F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.avg(c))


def _m2(c: Column) -> Column:
    """The sum of squares about the mean, 0 for equal values."""
    return F.when(F.min(c) == F.max(c), 0.0).otherwise(F.var_pop(c) * F.count(c))


def _with_centre(states: DataFrame, keys: Sequence[str], means: Sequence[str]) -> DataFrame:
    """Each state beside the mean of its whole group, ``<mean>_all``, weighted by ``n``.

    Both sides are grouped by ``keys`` (null is a group like any other); the totals are one row a group."""
    def centre(m: str) -> Column:
        return F.when(F.min(m) == F.max(m), F.min(m)).otherwise(
            F.try_divide(F.sum(col("n") * col(m)), F.sum(F.when(col(m).isNotNull(), col("n")))))

    totals = (states.groupBy(*[col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
              .agg(*[centre(m).alias(f"{m}_all") for m in means]))
    return states.join(totals, _same_keys(keys))


# ------------------------------------------------------------------ correlations


def co_moments(df: DataFrame, keys: Sequence[str], x: str, y: str) -> DataFrame:
    """A state per ``keys`` for the correlation of ``x`` and ``y``: ``n`` pairs with both present, their
    means, and the centred sums ``m2_x``, ``m2_y`` and ``c_xy`` (null where ``n`` is 0)."""
    both = col(x).isNotNull() & col(y).isNotNull()
    xs, ys = F.when(both, col(x).cast("double")), F.when(both, col(y).cast("double"))
    n = F.count(F.when(both, 1))
    flat = (F.min(xs) == F.max(xs)) | (F.min(ys) == F.max(ys))
    return df.groupBy(*[col(k) for k in keys]).agg(
        n.alias("n"), _mean(xs).alias("mean_x"), _mean(ys).alias("mean_y"),
        _m2(xs).alias("m2_x"), _m2(ys).alias("m2_y"),
        F.when(flat, 0.0).otherwise(F.covar_pop(xs, ys) * n).alias("c_xy"))


def merged_corr(states: DataFrame, keys: Sequence[str], digits: int = 6, alias: str = "corr") -> DataFrame:
    """``n_pairs`` and the correlation per ``keys`` (one or more columns of the states) over all their
    states, as :func:`starmart.plans.analytics.corr_by` gives over the rows: null for fewer than two pairs
    or a constant side.

    The means of the states are centred at the group's own before they are squared, so no digits are lost
    where values are large beside their spread.
    """
    if not keys:
        raise ValueError("merged_corr needs at least one key")
    s = _with_centre(states, keys, ["mean_x", "mean_y"])
    dx, dy = F.col("mean_x") - F.col("mean_x_all"), F.col("mean_y") - F.col("mean_y_all")
    xx = F.sum(F.col("m2_x") + F.col("n") * dx * dx)
    yy = F.sum(F.col("m2_y") + F.col("n") * dy * dy)
    xy = F.sum(F.col("c_xy") + F.col("n") * dx * dy)
    return s.groupBy(*[col(k) for k in keys]).agg(
        F.sum("n").alias("n_pairs"),
        F.round(F.try_divide(xy, F.sqrt(xx) * F.sqrt(yy)), digits).alias(alias))


# ------------------------------------------------------------------ profiles


def column_states(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """A state per ``keys`` and column of ``cols``, one row each, all from one aggregate.

    ``n`` non-null values and ``distinct`` (HyperLogLog) for every column; ``mean``, ``m2``, ``lo``, ``hi``
    and ``ranks`` (KLL) for numeric ones, read as doubles; ``lo_text``, ``hi_text`` for all others.  NaN
    counts as missing.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs, states = [], []
    for i, name in enumerate(cols):
        numeric = isinstance(types[name], T.NumericType)
        number = col(name).cast("double") if numeric else F.lit(None).cast("double")
        # one zero
        number = F.when(number == 0, F.lit(0.0)).when(~F.isnan(number), number)
        text = F.lit(None).cast("string") if numeric else col(name).cast("string")
        n = F.count(number if numeric else text)
        parts = {
            "n": n, "mean": _mean(number), "m2": _m2(number),
            "lo": F.min(number), "hi": F.max(number), "lo_text": F.min(text), "hi_text": F.max(text),
            "distinct": F.hll_sketch_agg(number.cast("string") if numeric else text, DISTINCT_BITS),
            "ranks": F.kll_sketch_agg_double(number, F.lit(RANK_SIZE)) if numeric else F.lit(None).cast("binary"),
        }
        aggs += [c.alias(f"_{p}{i}") for p, c in parts.items()]
        states.append(F.struct(F.lit(name).alias("column"), *[F.col(f"_{p}{i}").alias(p) for p in parts]))
    wide = df.groupBy(*[col(k) for k in keys]).agg(*aggs)
    return wide.select(*[col(k) for k in keys], F.inline(F.array(*states)))


def merged_profile(states: DataFrame, keys: Sequence[str] = (), quantiles: Sequence[float] = (0.5,),
                   digits: int | None = None) -> DataFrame:
    """One row per ``keys`` and column over all their states: ``count``, ``n_distinct`` (estimate),
    ``mean``, ``stddev``, ``min``, ``max``, ``min_text``, ``max_text`` and a column ``pNN`` per quantile.

    Counts, moments and extremes are those of the rows; ``n_distinct`` has the error of
    :data:`DISTINCT_BITS` and the quantiles' ranks that of :data:`RANK_SIZE`, however many states merge.
    """
    def r(c: Column) -> Column:
        return c if digits is None else F.round(c, digits)

    groups = [*keys, "column"]
    s = _with_centre(states, groups, ["mean"])
    d = F.col("mean") - F.col("mean_all")
    some = F.when((F.col("n") > 0) & F.col("mean").isNotNull(), F.col("ranks"))
    merged = s.groupBy(*[col(k) for k in groups]).agg(
        F.sum("n").alias("count"), F.hll_union_agg("distinct").alias("_distinct"),
        F.first("mean_all").alias("mean"),  # equal in all rows of the group
        F.sum(F.col("m2") + F.col("n") * d * d).alias("_m2"),
        F.min("lo").alias("min"), F.max("hi").alias("max"),
        F.min("lo_text").alias("min_text"), F.max("hi_text").alias("max_text"),
        F.kll_merge_agg_double(some, F.lit(RANK_SIZE)).alias("_ranks"))
    numbers = F.col("mean").isNotNull()
    spread = F.when(F.col("count") > 1, F.sqrt(F.try_divide(F.col("_m2"), F.col("count") - 1)))
    return merged.select(
        *[col(k) for k in groups], "count", F.hll_sketch_estimate("_distinct").alias("n_distinct"),
        r(F.col("mean")).alias("mean"), r(spread).alias("stddev"), "min", "max", "min_text", "max_text",
        *[F.when(numbers, F.kll_sketch_get_quantile_double("_ranks", F.lit(float(q)))).alias(f"p{round(q * 100):02d}")
          for q in quantiles])


# ------------------------------------------------------------------ frequent values

#: values that a frequent-items sketch can name
TRACKED = 1000
#: values a row is compared with; a group that leaves more in question is counted whole
CANDIDATES = 64


def frequent_states(df: DataFrame, keys: Sequence[str], of: str, tracked: int = TRACKED) -> DataFrame:
    """A state per ``keys``: ``n`` non-null values of ``of`` and ``items``, a frequent-items sketch of them,
    of fixed size however many different values there are.  A group without values has no state."""
    return df.where(col(of).isNotNull()).groupBy(*[col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("n"),
        F.call_function("approx_top_k_accumulate", col(of), F.lit(tracked)).alias("items"))


def most_frequent(df: DataFrame, states: DataFrame, keys: Sequence[str], of: str, alias: str = "top",
                  count_alias: str = "top_n", tracked: int = TRACKED) -> DataFrame:
    """The most frequent non-null ``of`` per ``keys`` and its count, ties to the smallest value: as counting
    every value gives it, from stored ``states`` of the same rows (by ``keys`` and any finer ones, with the
    same ``tracked``).

    The merged sketches name frequent values with upper bounds of their counts.  Only those that may be the
    top one are counted in the rows.  The largest count is proven if it reaches the smallest bound named, as
    what is not named stays below it, or if it exceeds the number of rows not counted.  Groups without a proof
    (no value stands out), without a state, or with more than :data:`CANDIDATES` values in question have all
    their values counted.
    """
    marks = _candidates(states, keys, tracked)
    rows = df.where(col(of).isNotNull()).select(*[col(k) for k in keys], col(of).alias(alias))
    same = _same_keys(keys)
    asked = (rows.join(marks, same, "left")
             .where(F.col("_asked").isNull() | F.array_contains("_asked", col(alias))))
    best = _largest(asked, keys, alias, count_alias, ["_proof", "_rows"])
    proven = (F.col("_proof").isNull() | (col(count_alias) >= F.col("_proof"))
              | (col(count_alias) > F.col("_rows") - F.col("_counted")))
    open_keys = best.where(~proven).select(*[col(k).alias(f"_key{i}") for i, k in enumerate(keys)])
    rest = _largest(rows.join(open_keys, same, "left_semi"), keys, alias, count_alias)
    return best.where(proven).drop("_proof", "_rows", "_counted").unionByName(rest.drop("_counted"))


def _candidates(states: DataFrame, keys: Sequence[str], tracked: int) -> DataFrame:
    """Per group (``_key0``, ...): ``_rows``, ``_asked``, the values that may be the most frequent one, and
    ``_proof``, the count that proves it; the last two null if all values must be counted.

    A named value's count is above its bound less the smallest bound; a list as long as it may be can lack
    values with that smallest bound."""
    merged = states.groupBy(*[col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        F.call_function("approx_top_k_combine", F.col("items"), F.lit(tracked)).alias("_items"),
        F.sum("n").alias("_rows"))
    named = merged.withColumn("_named", F.call_function("approx_top_k_estimate", F.col("_items"), F.lit(tracked)))
    bounds = F.col("_named.count")
    asked = F.transform(F.filter("_named", lambda x: x["count"] >= F.array_max(bounds) - F.array_min(bounds)),
                        lambda x: x["item"])
    few = F.size(asked).between(1, CANDIDATES)
    proof = F.array_min(bounds) + F.when(F.size("_named") < tracked, 0).otherwise(1)
    return named.select(*[f"_key{i}" for i in range(len(keys))], "_rows",
                        F.when(few, asked).alias("_asked"), F.when(few, proof).alias("_proof"))


def _same_keys(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])


def _largest(rows: DataFrame, keys: Sequence[str], value: str, count: str, also: Sequence[str] = ()) -> DataFrame:
    """Per ``keys`` the value with the most rows, ties to the smallest, and all rows ``_counted``; ``also`` are
    equal within a group.  Counted per value first, map-side combined."""
    group = [*[col(k) for k in keys], *[F.col(a) for a in also]]
    counts = rows.groupBy(*group, col(value)).agg(F.count(F.lit(1)).alias("_n"))
    best = counts.groupBy(*group).agg(
        F.min(F.struct((-F.col("_n")).alias("_n"), col(value).alias("_v"))).alias("_best"), F.sum("_n").alias("_counted"))
    return best.select(*group, "_counted", F.col("_best._v").alias(value), (-F.col("_best._n")).alias(count))
