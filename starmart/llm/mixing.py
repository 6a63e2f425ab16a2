"""Mixing sources to target weights.

Tokens (words) are summed per source; the sources' targets share all tokens by weight, but no
target exceeds ``max_rate`` times its source: the excess is shared again by weight among the rest
until no target is above its limit (water filling).  In closed form: with ``r = limit / weight``
ascending, the water level is ``(total - limits up to k) / (weights after k)`` for the first k whose
next ``r`` is not below it.  A document is emitted ``floor(rate)`` times plus one hash-seeded
Bernoulli copy with probability ``rate - floor(rate)``.  The draws of a source share a seed: of
``tries`` seeds the one that brings the source's taken words nearest to its target, found by one
aggregate over all documents; a few long documents could otherwise carry a source far off.

The per-source sums are combined map-side, so a hot source is no hot key; ranks and running sums
over the sources are computed per range partition plus a prefix over the partitions, so even a
very long list of sources is never gathered in one task.

Defined results: a null text has size 0; a null source is a source of its own and comes last;
repeated rows of one id are decided alike; a source of size 0 has target 0; of seeds that come equally
near the target the first counts; texts of any length are counted whole; an empty table gives an empty
result; extra columns, of whatever name, are carried along.  No Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, quoted, stored

#: hash bits used for the Bernoulli draw: 13 hexadecimal digits of an MD5, exact in a double
DRAW_DIGITS = 13


def uniform(seed: str | Column, id_col: Column) -> Column:
    """A uniform number in [0, 1) from the MD5 of ``seed:id``."""
    seed = F.lit(seed) if isinstance(seed, str) else seed
    text = F.concat(seed, F.lit(":"), F.coalesce(id_col.cast("string"), F.lit("")))
    digits = F.substring(F.md5(text.cast("binary")), 1, DRAW_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** DRAW_DIGITS))


def running(df: DataFrame, order: list[Column], sums: dict[str, str], name: str) -> DataFrame:
    """Add running sums (``out: column``) and ``rank`` in the given total order, in range partitions."""
    at = stored(df.orderBy(*order).withColumn("part", F.spark_partition_id()), name)
    outs = {"rank": F.lit(1), **{k: F.col(v) for k, v in sums.items()}}
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = at.groupBy("part").agg(*[F.sum(v).alias(k) for k, v in outs.items()])
    starts = totals.select("part", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"start_{k}")
                                     for k in outs])
    inside = (Window.partitionBy("part").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (at.join(starts, "part")
            .select(*df.columns, *[(F.sum(v).over(inside) + F.col(f"start_{k}")).alias(k)
                                   for k, v in outs.items()]))


def source_targets(sizes: DataFrame, max_rate: int = 3, weights: tuple[int, ...] = (1, 2, 3)
                   ) -> DataFrame:
    """From (source, size) rows: source, source_size, weight, target, rate.

    ``weights`` repeat along the sources in code-point order, null last.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranked = running(per, order, {}, "mix-sources")
    index = ((F.col("rank") - 1) % len(weights)).cast("int")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), index + 1).cast("long")
    limit = (F.col("source_size") * max_rate).alias("limit")
    caps = ranked.select("source", "source_size", weight.alias("weight"), limit)
    full = running(caps, [F.col("limit") / F.col("weight"), *order],
                   {"limits": "limit", "weights": "weight"}, "mix-limits")
    full = stored(full, "mix-level")
    total, all_weights = full.agg(F.sum("source_size"), F.sum("weight")).first()
    # the level if exactly the sources before this one are at their limits
    level = ((F.lit(total) - (F.col("limits") - F.col("limit"))).cast("double")
             / (F.lit(all_weights) - (F.col("weights") - F.col("weight"))))
    found = (full.withColumn("level", level)
             .where(F.col("limit") >= F.col("level") * F.col("weight"))
             .agg(F.min(F.struct("rank", "level"))["level"]).first())[0]
    target = F.least(F.col("limit").cast("double"), F.lit(found).cast("double") * F.col("weight"))
    rate = F.least(F.lit(float(max_rate)), F.col("target") / F.col("source_size"))
    some = F.col("source_size") > 0
    return (full.select("source", "source_size", "weight",
                        F.when(some, target).otherwise(0.0).alias("target"))
            .withColumn("rate", F.when(some, rate).otherwise(0.0)))


def copies(rate: Column, draw: Column) -> Column:
    whole = F.floor(rate)
    return (whole + F.when(draw < rate - whole, 1).otherwise(0)).cast("int")


def source_plan(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str, max_rate: int,
                weights: tuple[int, ...], tries: int) -> tuple[DataFrame, DataFrame]:
    """The stored (id, source, size) rows, and per source: source_size, target, rate, seed."""
    slim = stored(docs.select(F.col(quoted(id_col)).alias("id"),
                              F.col(quoted(source_col)).alias("source"),
                              n_words(F.col(quoted(text_col))).alias("size")), "mix-sizes")
    rates = stored(source_targets(slim, max_rate, weights), "mix-rates")
    both = slim.alias("d").join(rates.alias("r"), F.col("d.source").eqNullSafe(F.col("r.source")))
    sums = both.groupBy("r.source").agg(*[
        F.sum(F.col("size") * copies(F.col("rate"), uniform(f"{seed}{k}", F.col("id")))).alias(f"t{k}")
        for k in range(tries)])
    off = F.array(*[F.struct(F.abs(F.col(f"t{k}") - F.col("target")).alias("off"), F.lit(k).alias("k"))
                    for k in range(tries)])
    picked = (rates.alias("r").join(sums.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")))
              .select("r.source", "source_size", "target", "rate",
                      F.concat(F.lit(seed), F.array_min(off)["k"].cast("string")).alias("seed")))
    return slim, stored(picked, "mix-plan")


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source", seed: str = "mix", max_rate: int = 3,
               weights: tuple[int, ...] = (1, 2, 3), tries: int = 16) -> DataFrame:
    """Per document: id, size, source_size, target, taken (size times copies), copies."""
    slim, plan = source_plan(docs, id_col, text_col, source_col, seed, max_rate, weights, tries)
    out = slim.alias("d").join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
    n = copies(F.col("rate"), uniform(F.col("seed"), F.col("id")))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("size") * n).alias("taken"), n.alias("copies"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", seed: str = "mix", max_rate: int = 3,
        weights: tuple[int, ...] = (1, 2, 3), tries: int = 16) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as its copies say."""
    _, plan = source_plan(docs, id_col, text_col, source_col, seed, max_rate, weights, tries)
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
                       F.col(quoted(source_col)).alias("from_source"),
                       F.col(quoted(id_col)).alias("from_id"))
    out = rows.join(plan.select("source", "rate", "seed"), F.col("from_source").eqNullSafe(F.col("source")))
    n = copies(F.col("rate"), uniform(F.col("seed"), F.col("from_id")))
    return out.select("row", F.explode(F.array_repeat(F.lit(1), n))).select("row.*")
