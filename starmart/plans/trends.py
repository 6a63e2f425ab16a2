"""G4 beyond counts: complete weekly series, moving means, the same week a year before, slopes; and the
arrivals of chosen months through the date dimension, which prunes the fact's partitions at run time.

Rows are counted per group and week first, combined map-side, so a port with a third of all arrivals is a
few rows per task.  What the windows then sort is one row per group and week.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import iso_year
from ..operators.clean import col

#: a Monday; weeks are numbered from it
FIRST_MONDAY = "1969-12-29"


def weekly_series(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by, week_no, year, week, n)``: rows per group and ISO week, with a row of 0 for every week
    without any between the group's first and last week.

    ``week_no`` numbers the weeks without a gap, ``year`` and ``week`` are the ISO ones.  Rows without a
    date are left out; null is a group like any other.  One shuffle for the counts, one by group: a week
    brings its following empty weeks along by ``sequence`` up to the next one met, no join.
    """
    d = col(date).try_cast("date")
    week_no = F.floor(F.datediff(d, F.lit(FIRST_MONDAY).cast("date")) / 7).cast("int")
    keys = [col(b) for b in by]
    counts = (df.where(d.isNotNull()).groupBy(*keys, week_no.alias("_w"))
              .agg(F.count(F.lit(1)).alias("_n")))
    following = F.lead("_w").over(Window.partitionBy(*keys).orderBy("_w"))
    weeks = F.sequence(F.col("_w"), F.coalesce(following - 1, F.col("_w")))
    filled = counts.withColumn("_weeks", weeks).select(*keys, "_w", "_n", F.explode("_weeks").alias("week_no"))
    monday = F.date_add(F.lit(FIRST_MONDAY).cast("date"), F.col("week_no") * 7)
    return filled.select(*keys, "week_no", iso_year(monday).alias("year"),
                         F.weekofyear(monday).cast("int").alias("week"),
                         F.when(F.col("week_no") == F.col("_w"), F.col("_n")).otherwise(F.lit(0)).alias("n"))


def trend_moving(df: DataFrame, date: str, by: Sequence[str] = (), weeks: int = 4, digits: int = 6) -> DataFrame:
    """The weekly series with the mean of the last ``weeks`` weeks (fewer at the start), the count of the
    same ISO week a year before (null where the series has none, as for most weeks 53) and the change
    against it.  Both are range frames over one order each: no self-join."""
    keys = [col(b) for b in by]
    recent = Window.partitionBy(*keys).orderBy("week_no").rangeBetween(1 - weeks, 0)
    iso = F.col("year") * 100 + F.col("week")
    before = F.sum("n").over(Window.partitionBy(*keys).orderBy(iso).rangeBetween(-100, -100))
    series = weekly_series(df, date, by)
    return (series.withColumns({"moving_mean": F.round(F.avg("n").over(recent), digits), "n_year_before": before})
            .withColumn("change", F.col("n") - F.col("n_year_before")).drop("week_no"))


def trend_slope(df: DataFrame, date: str, by: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Per group: its weeks (empty ones too), rows, the slope of the least-squares line through the
    weekly counts (rows more per week) and how much of their variance it explains; both null for a
    single week, the latter also for a constant series."""
    series = weekly_series(df, date, by)
    x, y = F.col("week_no").cast("double"), F.col("n").cast("double")
    # the quotients through try_divide: a single week is no failed job under ANSI mode
    slope = F.try_divide(F.covar_pop(x, y), F.var_pop(x))
    fit = F.try_divide(F.pow(F.covar_pop(x, y), 2), F.var_pop(x) * F.var_pop(y))
    return series.groupBy(*[col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("weeks"), F.sum("n").alias("n"),
        # + 0.0: no negative zeros
        (F.round(slope, digits) + 0.0).alias("slope"), (F.round(fit, digits) + 0.0).alias("r2"))


def arrivals_of_months(fact: DataFrame, dates: DataFrame, months: Column, by: Sequence[str] = ()) -> DataFrame:
    """Arrivals per recorded month (and ``by`` columns) of the months that the date dimension says:
    ``months`` is a condition on its columns (``quarter = 2``, ``week = 1``, ...).

    The fact is partitioned by the recorded year and month and joined on them, so Spark runs the small
    dimension first and scans only the month folders it names (dynamic partition pruning).
    """
    wanted = (dates.where(months).select(F.col("year").alias("arrival_year"), F.col("month").alias("arrival_month"))
              .distinct())
    return (fact.join(wanted, ["arrival_year", "arrival_month"])
            .groupBy("arrival_year", "arrival_month", *[col(b) for b in by])
            .agg(F.count(F.lit(1)).alias("n")))
