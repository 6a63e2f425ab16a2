"""Proofs of the stored summaries: a profile (A4, A7, A8), a correlation (G1) and top values (G3) after two
refreshes; top values of a wide column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import tables as TB
from ...operators import summaries as SM
from ...operators.merge import merge_by_key
from ...session import scratch_path
from ...sources.parquet import write_table
from ...sources.versions import Version, Versions, partition_folder
from .. import analytics as AN
from .. import pipeline as PL
from .analyses import _STAR_FACT_SQL, _star_fact, _temperature_corr_sql, _temperature_star
from .registry import _t, query

#: the year whose records change, by how many days they move, the month that is restated and the one that
#: is withdrawn (fixed parameters of the proofs)
YEAR, DAYS, RESTATED, WITHDRAWN = 1997, 40, 3, 5

_PARTS = TB.STAR[PL.FACT][2]

_REFRESHED_SQL = _STAR_FACT_SQL.replace("fact as (", "fact0 as (") + f""",
fact1 as (
  select * from fact0 where not (arrival_year = {YEAR} and (cicid % 7 = 0 or cicid % 11 = 0))
  union all
  select * replace (cast(year(arrival_date + {DAYS}) as integer) as arrival_year,
                    cast(month(arrival_date + {DAYS}) as integer) as arrival_month,
                    arrival_date + {DAYS} as arrival_date)
  from fact0 where arrival_year = {YEAR} and cicid % 7 = 0),
fact as (
  select * from fact1 where not (arrival_year = {YEAR} and arrival_month in ({RESTATED}, {WITHDRAWN}))
  union all
  select * replace (visitor_age + 1 as visitor_age)
  from fact1 where arrival_year = {YEAR} and arrival_month = {RESTATED} and travel_mode_code = 1)
"""


def _refreshed(spark, sf, states) -> Version:
    """The fact with the summary ``states`` beside it: built, then changed by record (rows that move to
    another month, rows that go), then one month restated and one withdrawn.  After each step only the
    states of the touched months are computed."""
    versions = Versions(spark, scratch_path(spark, "summarised"))

    def keep(change, touched=None):
        SM.maintain(change, PL.FACT, TB.FACT_ARRIVALS, "states", _PARTS, states, touched)
        return change.commit()

    change = versions.change()
    change.replace(PL.FACT, _star_fact(spark, sf), _PARTS)
    before = keep(change)

    old = before.read(PL.FACT, TB.FACT_ARRIVALS).where(F.col("arrival_year") == YEAR)
    day = F.date_add("arrival_date", DAYS)
    moved = old.where("cicid % 7 = 0").withColumns(
        {"arrival_date": day, "arrival_year": F.year(day), "arrival_month": F.month(day)})
    change = versions.change()
    touched = merge_by_key(change, PL.FACT, TB.FACT_ARRIVALS, "cicid", _PARTS, moved,
                           old.where("cicid % 11 = 0 and cicid % 7 <> 0").select("cicid"))
    keep(change, touched)

    change = versions.change()
    folders = [partition_folder(spark, _PARTS, (YEAR, m)) for m in (RESTATED, WITHDRAWN)]
    month = change.read(PL.FACT, TB.FACT_ARRIVALS).where(
        (F.col("arrival_year") == YEAR) & (F.col("arrival_month") == RESTATED) & (F.col("travel_mode_code") == 1))
    change.replace_partitions(PL.FACT, month.withColumn("visitor_age", F.col("visitor_age") + 1), _PARTS, drop=folders)
    return keep(change, folders)


_PROFILED = ["visitor_age", "visitor_residence_country", "arrival_port_code"]
_NUMBERS = _PROFILED[:2]
#: by how much an estimate may be off: three standard errors of the distinct count, ranks of the median
DISTINCT_ERROR, RANK_ERROR = 0.05, 0.02


def _profile_sql() -> str:
    rows = [f"""select travel_mode_code, '{c}' as "column", count({c}) as count, round(avg({c}), 6) as mean,
       round(stddev_samp({c}), 6) as stddev, cast(min({c}) as double) as min, cast(max({c}) as double) as max,
       cast(null as varchar) as min_text, cast(null as varchar) as max_text,
       true as distinct_within, true as median_within
from fact group by travel_mode_code""" for c in _NUMBERS]
    rows += [f"""select travel_mode_code, '{c}', count({c}), null, null, null, null, min({c}), max({c}), true, null
from fact group by travel_mode_code""" for c in _PROFILED if c not in _NUMBERS]
    return _REFRESHED_SQL + "\nunion all\n".join(rows)


@query("profile_merge", _profile_sql())
def profile_merge(spark, sf):
    """Profiles per travel mode from the monthly states after both refreshes; the estimates beside the exact
    distinct counts and the median's exact rank."""
    def states(rows: DataFrame) -> DataFrame:
        return SM.column_states(rows, [*_PARTS, "travel_mode_code"], _PROFILED)

    version = _refreshed(spark, sf, states)
    fact = version.read(PL.FACT, TB.FACT_ARRIVALS)
    profile = SM.merged_profile(version.read("states", states(fact).schema), ["travel_mode_code"], digits=6)
    values = fact.select("travel_mode_code", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v"),
                 (F.col(c) if c in _NUMBERS else F.lit(None)).cast("double").alias("x")) for c in _PROFILED])))
    median = profile.select(F.col("travel_mode_code").alias("_mode"), F.col("column").alias("_column"), "p50")
    exact = (values.join(median, F.col("travel_mode_code").eqNullSafe(F.col("_mode"))
                         & (F.col("column") == F.col("_column")))
             .groupBy("_mode", "_column").agg(
                 F.count_distinct("v").alias("d"), F.count("x").alias("n"),
                 F.count_if(F.col("x") < F.col("p50")).alias("below"), F.count_if(F.col("x") <= F.col("p50")).alias("upto")))
    near = F.abs(F.col("n_distinct") - F.col("d")) <= F.greatest(F.col("d") * DISTINCT_ERROR, F.lit(0))
    at = ((F.col("below") <= F.col("n") * (0.5 + RANK_ERROR)) & (F.col("upto") >= F.col("n") * (0.5 - RANK_ERROR)))
    return (profile.join(exact, F.col("travel_mode_code").eqNullSafe(F.col("_mode")) & (F.col("column") == F.col("_column")))
            .select("travel_mode_code", "column", "count", "mean", "stddev", "min", "max", "min_text", "max_text",
                    near.alias("distinct_within"), F.when(F.col("n") > 0, at).alias("median_within")))


@query("corr_incremental", _temperature_corr_sql("y, m", _REFRESHED_SQL))
def corr_incremental(spark, sf):
    """G1 from the co-moments per city and month, of which two refreshes computed the touched months only."""
    dims = _temperature_star(spark, sf)

    def states(rows: DataFrame) -> DataFrame:
        return AN.temperature_states(rows, *dims)

    version = _refreshed(spark, sf, states)
    schema = states(version.read(PL.FACT, TB.FACT_ARRIVALS)).schema
    return SM.merged_corr(version.read("states", schema), ["city"])


@query("profile_frequent", _REFRESHED_SQL + """
select arrival_port_code, visitor_residence_country as top, count(*) as top_n
from fact where visitor_residence_country is not null group by 1, 2
qualify row_number() over (partition by arrival_port_code order by count(*) desc, visitor_residence_country) = 1
""")
def profile_frequent(spark, sf):
    """G3's most frequent residence country per port from the monthly sketches after both refreshes."""
    def states(rows: DataFrame) -> DataFrame:
        return SM.frequent_states(rows, [*_PARTS, "arrival_port_code"], "visitor_residence_country")

    version = _refreshed(spark, sf, states)
    fact = version.read(PL.FACT, TB.FACT_ARRIVALS)
    return SM.most_frequent(fact, version.read("states", states(fact).schema), ["arrival_port_code"],
                            "visitor_residence_country")


@query("profile_frequent_wide", """
select source, word as top, count(*) as top_n
from (select source, unnest(string_split(text, ' ')) as word from documents) where word <> '' group by 1, 2
qualify row_number() over (partition by source order by count(*) desc, word) = 1
""")
def profile_frequent_wide(spark, sf):
    """The most frequent value of a wide column: words per source, from sketches per source and language."""
    words = (_t(spark, sf, "documents").select("source", "lang", F.explode(F.split("text", " ")).alias("word"))
             .where("word <> ''"))
    states, path = SM.frequent_states(words, ["source", "lang"], "word"), scratch_path(spark, "frequent")
    write_table(states, path)
    return SM.most_frequent(words, spark.read.schema(states.schema).parquet(path), ["source"], "word")
