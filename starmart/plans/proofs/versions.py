"""Proofs of versioned publication (C5, S7, S8) and of the keyed merge (S9)."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import tables as TB
from ...operators.merge import merge_by_key
from ...session import scratch_path
from ...sources.parquet import write_table
from ...sources.versions import Versions
from .. import adapters as AD
from .. import pipeline as PL
from .builds import (_TEMP_HOME, _ARRIVALS_SQL, LATE_DAYS, LATE_MONTH, LATE_YEAR, _digest, _digest_sql, _inputs,
                     _mean_temperature_sql)
from .registry import ORACLE, _t, query

_LATE = f"arrival_year = {LATE_YEAR} and arrival_month = {LATE_MONTH}"

_RESTATED = f"year(l_shipdate) = {LATE_YEAR} and month(l_shipdate) = {LATE_MONTH} and l_linenumber <= 3"

#: the fact after the refresh: the restated month has its first three line numbers only, later
_FACT_2 = f"""select * from ({ORACLE["fact_build"]}) where not ({_LATE}) union all by name
              select * replace (arrival_date + {LATE_DAYS} as arrival_date)
              from ({ORACLE["fact_build"].replace("l_returnflag = 'N'", f"l_returnflag = 'N' and {_RESTATED}")})"""
_DATES_2 = _ARRIVALS_SQL + f"""select d as arrival_date, cast(day(d) as integer) as day, cast(week(d) as integer) as week,
       cast(month(d) as integer) as month, cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter
from (select arrival_date as d from a union select arrival_date + {LATE_DAYS} from a
      where {_RESTATED})"""


def _versions_sql() -> str:
    same = {
        "dim_temperatures_us_cities_table": _mean_temperature_sql("city", "="),
        "dim_temperatures_countries_table": _mean_temperature_sql("country", "<>"),
        "dim_cities_demographic_table": ORACLE["demographic_dim"],
        "dim_i94_country_table": ORACLE["country_codes"],
        "dim_i94_port_table": ORACLE["place_dim"],
        "dim_i94_travel_mode_table": ORACLE["travel_modes"],
    }
    states = [{PL.FACT: ORACLE["fact_build"], PL.DATES: ORACLE["arrival_dates"], **same},
              {PL.FACT: _FACT_2, PL.DATES: _DATES_2, **same}]
    return "\nunion all\n".join(
        f"select cast({i} as integer) as version, '{t}' as \"table\", count(*) as rows, "
        f"{_digest_sql(TB.STAR[t][0].names)} as digest from ({sql})"
        for i, tables in enumerate(states, 1) for t, sql in tables.items())


@query("star_versions", _versions_sql())
def star_versions(spark, sf):
    """The star built, then refreshed with one restated month; both versions are read after the second:
    rows and a digest of all values of every table."""
    arrivals = AD.arrivals_from_lineitem(_t(spark, sf, "lineitem"))
    late = (arrivals.filter((F.col("i94yr") == LATE_YEAR) & (F.col("i94mon") == LATE_MONTH)
                            & (F.col("i94mode") <= 3))
            .withColumn("arrdate", F.col("arrdate") + LATE_DAYS))
    first = _inputs(spark, sf, scratch_path(spark, "star-inputs"), arrivals)
    second = replace(first, arrivals=scratch_path(spark, "late-arrivals"))
    write_table(late, second.arrivals)
    base = scratch_path(spark, "star-versions")
    built = [PL.build_version(spark, inputs, base, home=_TEMP_HOME, dynamic=dynamic, strict=False)
             for inputs, dynamic in ((first, False), (second, True))]
    versions = Versions(spark, base)
    out = []
    for v in built:
        for name, df in PL.read_version(versions.version(v.number)).items():
            rows = df.select(*TB.STAR[name][0].names)
            out.append(_digest(rows).select(F.lit(v.number).alias("version"), F.lit(name).alias("table"), "digest")
                       .crossJoin(rows.agg(F.count(F.lit(1)).alias("rows"))))  # one row each
    return reduce(DataFrame.unionByName, out).select("version", "table", "rows", "digest")


#: the months that the changes of the proof come from, and how many days changed records move (fixed
#: parameters of the proof)
MERGE_YEAR, MERGE_DAYS = 1997, 40


@query("incremental_merge", f"""
with fact as ({ORACLE["fact_build"]}),
moved as (
  select * replace (cast(year(arrival_date + {MERGE_DAYS}) as integer) as arrival_year,
                    cast(month(arrival_date + {MERGE_DAYS}) as integer) as arrival_month,
                    arrival_date + {MERGE_DAYS} as arrival_date, visitor_age + 1 as visitor_age)
  from fact where arrival_year = {MERGE_YEAR} and cicid % 7 = 0),
added as (select * replace (-cicid as cicid) from fact where arrival_year = {MERGE_YEAR} and cicid % 13 = 0)
select * from fact where not (arrival_year = {MERGE_YEAR} and (cicid % 7 = 0 or cicid % 11 = 0))
union all select * from moved
union all select * from added
""")
def incremental_merge(spark, sf):
    """Changed records move 40 days on (most into another month), others are deleted or new; a record
    both changed and deleted stays with its new values."""
    parts = TB.STAR[PL.FACT][2]
    fact = PL.arrival_tables(AD.arrivals_from_lineitem(_t(spark, sf, "lineitem")))[1]
    versions = Versions(spark, scratch_path(spark, "merged-fact"))
    change = versions.change()
    change.replace(PL.FACT, fact, parts)
    before = change.commit()
    old = before.read(PL.FACT, TB.FACT_ARRIVALS).where(F.col("arrival_year") == MERGE_YEAR)
    day = F.date_add("arrival_date", MERGE_DAYS)
    moved = old.where("cicid % 7 = 0").withColumns({
        "arrival_date": day, "arrival_year": F.year(day), "arrival_month": F.month(day),
        "visitor_age": F.col("visitor_age") + 1})
    added = old.where("cicid % 13 = 0").withColumn("cicid", -F.col("cicid"))
    change = versions.change()
    merge_by_key(change, PL.FACT, TB.FACT_ARRIVALS, "cicid", parts, moved.unionByName(added),
                 old.where("cicid % 11 = 0").select("cicid"))
    return change.commit().read(PL.FACT, TB.FACT_ARRIVALS).select(*TB.FACT_ARRIVALS.names)
