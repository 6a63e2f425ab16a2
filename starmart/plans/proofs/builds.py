"""Proofs of the table builds (C1-C4) and of the whole job (C5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import tables as TB
from ...operators.quality import check_tables
from ...session import scratch_path
from ...sources import labels as LB
from ...sources.delimited import write_delimited
from ...sources.parquet import write_table
from .. import adapters as AD
from .. import pipeline as PL
from .registry import ORACLE, _CNT, _SUM_INT, _sql_mean_half_up, _t, query  # noqa: F401


# ===================================================================== C1-C4: the table builds

_TEMP_HOME = "NATION_1"
_TEMP_SQL = """
with raw as (
  select cast(e.ts as date) as d, e.value, e.event_type as city, n.n_name as country
  from events e join customer c on e.user_id = c.c_custkey join nation n on c.c_nationkey = n.n_nationkey)
"""


@query("temperature_dim", _TEMP_SQL + f"""
, g as (select cast(year(d) as integer) as year, cast(month(d) as integer) as month, city,
          {_SUM_INT.format(v='value')} as s, {_CNT.format(v='value')} as c
        from raw where country = '{_TEMP_HOME}' group by all)
select year, month, city, {_sql_mean_half_up('s', 'c', 'decimal(6,2)')} as average_temperature from g
""")
def temperature_dim(spark, sf):
    raw = AD.temperature_raw(_t(spark, sf, "events"), _t(spark, sf, "customer"),
                             _t(spark, sf, "nation"))
    city, _ = PL.temperature_tables(raw, home=_TEMP_HOME, out="decimal(6,2)")
    return city


@query("temperature_dim_country", _TEMP_SQL + f"""
, g as (select cast(year(d) as integer) as year, cast(month(d) as integer) as month, country,
          {_SUM_INT.format(v='value')} as s, {_CNT.format(v='value')} as c
        from raw where country <> '{_TEMP_HOME}' group by all)
select year, month, country, {_sql_mean_half_up('s', 'c', 'decimal(6,2)')} as average_temperature
from g
""")
def temperature_dim_country(spark, sf):
    raw = AD.temperature_raw(_t(spark, sf, "events"), _t(spark, sf, "customer"),
                             _t(spark, sf, "nation"))
    _, country = PL.temperature_tables(raw, home=_TEMP_HOME, out="decimal(6,2)")
    return country


_RACE_SQL = "case o_orderstatus " + " ".join(
    f"when '{k}' then '{v}'" for k, v in AD.STATUS_RACE.items()) + " end"

_DEMO_SQL = f"""
with counts as (select o_custkey, o_orderstatus, count(*) as cnt from orders group by all),
raw as (
  select c.c_name as city, n.n_name as state,
         cast((case when o_orderstatus = 'P' then c.c_nationkey + 30 else c.c_nationkey + 20 end) as varchar)
           || '.' || lpad(cast(c.c_custkey % 100 as varchar), 2, '0') as median_age_text,
         c.c_custkey * 3 + 100 as male, c.c_custkey * 2 + 50 as female, c.c_custkey * 5 + 150 as total,
         c.c_nationkey * 10 as veterans, c.c_custkey % 97 as foreign_born,
         cast(c.c_nationkey % 4 + 1 as varchar) || '.' || lpad(cast(c.c_custkey % 1000 as varchar), 3, '0') as hh_text,
         upper(substring(r.r_name, 1, 2)) as state_code,
         {_RACE_SQL} as race, cnt
  from customer c join nation n on c.c_nationkey = n.n_nationkey
       join region r on n.n_regionkey = r.r_regionkey join counts k on k.o_custkey = c.c_custkey),
wide as (
  select state, state_code, city,
         try_cast(median_age_text as decimal(4,1)) as median_age,
         cast(male as integer) as male_population, cast(female as integer) as female_population,
         cast(total as integer) as total_population, cast(veterans as integer) as number_of_veterans,
         cast(foreign_born as integer) as number_of_foregn_born,
         try_cast(hh_text as decimal(4,2)) as avarage_household_size,
         min(cnt) filter (where race = 'American Indian and Alaska Native') as american_indian_alaska_native,
         min(cnt) filter (where race = 'Asian') as asian,
         min(cnt) filter (where race = 'Black or African-American') as black_or_africanamerican,
         min(cnt) filter (where race = 'Hispanic or Latino') as hispanic_or_latino,
         min(cnt) filter (where race = 'White') as white
  from raw
  group by city, state, median_age_text, male, female, total, veterans, foreign_born, hh_text, state_code)
select state, state_code, city, median_age, male_population, female_population, total_population,
       number_of_veterans, number_of_foregn_born, avarage_household_size,
       cast(american_indian_alaska_native as integer) as american_indian_alaska_native,
       cast(asian as integer) as asian, cast(black_or_africanamerican as integer) as black_or_africanamerican,
       cast(hispanic_or_latino as integer) as hispanic_or_latino, cast(white as integer) as white
from wide
qualify row_number() over (partition by state, city order by
  state_code nulls last, median_age nulls last, male_population nulls last,
  female_population nulls last, total_population nulls last, number_of_veterans nulls last,
  number_of_foregn_born nulls last, avarage_household_size nulls last,
  american_indian_alaska_native nulls last, asian nulls last, black_or_africanamerican nulls last,
  hispanic_or_latino nulls last, white nulls last) = 1
"""


@query("demographic_dim", _DEMO_SQL)
def demographic_dim(spark, sf):
    raw = AD.demographics_raw(_t(spark, sf, "customer"), _t(spark, sf, "nation"),
                              _t(spark, sf, "region"), _t(spark, sf, "orders"))
    return PL.demographic_table(raw)


def _code_tables(spark, sf, mode: str):
    path = scratch_path(spark, "labels")
    AD.write_label_files(path, _t(spark, sf, "customer"), _t(spark, sf, "nation"),
                         _t(spark, sf, "region"), _t(spark, sf, "orders"))
    return PL.code_tables(LB.read_formats(spark, path), place_mode=mode)


_PORTS_SQL = """
with states as (select upper(substring(r_name, 1, 2)) as state_code, r_name as state from region),
ports as (
  select 'P' || cast(c_custkey as varchar) as port_code,
         case when c_mktsegment = 'BUILDING' then c_name
              when c_mktsegment = 'AUTOMOBILE' then upper(c_mktsegment) || ', ' || c_name || ', ' || upper(substring(r_name, 1, 2))
              when c_mktsegment = 'FURNITURE' then c_name || ', ' || r_name
              else c_name || ', ' || upper(substring(r_name, 1, 2)) || ' #' || c_mktsegment end as port
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
"""


@query("place_dim", _PORTS_SQL + """
, split as (select port_code, string_split(port, ',')[1] as city,
                   substring(replace(string_split(port, ',')[2], ' ', ''), 1, 2) as state_code
            from ports)
select port_code, city, state_code, state from split join states using (state_code)
""")
def place_dim(spark, sf):
    return _code_tables(spark, sf, "reference")[1]


@query("place_dim_strict", _PORTS_SQL + """
, split as (
  select port_code,
         case when contains(port, ',') then regexp_extract(port, '^(.*),[^,]*$', 1) end as city,
         case when contains(port, ',') and regexp_extract(regexp_extract(port, ',([^,]*)$', 1),
                   '^\\s*([A-Z]{2})([^A-Za-z]|$)', 1) <> ''
              then regexp_extract(regexp_extract(port, ',([^,]*)$', 1), '^\\s*([A-Z]{2})([^A-Za-z]|$)', 1)
         end as state_code
  from ports)
select port_code, city, state_code, state from split join states using (state_code)
""")
def place_dim_strict(spark, sf):
    return _code_tables(spark, sf, "strict")[1]


@query("country_codes", """
select n_nationkey as country_code, n_name as country from nation
""")
def country_codes(spark, sf):
    return _code_tables(spark, sf, "reference")[0]


@query("travel_modes", """
select distinct cast(substring(o_orderpriority, 1, 1) as integer) as travel_mode_code,
       substring(o_orderpriority, 3) as travel_mode
from orders
""")
def travel_modes(spark, sf):
    return _code_tables(spark, sf, "reference")[2]


_ARRIVALS_SQL = """
with a as (
  select cast(l_orderkey * 8 + l_linenumber as double) as cicid,
         l_shipdate, l_returnflag, l_linestatus, l_suppkey, l_partkey, l_linenumber, l_quantity,
         date '1960-01-01' + cast(floor(cast(date_diff('day', date '1960-01-01', cast(l_shipdate as date)) as double)
             + l_discount) as integer) as arrival_date
  from lineitem where l_returnflag = 'N')
"""


@query("fact_build", _ARRIVALS_SQL + """
select cast(cicid as bigint) as cicid, cast(year(l_shipdate) as integer) as arrival_year,
       cast(month(l_shipdate) as integer) as arrival_month, arrival_date,
       l_returnflag || l_linestatus as arrival_port_code,
       cast(l_suppkey as integer) as visitor_birth_country,
       cast(l_partkey as integer) as visitor_residence_country,
       cast(trunc(l_quantity) as integer) as visitor_age, l_linestatus as visitor_gender,
       cast(l_linenumber as integer) as travel_mode_code,
       'C' || cast(l_suppkey % 10 as varchar) as travel_airline,
       'B' || cast(l_linenumber as varchar) as travel_visa_type
from a
qualify row_number() over (partition by cicid order by
  arrival_year nulls last, arrival_month nulls last, arrival_date nulls last,
  arrival_port_code nulls last, visitor_birth_country nulls last,
  visitor_residence_country nulls last, visitor_age nulls last, visitor_gender nulls last,
  travel_mode_code nulls last, travel_airline nulls last, travel_visa_type nulls last) = 1
""")
def fact_build(spark, sf):
    arrivals = AD.arrivals_from_lineitem(_t(spark, sf, "lineitem"))
    return PL.arrival_tables(arrivals)[1]


@query("arrival_dates", _ARRIVALS_SQL + """
select d as arrival_date, cast(day(d) as integer) as day, cast(week(d) as integer) as week,
       cast(month(d) as integer) as month, cast(year(d) as integer) as year,
       cast(quarter(d) as integer) as quarter
from (select distinct arrival_date as d from a)
""")
def arrival_dates(spark, sf):
    arrivals = AD.arrivals_from_lineitem(_t(spark, sf, "lineitem"))
    return PL.arrival_tables(arrivals)[0]


# ===================================================================== C5: the whole job

def _mean_temperature_sql(place: str, home: str) -> str:
    return (_TEMP_SQL + f""", g as (select cast(year(d) as integer) as year, cast(month(d) as integer) as month,
        {place}, {_SUM_INT.format(v='value')} as s, {_CNT.format(v='value')} as c
        from raw where country {home} '{_TEMP_HOME}' group by all)
      select year, month, {place}, {_sql_mean_half_up('s', 'c', 'decimal(4,2)')} as average_temperature from g""")


def _digest_sql(names: list[str]) -> str:
    text = ", ".join(f"coalesce(cast({c} as varchar), '~')" for c in names)
    return f"cast(coalesce(sum(cast('0x' || substr(md5(concat_ws('|', {text})), 1, 8) as bigint)), 0) as bigint)"


def _digest(df):
    """An order-free digest of all values of a table."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in df.columns])
    number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return df.agg(F.coalesce(F.sum(number), F.lit(0)).alias("digest"))


def _star_build_sql() -> str:
    """The eight tables from the oracles of the single builds: rows, keys and a digest of all values."""
    sources = {
        PL.FACT: (ORACLE["fact_build"], _ARRIVALS_SQL + "select count(distinct cicid) from a"),
        PL.DATES: (ORACLE["arrival_dates"], _ARRIVALS_SQL + "select count(distinct arrival_date) from a"),
        "dim_temperatures_us_cities_table": (_mean_temperature_sql("city", "="), None),
        "dim_temperatures_countries_table": (_mean_temperature_sql("country", "<>"), None),
        "dim_cities_demographic_table": (ORACLE["demographic_dim"], None),
        "dim_i94_country_table": (ORACLE["country_codes"], None),
        "dim_i94_port_table": (ORACLE["place_dim"], None),
        "dim_i94_travel_mode_table": (ORACLE["travel_modes"], None),
    }
    parts = []
    for i, (t, (sql, source)) in enumerate(sources.items()):
        schema, key, _ = TB.STAR[t]
        full = " and ".join(f"{k} is not null" for k in key)
        parts.append(
            f"select '{t}' as \"table\", count(*) as rows, count(*) filter (where not ({full})) as null_keys, "
            f"count(*) filter (where {full}) - count(distinct case when {full} then ({', '.join(key)}, 0) end) "
            f"as duplicate_keys, cast(0 as integer) as type_mismatches, "
            f"{f'({source})' if source else 'cast(null as bigint)'} as source_keys, "
            f"{_digest_sql(schema.names)} as digest from ({sql})")
    body = "\nunion all\n".join(parts)
    return (f"select *, rows > 0 and null_keys = 0 and duplicate_keys = 0 and "
            f"(source_keys is null or source_keys = rows) as ok from ({body})")


def _inputs(spark, sf, base: str, arrivals) -> PL.Inputs:
    """The driver tables rendered into the four raw inputs: temperature CSV, semicolon demographics
    CSV, label files, arrivals Parquet."""
    customer, nation = _t(spark, sf, "customer"), _t(spark, sf, "nation")
    temps = AD.temperature_raw(_t(spark, sf, "events"), customer, nation)
    write_delimited(temps, f"{base}/temperatures", sep=",")
    demo = AD.demographics_raw(customer, nation, _t(spark, sf, "region"), _t(spark, sf, "orders"))
    write_delimited(demo, f"{base}/demographics", sep=";")
    AD.write_label_files(f"{base}/labels", customer, nation, _t(spark, sf, "region"),
                         _t(spark, sf, "orders"))
    write_table(arrivals, f"{base}/arrivals")
    return PL.Inputs(f"{base}/arrivals", f"{base}/temperatures", f"{base}/demographics", f"{base}/labels")


@query("star_build", _star_build_sql())
def star_build(spark, sf):
    """C5 end to end: ``build_all`` writes the eight tables from the rendered inputs; the quality
    report and a digest of every value run over the tables read back."""
    inputs = _inputs(spark, sf, scratch_path(spark, "star-inputs"),
                     AD.arrivals_from_lineitem(_t(spark, sf, "lineitem")))
    star = PL.read_star(spark, PL.build_all(spark, inputs, scratch_path(spark, "star"), home=_TEMP_HOME,
                                           strict=False))
    report = check_tables(PL.star_checks(spark, star, inputs))
    digests = [_digest(df.select(*TB.STAR[n][0].names)).select(F.lit(n).alias("table"), "digest")
               for n, df in star.items()]
    return report.join(reduce(DataFrame.unionByName, digests), "table")


#: the month restated in the second extract, and by how many days its arrivals come later
#: (fixed parameters of the proof): some days then fall in the month after
LATE_YEAR, LATE_MONTH, LATE_DAYS = 1997, 5, 20


@query("incremental_star", f"""
with a as (select cast(l_orderkey * 8 + l_linenumber as bigint) as cicid, cast(l_shipdate as date) as d,
                  l_linenumber, year(l_shipdate) = {LATE_YEAR} and month(l_shipdate) = {LATE_MONTH} as late
           from lineitem where l_returnflag = 'N'),
new as (select cicid, d, d + {LATE_DAYS} as arrival_date from a where late and l_linenumber <= 3),
first as (select * from a qualify row_number() over (partition by cicid order by d) = 1),
fact as (select cicid, d, d as arrival_date from first where not late
         union all (select * from new qualify row_number() over (partition by cicid order by d) = 1)),
days as (select d as arrival_date from a union select arrival_date from new)
select 'fact' as part, cicid, cast(year(d) as integer) as year, cast(month(d) as integer) as month,
       arrival_date, cast(null as integer) as week from fact
union all
select 'date', null, cast(year(arrival_date) as integer), cast(month(arrival_date) as integer), arrival_date,
       cast(week(arrival_date) as integer) from days
""")
def incremental_star(spark, sf):
    """Two builds, the second one dynamic with one restated month whose arrivals come later, some on
    days of the month after: the fact replaces that month, the date dimension keeps all its days
    and gets the new ones."""
    arrivals = AD.arrivals_from_lineitem(_t(spark, sf, "lineitem"))
    late = (arrivals.filter((F.col("i94yr") == LATE_YEAR) & (F.col("i94mon") == LATE_MONTH)
                            & (F.col("i94mode") <= 3))
            .withColumn("arrdate", F.col("arrdate") + LATE_DAYS))
    out = scratch_path(spark, "star-refreshed")
    for rows, dynamic in ((arrivals, False), (late, True)):
        inputs = _inputs(spark, sf, scratch_path(spark, "star-inputs"), rows)
        paths = PL.build_all(spark, inputs, out, home=_TEMP_HOME, dynamic=dynamic, strict=False)
    star = PL.read_star(spark, paths)
    fact = star[PL.FACT].select(F.lit("fact").alias("part"), "cicid", F.col("arrival_year").alias("year"),
                                F.col("arrival_month").alias("month"), "arrival_date",
                                F.lit(None).cast("int").alias("week"))
    days = star[PL.DATES].select(F.lit("date").alias("part"), F.lit(None).cast("bigint").alias("cicid"),
                                 "year", "month", "arrival_date", "week")
    return fact.unionByName(days)
