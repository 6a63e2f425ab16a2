"""Proofs of the analyses (G1-G4), on the test tables and on a star built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import tables as TB
from ...operators.lookup import enrich
from ...operators.match import best_matches
from ...session import scratch_path
from ...sources.parquet import write_table
from .. import adapters as AD
from .. import analytics as AN
from .. import pipeline as PL
from .builds import (_DEMO_SQL, _PORTS_SQL, _code_tables)  # noqa: F401
from .registry import _sql_mean_half_up, _t, query  # noqa: F401


# ===================================================================== G1-G4: analyses

_ORDERS_CUST_SQL = """
from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
"""


def _orders_customers(spark, sf) -> DataFrame:
    o = _t(spark, sf, "orders")
    c = _t(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return enrich(o, [(c, "o_custkey"), (n, "c_nationkey")], how="inner")


@query("corr_by_group", f"""
select n_name, count(*) filter (where o_totalprice is not null and c_acctbal is not null) as n_pairs,
       case when isnan(corr(o_totalprice, c_acctbal)) then null
            else round(corr(o_totalprice, c_acctbal), 6) end as corr
{_ORDERS_CUST_SQL} group by n_name
""")
def corr_by_group(spark, sf):
    return AN.corr_by(_orders_customers(spark, sf), ["n_name"], "o_totalprice", "c_acctbal")


_BAL_EDGES = [0, 2500, 5000, 7500]
_BAL_BANDS = ["below_0", "from_0", "from_2500", "from_5000", "from_7500"]


@query("profile_by_place", f"""
with t as (select n_name, o_orderpriority, o_orderstatus,
             case when c_acctbal is null then 'unknown' when c_acctbal < 0 then 'below_0'
                  when c_acctbal < 2500 then 'from_0' when c_acctbal < 5000 then 'from_2500'
                  when c_acctbal < 7500 then 'from_5000' else 'from_7500' end as band
           {_ORDERS_CUST_SQL}),
c as (select n_name, count(*) as orders,
        {', '.join(f"count(*) filter (where band = '{b}') as {b}" for b in _BAL_BANDS + ['unknown'])},
        {', '.join(f"count(*) filter (where o_orderstatus = '{v}') as o_orderstatus_{v}" for v in 'FO')},
        count(*) filter (where o_orderstatus not in ('F', 'O')) as o_orderstatus_other,
        count(*) filter (where o_orderstatus is null) as o_orderstatus_unknown
      from t group by n_name),
p as (select n_name, o_orderpriority as top_o_orderpriority, count(*) as top_o_orderpriority_n
      from t where o_orderpriority is not null group by n_name, o_orderpriority
      qualify row_number() over (partition by n_name order by count(*) desc, o_orderpriority) = 1)
select c.*, p.top_o_orderpriority, p.top_o_orderpriority_n from c left join p using (n_name)
""")
def profile_by_place(spark, sf):
    t = _orders_customers(spark, sf).withColumn(
        "band", AN.band(F.col("c_acctbal"), _BAL_EDGES, _BAL_BANDS))
    return AN.profile_by(t, ["n_name"], "band", _BAL_BANDS + ["unknown"], "o_orderpriority",
                         total_alias="orders", extra={"o_orderstatus": ["F", "O"]})


@query("trend_weekly", """
select cast(isoyear(o_orderdate) as integer) as year, cast(week(o_orderdate) as integer) as week,
       count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total
from orders group by all
""")
def trend_weekly(spark, sf):
    return AN.trend(_t(spark, sf, "orders"), "o_orderdate", "week", "o_totalprice")


@query("trend_quarterly", """
select cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter,
       count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total
from orders group by all
""")
def trend_quarterly(spark, sf):
    return AN.trend(_t(spark, sf, "orders"), "o_orderdate", "quarter", "o_totalprice")


@query("trend_rollup", """
select year, quarter, month, count(*) as n,
       cast(grouping_id(year, quarter, month) as integer) as level,
       cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total
from (select cast(year(o_orderdate) as integer) as year, cast(quarter(o_orderdate) as integer) as quarter,
             cast(month(o_orderdate) as integer) as month, o_totalprice from orders)
group by rollup (year, quarter, month)
""")
def trend_rollup(spark, sf):
    return AN.trend_rollup(_t(spark, sf, "orders"), "o_orderdate", "o_totalprice")


@query("trend_monthly", """
select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
       count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total
from orders group by all
""")
def trend_monthly(spark, sf):
    return AN.trend(_t(spark, sf, "orders"), "o_orderdate", "month", "o_totalprice")


# ===================================================================== G3 G4 on a built star

_STAR_FACT_SQL = """
with a as (
  select cast(l_orderkey * 8 + l_linenumber as double) as cicid, l_shipdate, l_linenumber,
         l_quantity, l_suppkey, l_linestatus, o_custkey, c_nationkey,
         date '1960-01-01' + cast(floor(cast(date_diff('day', date '1960-01-01', cast(l_shipdate as date)) as double)
             + l_discount) as integer) as arrival_date
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
  where l_returnflag = 'N'),
fact as (
  select cast(cicid as bigint) as cicid, cast(year(l_shipdate) as integer) as arrival_year,
         cast(month(l_shipdate) as integer) as arrival_month, arrival_date,
         'P' || cast(o_custkey as varchar) as arrival_port_code,
         cast(l_suppkey % 25 as integer) as visitor_birth_country,
         cast(c_nationkey as integer) as visitor_residence_country,
         cast(trunc(l_quantity) as integer) as visitor_age,
         case when l_linestatus = 'F' then 'F' else 'M' end as visitor_gender,
         case when l_linenumber <= 2 then 1 when l_linenumber <= 4 then 2
              when l_linenumber <= 6 then 3 else 9 end as travel_mode_code,
         'C' || cast(l_suppkey % 10 as varchar) as travel_airline,
         'B' || cast(l_linenumber as varchar) as travel_visa_type
  from a
  qualify row_number() over (partition by cicid order by
    arrival_year nulls last, arrival_month nulls last, arrival_date nulls last,
    arrival_port_code nulls last, visitor_birth_country nulls last,
    visitor_residence_country nulls last, visitor_age nulls last, visitor_gender nulls last,
    travel_mode_code nulls last, travel_airline nulls last, travel_visa_type nulls last) = 1)
"""


def _written(spark, name: str, df: DataFrame) -> DataFrame:
    """Write a star table (contract layout) to the shared scratch folder and read it back.

    The analyses run over written tables, as after ``build_all``; this also keeps each
    analysis plan small (Catalyst's constraint propagation grows very slow on one plan that
    spans the parsing, de-duplication and every join of the build).
    """
    path = scratch_path(spark, name)
    write_table(df, path, partition_by=TB.STAR[name][2])
    return PL.read_star(spark, {name: path})[name]


def _star_fact(spark, sf) -> DataFrame:
    arrivals = AD.arrivals_with_ports(_t(spark, sf, "lineitem"), _t(spark, sf, "orders"),
                                      _t(spark, sf, "customer"))
    return _written(spark, "fact_i94_us_visitor_arrivals_table",
                    PL.fact_table(PL.pleasure_arrivals(arrivals)))


def _star_port(spark, sf) -> DataFrame:
    return _written(spark, "dim_i94_port_table", _code_tables(spark, sf, "reference")[1])


_PORT_DIM_SQL = _PORTS_SQL.strip()[len("with "):] + """,
split as (select port_code, string_split(port, ',')[1] as city,
                 substring(replace(string_split(port, ',')[2], ' ', ''), 1, 2) as state_code
          from ports),
port_dim as (select port_code, city, state_code, state from split join states using (state_code))
"""


_PROFILE_COUNTS = {
    "0-17": "visitor_age < 18", "18-34": "visitor_age between 18 and 34",
    "35-54": "visitor_age between 35 and 54", "55+": "visitor_age >= 55", "unknown": "visitor_age is null",
    "visitor_gender_F": "visitor_gender = 'F'", "visitor_gender_M": "visitor_gender = 'M'",
    "visitor_gender_other": "visitor_gender not in ('F', 'M')", "visitor_gender_unknown": "visitor_gender is null",
    "travel_mode_code_1": "travel_mode_code = 1", "travel_mode_code_2": "travel_mode_code = 2",
    "travel_mode_code_3": "travel_mode_code = 3", "travel_mode_code_9": "travel_mode_code = 9",
    "travel_mode_code_other": "travel_mode_code not in (1, 2, 3, 9)",
    "travel_mode_code_unknown": "travel_mode_code is null"}


@query("visitor_profile_star", _STAR_FACT_SQL + ", " + _PORT_DIM_SQL + """,
f as (select fact.*, p.city, p.state_code from fact join port_dim p on fact.arrival_port_code = p.port_code),
c as (select city, state_code, count(*) as arrivals, """ + ", ".join(
        f'count(*) filter (where {cond}) as "{k}"' for k, cond in _PROFILE_COUNTS.items()) + """
      from f group by city, state_code),
t as (select city, state_code, visitor_residence_country as top_visitor_residence_country,
             count(*) as top_visitor_residence_country_n
      from f where visitor_residence_country is not null
      group by city, state_code, visitor_residence_country
      qualify row_number() over (partition by city, state_code
                                 order by count(*) desc, visitor_residence_country) = 1)
select c.*, """ + ", ".join(f'round("{k}" / arrivals, 6) as "{k}_share"' for k in _PROFILE_COUNTS) + """,
       t.top_visitor_residence_country, t.top_visitor_residence_country_n
from c left join t using (city, state_code)
""")
def visitor_profile_star(spark, sf):
    """G3 on a star built from the tables: fact (line items of pleasure trips, ports of the
    ordering customers) joined to the port dimension parsed from rendered label files."""
    return AN.visitor_profile(_star_fact(spark, sf), _star_port(spark, sf))


@query("arrival_trends_star", _STAR_FACT_SQL + """
select cast(isoyear(arrival_date) as integer) as year, cast(week(arrival_date) as integer) as week,
       count(*) as n
from fact group by all
""")
def arrival_trends_star(spark, sf):
    """G4 on the built fact table: arrivals per ISO week."""
    return AN.arrival_trends(_star_fact(spark, sf), "week")


@query("arrival_trends_port_star", _STAR_FACT_SQL + """
select arrival_port_code, cast(year(arrival_date) as integer) as year,
       cast(quarter(arrival_date) as integer) as quarter, count(*) as n
from fact group by all
""")
def arrival_trends_port_star(spark, sf):
    """G4 per port and quarter."""
    return AN.arrival_trends(_star_fact(spark, sf), "quarter", by=["arrival_port_code"])


@query("arrival_rollup_star", _STAR_FACT_SQL + """
select year, quarter, month, count(*) as n, cast(grouping_id(year, quarter, month) as integer) as level
from (select cast(year(arrival_date) as integer) as year, cast(quarter(arrival_date) as integer) as quarter,
             cast(month(arrival_date) as integer) as month from fact)
group by rollup (year, quarter, month)
""")
def arrival_rollup_star(spark, sf):
    """G4 with subtotals."""
    return AN.arrival_trends(_star_fact(spark, sf), "rollup")


_READINGS_SQL = """
readings as (
  select 1996 + event_id % 4 as y, event_id // 4 % 12 + 1 as m, cast(round(value / 10) as integer) as v,
         case when event_id % 3 = 0 then lower(c_name) else c_name end as city,
         case when event_id % 3 = 0 then lower(n_name) || ' ' else n_name end as country
  from events join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey),
city_dim as (select y, m, city, """ + _sql_mean_half_up("sum(v)", "count(v)", "decimal(4,2)") + """ as t
             from readings group by y, m, city),
country_dim as (select y, m, country, """ + _sql_mean_half_up("sum(v)", "count(v)", "decimal(4,2)") + """ as t
                from readings group by y, m, country),
arr as (select upper(trim(p.city)) as city, upper(trim(n_name)) as country, arrival_year as y, arrival_month as m
        from fact join port_dim p on arrival_port_code = port_code
             join nation on visitor_residence_country = n_nationkey)
"""


def _temperature_corr_sql(when: str, fact: str = _STAR_FACT_SQL) -> str:
    """``when``: the columns two temperatures are paired by."""
    return fact + ", " + _PORT_DIM_SQL + ", " + _READINGS_SQL + f""",
per as (select distinct city, country, {when} from arr),
by_city as (select upper(trim(city)) as city, {when}, avg(cast(t as double)) as ct from city_dim group by all),
by_country as (select upper(trim(country)) as country, {when}, avg(cast(t as double)) as kt
               from country_dim group by all),
r as (select per.city, ct, kt from per join by_city using (city, {when}) join by_country using (country, {when}))
select city, count(*) filter (where ct is not null and kt is not null) as n_pairs,
       case when isnan(corr(ct, kt)) then null else round(corr(ct, kt), 6) end as corr
from r group by city"""


def _temperature_star(spark, sf) -> list[DataFrame]:
    """Ports, countries and both temperature tables of a star built from the tables.  Readings come from
    the events: every customer is a city of the home country and its nation a country; each place is met
    in two spellings."""
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_name", "c_nationkey")
    e = _t(spark, sf, "events").join(c, "user_id").join(n, "c_nationkey")
    odd = F.col("event_id") % 3 == 0
    day = F.make_date((F.col("event_id") % 4 + 1996).cast("int"),
                      (F.floor(F.col("event_id") / 4) % 12 + 1).cast("int"), F.lit(15))
    city = F.when(odd, F.lower("c_name")).otherwise(F.col("c_name"))
    country = F.when(odd, F.concat(F.lower("n_name"), F.lit(" "))).otherwise(F.col("n_name"))
    places = F.array(F.struct(city.alias("City"), F.lit(PL.HOME_COUNTRY).alias("Country")),
                     F.struct(F.lit("-").alias("City"), country.alias("Country")))
    raw = e.select(day.cast("string").alias("dt"), (F.col("value") / 10).cast("string").alias("AverageTemperature"),
                   F.inline(places))
    cities, countries = PL.temperature_tables(raw)
    star_country = _written(spark, "dim_i94_country_table", _code_tables(spark, sf, "reference")[0])
    return [_star_port(spark, sf), star_country,
            _written(spark, "dim_temperatures_us_cities_table", cities),
            _written(spark, "dim_temperatures_countries_table", countries)]


def _temperature_corr(spark, sf, climatology: bool):
    """G1 on a star built from the tables."""
    return AN.temperature_correlation(_star_fact(spark, sf), *_temperature_star(spark, sf), climatology=climatology)


@query("temperature_corr_star", _temperature_corr_sql("y, m"))
def temperature_corr_star(spark, sf):
    """G1 over the months of arrival."""
    return _temperature_corr(spark, sf, False)


@query("temperature_corr_climate_star", _temperature_corr_sql("m"))
def temperature_corr_climate_star(spark, sf):
    """G1 over calendar months, temperatures averaged over all years."""
    return _temperature_corr(spark, sf, True)


_GROUPS = ["asian", "black_or_africanamerican", "hispanic_or_latino", "white",
           "american_indian_alaska_native"]


def _safe_corr_sql(x: str, y: str) -> str:
    return (f"case when isnan(corr({x}, {y})) then null "
            f"else round(corr({x}, {y}), 6) end")


@query("demography_corr_star", _STAR_FACT_SQL + ", " + _PORT_DIM_SQL + ", demo as (" + _DEMO_SQL
       + """),
f as (select fact.visitor_birth_country, p.city, p.state_code
      from fact join port_dim p on fact.arrival_port_code = p.port_code),
per as (select visitor_birth_country, upper(trim(city)) as _city, state_code, count(*) as arrivals
        from f group by all),
d as (select upper(trim(city)) as _city, state_code, """
       + ", ".join(f"sum({g}) / sum(total_population) as {g}_share" for g in _GROUPS) + """
      from demo group by all),
r as (select * from per join d using (_city, state_code))
select visitor_birth_country, count(*) as cities, """
       + ", ".join(f"{_safe_corr_sql('arrivals', g + '_share')} as corr_{g}" for g in _GROUPS)
       + """
from r group by visitor_birth_country
""")
def demography_corr_star(spark, sf):
    """G2 on a star built from the tables: per birth country, correlation over cities between
    arrivals and each group's share of the city population (demographics joined to the port
    cities on ``upper(trim(city))`` and the state code)."""
    demo = _written(spark, "dim_cities_demographic_table", PL.demographic_table(
        AD.demographics_raw(_t(spark, sf, "customer"), _t(spark, sf, "nation"),
                            _t(spark, sf, "region"), _t(spark, sf, "orders"))))
    return AN.demography_correlation(_star_fact(spark, sf), _star_port(spark, sf), demo,
                                     groups=_GROUPS)


@query("star_integrity", _STAR_FACT_SQL + ", " + _PORT_DIM_SQL + """,
modes as (select distinct cast(substring(o_orderpriority, 1, 1) as integer) as travel_mode_code
          from orders)
select 'arrival_port_code' as fact_column, 'dim_i94_port_table' as dimension, count(*) as orphans
from fact where arrival_port_code not in (select port_code from port_dim)
union all
select 'visitor_residence_country', 'dim_i94_country_table', count(*)
from fact where visitor_residence_country not in (select n_nationkey from nation)
union all
select 'visitor_birth_country', 'dim_i94_country_table', count(*)
from fact where visitor_birth_country not in (select n_nationkey from nation)
union all
select 'travel_mode_code', 'dim_i94_travel_mode_table', count(*)
from fact where travel_mode_code not in (select travel_mode_code from modes)
union all
select 'arrival_date', 'dim_date_table', count(*)
from fact where day(arrival_date) = 13
""")
def star_integrity(spark, sf):
    """J3/Q4 on a star built from the tables: orphan fact keys per dimension (ports of
    customers whose label has no state, travel mode 9 missing from the mode list, the 13th missing from the
    dates, ...)."""
    country, port, mode = _code_tables(spark, sf, "reference")
    fact = _star_fact(spark, sf)
    star = {
        "fact_i94_us_visitor_arrivals_table": fact,
        "dim_i94_port_table": _written(spark, "dim_i94_port_table", port),
        "dim_i94_country_table": _written(spark, "dim_i94_country_table", country),
        "dim_i94_travel_mode_table": _written(spark, "dim_i94_travel_mode_table", mode),
        "dim_date_table": _written(spark, "dim_date_table", PL.date_table(fact.filter(F.dayofmonth("arrival_date") != 13))),
    }
    return PL.star_integrity(star)


#: least similarity of the name proof in hundredths (fixed parameter)
NAMES_PERCENT = 40

_NAMES_SQL = """
places as (select c_custkey as place, p_name || ' ' || lower(n_name) || ', port' as label
           from customer join nation on c_nationkey = n_nationkey left join part on c_custkey = p_partkey),
cities as (select s_suppkey as city, upper(p_name) || ' ' || n_name as name
           from supplier join nation on s_nationkey = n_nationkey left join part on s_suppkey = p_partkey)
"""


@query("place_match", "with " + _NAMES_SQL + f""",
l as (select place, list_distinct(regexp_extract_all(upper(label), '[\\p{{L}}\\p{{N}}]+')) as a from places),
r as (select city, list_distinct(regexp_extract_all(upper(name), '[\\p{{L}}\\p{{N}}]+')) as b from cities),
c as (select place, city, len(list_intersect(a, b)) as n, len(a) + len(b) - len(list_intersect(a, b)) as u from l, r),
k as (select place, count(*) as n_links, max(n / u) as similarity, min_by(city, (1 - n / u, city)) as match
      from c where n * 100 >= u * {NAMES_PERCENT} and n > 0 group by place)
select l.place, k.match, round(k.similarity, 6) as similarity, coalesce(k.n_links, 0) as n_links
from l left join k using (place)
""")
def place_match(spark, sf):
    """Places without a state (a customer's part and nation, in lower case, with a word more) resolved by the
    words of the cities' names (suppliers)."""
    n = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    p = _t(spark, sf, "part").select("p_partkey", "p_name")
    c, s = _t(spark, sf, "customer"), _t(spark, sf, "supplier")
    places = (c.join(n, c.c_nationkey == n.n_nationkey).join(p, c.c_custkey == p.p_partkey, "left")
              .select(F.col("c_custkey").alias("place"),
                      F.concat("p_name", F.lit(" "), F.lower("n_name"), F.lit(", port")).alias("label")))
    cities = (s.join(n, s.s_nationkey == n.n_nationkey).join(p, s.s_suppkey == p.p_partkey, "left")
              .select(F.col("s_suppkey").alias("city"), F.concat(F.upper("p_name"), F.lit(" "), "n_name").alias("name")))
    return best_matches(places, "place", "label", cities, "city", "name", NAMES_PERCENT).withColumn(
        "similarity", F.round("similarity", 6))
