"""Proofs of the trends (G4): moving means, slopes, pruned months."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import pipeline as PL
from .. import trends as TR
from .analyses import _STAR_FACT_SQL, _star_fact, _written
from .registry import query

_SERIES_SQL = _STAR_FACT_SQL + """,
w as (select {by} as port, date_diff('day', date '1969-12-29', arrival_date) // 7 as week_no, count(*) as n
      from fact group by all),
span as (select port, min(week_no) as lo, max(week_no) as hi from w group by port),
grid as (select port, unnest(range(lo, hi + 1)) as week_no from span),
series as (select port, week_no, coalesce(n, 0) as n,
                  cast(isoyear(date '1969-12-29' + cast(7 * week_no as integer)) as integer) as year,
                  cast(week(date '1969-12-29' + cast(7 * week_no as integer)) as integer) as week
           from grid left join w using (port, week_no))
"""


@query("trend_moving", _SERIES_SQL.format(by="travel_airline") + """
select a.port as travel_airline, a.year, a.week, a.n,
       round(avg(a.n) over (partition by a.port order by a.week_no rows between 3 preceding and current row), 6)
         as moving_mean,
       b.n as n_year_before, a.n - b.n as change
from series a left join series b on a.port = b.port and b.year = a.year - 1 and b.week = a.week
""")
def trend_moving(spark, sf):
    """Weekly arrivals per airline on the built fact."""
    return TR.trend_moving(_star_fact(spark, sf), "arrival_date", ["travel_airline"])


@query("trend_slope", _SERIES_SQL.format(by="arrival_port_code") + """
select port as arrival_port_code, count(*) as weeks, cast(sum(n) as bigint) as n,
       round(regr_slope(n, week_no), 6) + 0.0 as slope,
       case when count(*) > 1 and var_pop(n) > 0 then round(regr_r2(n, week_no), 6) + 0.0 end as r2
from series group by port
""")
def trend_slope(spark, sf):
    """The line through the weekly arrivals of every port, weeks without any included."""
    return TR.trend_slope(_star_fact(spark, sf), "arrival_date", ["arrival_port_code"])


@query("trend_pruned", _STAR_FACT_SQL + """,
wanted as (select distinct cast(year(arrival_date) as integer) as arrival_year,
                  cast(month(arrival_date) as integer) as arrival_month
           from fact where quarter(arrival_date) = 2 and year(arrival_date) = 1997)
select arrival_year, arrival_month, travel_mode_code, count(*) as n
from fact join wanted using (arrival_year, arrival_month) group by all
""")
def trend_pruned(spark, sf):
    """Arrivals by travel mode in the months of one quarter, named by the date dimension."""
    fact = _star_fact(spark, sf)
    dates = _written(spark, PL.DATES, PL.date_table(fact))
    return TR.arrivals_of_months(fact, dates, (F.col("quarter") == 2) & (F.col("year") == 1997), ["travel_mode_code"])
