"""The table builds on hand-made fixtures with the edge rows of FIXTURES.md (C1 C2 C4)."""

import datetime as dt
from decimal import Decimal

from starmart import tables as TB
from starmart.plans.pipeline import (arrival_tables, demographic_table, temperature_tables)


def _types(df_or_schema):
    schema = getattr(df_or_schema, "schema", df_or_schema)
    return [(f.name, f.dataType) for f in schema.fields]


# ---------------------------------------------------------------- C1 temperatures

def test_temperature_rounding_and_cleaning(spark):
    rows = [
        ("2016-01-01", "12.5", "Austin", "United States"),      # -> 13
        ("2016-01-02", "-3.5", "Austin", "United States"),      # -> -4
        ("2016-01-03", "-0.4", "Austin", "United States"),      # -> 0
        ("2016-01-04", None, "Austin", "United States"),        # no reading: dropped
        ("01/05/2016", "30.0", "Austin", "United States"),      # malformed date: dropped
        ("2016-01-05", "abc", "Austin", "United States"),       # bad number: null, ignored by avg
        ("2016-02-01", "150.2", "Austin", "United States"),     # mean 150 does not fit (4,2)
        ("2016-01-01", "20.4", "Paris", "France"),
        ("2016-01-02", "21.6", "Lyon", "France"),               # 20 and 22 -> 21.00
        ("2016-01-01", "5", None, "France"),                    # no city: dropped
    ]
    raw = spark.createDataFrame(rows, TB.TEMPERATURE_RAW)
    city, country = temperature_tables(raw)
    assert _types(city) == _types(TB.DIM_TEMPERATURE_CITY)
    assert _types(country) == _types(TB.DIM_TEMPERATURE_COUNTRY)
    got = {(r.year, r.month, r.city): r.average_temperature for r in city.collect()}
    # (13 - 4 + 0) / 3 = 3.0000 -> 3.00
    assert got == {(2016, 1, "Austin"): Decimal("3.00"), (2016, 2, "Austin"): None}
    assert [tuple(r) for r in country.collect()] == [(2016, 1, "France", Decimal("21.00"))]


def test_temperature_double_rounding(spark):
    # 47 readings of 1 and 153 of 0: mean 0.2350 -> decimal(14,4) 0.2350 -> (4,2) 0.24 (HALF_UP)
    rows = [("2016-03-01", "1", "X", "United States")] * 47 + \
           [("2016-03-01", "0.2", "X", "United States")] * 153
    city, _ = temperature_tables(spark.createDataFrame(rows, TB.TEMPERATURE_RAW))
    assert city.collect()[0].average_temperature == Decimal("0.24")


# ---------------------------------------------------------------- C2 demographics

def _demo(city, state, age, race, count, male="100", code="XX"):
    return (city, state, age, male, "110", "210", "5", "20", "2.555", code, race, count)


def test_demographics_pivot_and_dedupe(spark):
    rows = [
        _demo("Mobile", "Alabama", "38.25", "Asian", "10"),
        _demo("Mobile", "Alabama", "38.25", "White", "50"),
        _demo("Mobile", "Alabama", "38.25", "White", "40"),        # same race twice: min
        _demo("Tulsa", "Oklahoma", "35.0", "Asian", "7"),          # other races missing: null
        _demo("Tulsa", "Oklahoma", "36.0", "White", "70"),         # second median age: 2 groups
        _demo("Reno", "Nevada", "33.0", "Asian", None),            # a null: row dropped
    ]
    out = demographic_table(spark.createDataFrame(rows, TB.DEMOGRAPHICS_RAW))
    assert _types(out) == _types(TB.DIM_DEMOGRAPHICS)
    got = {(r.state, r.city): r for r in out.collect()}
    assert set(got) == {("Alabama", "Mobile"), ("Oklahoma", "Tulsa")}
    m = got[("Alabama", "Mobile")]
    assert (m.median_age, m.asian, m.white, m.hispanic_or_latino) == (Decimal("38.3"), 10, 40, None)
    assert m.avarage_household_size == Decimal("2.56")
    t = got[("Oklahoma", "Tulsa")]
    # the group with the smaller median age wins (first in the order of all columns)
    assert (t.median_age, t.asian, t.white) == (Decimal("35.0"), 7, None)


# ---------------------------------------------------------------- C4 arrivals

def _arr(cicid, arrdate, visa=2.0, res=101.0, port="NYC", mode=1.0, age=30.0, gender="F"):
    return (cicid, 2016.0, 4.0, 101.0, res, port, arrdate, mode, age, visa, gender, "AA", "B2")


def test_arrivals_fact_and_dates(spark):
    rows = [
        _arr(1.0, 20545.0),            # 2016-04-01
        _arr(2.0, 20574.9),            # 2016-04-30 (fraction floored)
        _arr(3.0, -0.5),               # 1959-12-31
        _arr(4.0, 0.0),                # 1960-01-01
        _arr(5.0, 20454.0),            # 2016-01-01, ISO week 53
        _arr(6.0, 20545.0, visa=1.0),  # business: dropped
        _arr(7.0, 20545.0, visa=3.0),  # student: dropped
        _arr(8.0, 20545.0, visa=None),
        _arr(None, 20545.0),           # each required column null: dropped
        _arr(9.0, 20545.0, res=None),
        _arr(10.0, 20545.0, port=None),
        _arr(11.0, None),
        _arr(12.0, 20545.0, mode=None),
        _arr(13.0, 20545.0, age=40.0, gender="M"),   # same cicid twice, different payload
        _arr(13.0, 20545.0, age=35.0, gender="F"),
    ]
    dates, fact = arrival_tables(spark.createDataFrame(rows, TB.ARRIVALS))
    assert _types(fact) == _types(TB.FACT_ARRIVALS)
    assert _types(dates) == _types(TB.DIM_DATE)
    by_id = {r.cicid: r for r in fact.collect()}
    assert sorted(by_id) == [1, 2, 3, 4, 5, 13]
    assert by_id[2].arrival_date == dt.date(2016, 4, 30)
    assert by_id[3].arrival_date == dt.date(1959, 12, 31)
    assert by_id[4].arrival_date == dt.date(1960, 1, 1)
    assert (by_id[13].visitor_age, by_id[13].visitor_gender) == (35, "F")  # smallest row wins
    d = {r.arrival_date: r for r in dates.collect()}
    assert len(d) == 5
    assert (d[dt.date(2016, 1, 1)].week, d[dt.date(2016, 1, 1)].year) == (53, 2016)
    assert d[dt.date(2016, 4, 30)].quarter == 2


def test_arrivals_csv_extract_matched_by_name(spark, tmp_path):
    from starmart.sources.arrivals import read_arrivals

    # extra and reordered columns, as a real extract may have them
    (tmp_path / "a.csv").write_text(
        "i94port,cicid,depdate,i94yr,i94mon,i94cit,i94res,arrdate,i94mode,i94bir,i94visa,gender,airline,visatype\n"
        "NYC,7,20550,2016,4,101,236,20545,1,30,2,F,AA,B2\n"
        "LAX,8,,2016,4,101,x,20546,1,31,2,M,UA,B2\n")
    a = read_arrivals(spark, str(tmp_path / "a.csv"), fmt="csv")
    assert [(f.name, f.dataType) for f in a.schema.fields] == [(f.name, f.dataType) for f in TB.ARRIVALS.fields]
    rows = {r.cicid: r for r in a.collect()}
    assert rows[7.0].i94port == "NYC" and rows[7.0].i94res == 236.0 and rows[7.0].arrdate == 20545.0
    assert rows[8.0].i94res is None
