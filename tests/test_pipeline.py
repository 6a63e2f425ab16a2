"""End to end: files in, eight Parquet tables out, quality report over them (C5, S2-S8, Q1-Q4),
and the stated analyses over the written star (G1-G4) checked against brute force."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart import tables as TB
from starmart.operators.quality import check_tables, require_ok
from starmart.plans import analytics as AN
from starmart.plans.pipeline import Inputs, build_all, read_star
from starmart.sources.parquet import write_table
from tests.test_labels import LABEL_FILE

TEMPS = """dt,AverageTemperature,AverageTemperatureUncertainty,City,Country,Latitude,Longitude
2016-04-01,20.4,0.3,Anchorage,United States,61N,150W
2016-04-02,21.6,0.3,Anchorage,United States,61N,150W
2016-04-01,12.5,0.3,Intl Falls,United States,48N,93W
2016-04-01,25.0,0.3,Paris,France,48N,2E
2016-04-01,30.0,0.3,Kabul,Afghanistan,34N,69E
2016-05-01,,0.3,Paris,France,48N,2E
"""

DEMO = """City;State;Median Age;Male Population;Female Population;Total Population;Number of Veterans;Foreign-born;Average Household Size;State Code;Race;Count
Anchorage;Alaska;32.2;152945;145750;298695;27492;33258;2.77;AK;Asian;36825
Anchorage;Alaska;32.2;152945;145750;298695;27492;33258;2.77;AK;White;188780
Intl Falls;Minnesota;45.1;3000;3100;6100;500;100;2.2;MN;White;5900
"""


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("inputs")
    (d / "temps.csv").write_text(TEMPS)
    (d / "demo.csv").write_text(DEMO)
    (d / "labels.SAS").write_bytes(LABEL_FILE.encode())
    rows = []
    for i in range(40):
        port = ["ALC", "INT", "ALC", "NAP"][i % 4]
        res = [101.0, 236.0][i % 2]
        age = [None, 10.0, 25.0, 40.0, 70.0][i % 5]
        rows.append((float(i), 2016.0, 4.0, 236.0, res, port, 20545.0 + (i % 3), 1.0, age, 2.0,
                     "F", "AA", "B2"))
    arrivals = spark.createDataFrame(rows, TB.ARRIVALS)
    write_table(arrivals, str(d / "arrivals"))
    out = str(tmp_path_factory.mktemp("star"))
    paths = build_all(spark, Inputs(str(d / "arrivals"), str(d / "temps.csv"), str(d / "demo.csv"),
                                    str(d / "labels.SAS")), out)
    return read_star(spark, paths)


def test_all_tables_written_with_contract(star):
    assert set(star) == set(TB.STAR)
    for name, df in star.items():
        schema, key, parts = TB.STAR[name]
        expect = [f.name for f in schema.fields if f.name not in parts] + parts
        assert df.columns == expect, name


def test_quality_report_over_star(star):
    rep = check_tables({n: (df, TB.STAR[n][1]) for n, df in star.items()})
    assert len(require_ok(rep)) == 8
    assert {r.table: r.rows for r in rep.collect()}["fact_i94_us_visitor_arrivals_table"] == 40


def test_temperature_tables_written(star):
    city = {(r.city, r.year, r.month): str(r.average_temperature)
            for r in star["dim_temperatures_us_cities_table"].collect()}
    assert city == {("Anchorage", 2016, 4): "21.00", ("Intl Falls", 2016, 4): "13.00"}


def test_visitor_profile(star):
    prof = {r.city: r for r in AN.visitor_profile(star["fact_i94_us_visitor_arrivals_table"],
                                                  star["dim_i94_port_table"]).collect()}
    # ports ALC (i%4 in 0,2), INT (1), NAP (3) -> 20, 10, 10 arrivals
    assert (prof["ALCAN"].arrivals, prof["INTL FALLS"].arrivals, prof["NAPLES"].arrivals) == (20, 10, 10)
    a = prof["ALCAN"]
    ages = [[None, 10.0, 25.0, 40.0, 70.0][i % 5] for i in range(40) if i % 4 in (0, 2)]
    assert a["unknown"] == sum(x is None for x in ages)
    assert a["0-17"] == sum(x is not None and x < 18 for x in ages)
    assert a["55+"] == sum(x is not None and x >= 55 for x in ages)
    assert a.top_visitor_residence_country == 101       # even i only at ALC -> all 101
    assert (a.visitor_gender_F, a.visitor_gender_M, a.travel_mode_code_1) == (20, 0, 20)


def test_trends(star):
    fact = star["fact_i94_us_visitor_arrivals_table"]
    weekly = {(r.year, r.week): r.n for r in AN.arrival_trends(fact, "week").collect()}
    days = [dt.date(2016, 4, 1) + dt.timedelta(days=i % 3) for i in range(40)]
    expect = {}
    for d in days:
        y, w, _ = d.isocalendar()
        expect[(y, w)] = expect.get((y, w), 0) + 1
    assert weekly == expect
    roll = {(r.year, r.quarter, r.month, r.level): r.n
            for r in AN.trend_rollup(fact, "arrival_date").collect()}
    assert roll[(None, None, None, 7)] == 40 and roll[(2016, 2, 4, 0)] == 40


def test_temperature_correlation_runs(star):
    out = AN.temperature_correlation(star["fact_i94_us_visitor_arrivals_table"],
                                     star["dim_i94_port_table"], star["dim_i94_country_table"],
                                     star["dim_temperatures_us_cities_table"],
                                     star["dim_temperatures_countries_table"])
    rows = {r.city: r for r in out.collect()}
    # ANCHORAGE vs the port city ALCAN do not match; INTL FALLS has one temperature month and
    # one residence country with a temperature (AFGHANISTAN): one pair, correlation undefined
    assert rows["INTL FALLS"].n_pairs == 1 and rows["INTL FALLS"].corr is None


def test_demography_correlation_runs(star):
    out = AN.demography_correlation(star["fact_i94_us_visitor_arrivals_table"],
                                    star["dim_i94_port_table"], star["dim_cities_demographic_table"])
    rows = {r.visitor_birth_country: r for r in out.collect()}
    assert rows[236].cities == 1         # only INTL FALLS, MN is in the demographics


def test_temperature_correlation_climatology(spark):
    # temperatures from other years than the arrivals: only the month-of-year climatology joins
    fact = spark.createDataFrame(
        [(i, 2016, m, "P1", 100 + i % 2) for i, m in enumerate([1, 1, 2, 2, 3, 3])],
        "cicid long, arrival_year int, arrival_month int, arrival_port_code string, "
        "visitor_residence_country int")
    port = spark.createDataFrame([("P1", "Town", "AK")], "port_code string, city string, state_code string")
    country = spark.createDataFrame([(100, "Aland"), (101, "Bland")], "country_code int, country string")
    city_t = spark.createDataFrame([(y, m, "town", float(m * 10 + y % 2)) for y in (2012, 2013) for m in (1, 2, 3)],
                                   "year int, month int, city string, average_temperature double")
    country_t = spark.createDataFrame(
        [(y, m, c, float(m * k)) for y in (2012, 2013) for m in (1, 2, 3) for c, k in (("ALAND", 2), ("Bland", -1))],
        "year int, month int, country string, average_temperature double")
    exact = AN.temperature_correlation(fact, port, country, city_t, country_t)
    assert exact.count() == 0
    clim = {r.city: r for r in AN.temperature_correlation(fact, port, country, city_t, country_t,
                                                          climatology=True).collect()}
    # rows per (country, month): city 10.5/20.5/30.5 against 2m (Aland) and -m (Bland)
    xs = [10.5, 20.5, 30.5] * 2
    ys = [2.0, 4.0, 6.0, -1.0, -2.0, -3.0]
    mx, my = sum(xs) / 6, sum(ys) / 6
    cov = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
    corr = cov / (sum((x - mx) ** 2 for x in xs) ** 0.5 * sum((y - my) ** 2 for y in ys) ** 0.5)
    assert clim["TOWN"].n_pairs == 6 and clim["TOWN"].corr == round(corr, 6)


def test_monthly_refresh_of_the_star(spark, tmp_path_factory):
    """S9 on the whole job: a second run with ``dynamic=True`` and only May arrivals replaces
    May and keeps April in the month-partitioned tables."""
    d = tmp_path_factory.mktemp("refresh")
    (d / "temps.csv").write_text(TEMPS)
    (d / "demo.csv").write_text(DEMO)
    (d / "labels.SAS").write_bytes(LABEL_FILE.encode())

    def arrivals(path, month, day_number, n):
        rows = [(float(month * 100 + i), 2016.0, float(month), 236.0, 101.0, "ALC",
                 day_number, 1.0, 30.0, 2.0, "F", "AA", "B2") for i in range(n)]
        write_table(spark.createDataFrame(rows, TB.ARRIVALS), path)

    out = str(tmp_path_factory.mktemp("star-refresh"))
    arrivals(str(d / "a1"), 4, 20545.0, 3)                       # April 2016
    build_all(spark, Inputs(str(d / "a1"), str(d / "temps.csv"), str(d / "demo.csv"),
                            str(d / "labels.SAS")), out)
    arrivals(str(d / "a2"), 5, 20575.0, 2)                       # May 2016
    paths = build_all(spark, Inputs(str(d / "a2"), str(d / "temps.csv"), str(d / "demo.csv"),
                                    str(d / "labels.SAS")), out, dynamic=True)
    fact = read_star(spark, paths)["fact_i94_us_visitor_arrivals_table"]
    got = {(r.arrival_month, r.n) for r in fact.groupBy("arrival_month").count()
           .withColumnRenamed("count", "n").collect()}
    assert got == {(4, 3), (5, 2)}


def test_command_line_build(spark, tmp_path_factory):
    from starmart.__main__ import main

    d = tmp_path_factory.mktemp("cli")
    (d / "temps.csv").write_text(TEMPS)
    (d / "demo.csv").write_text(DEMO)
    (d / "labels.SAS").write_bytes(LABEL_FILE.encode())
    rows = [(1.0, 2016.0, 4.0, 236.0, 101.0, "ALC", 20545.0, 1.0, 30.0, 2.0, "F", "AA", "B2")]
    write_table(spark.createDataFrame(rows, TB.ARRIVALS), str(d / "arr"))
    code = main(["--arrivals", str(d / "arr"), "--temperatures", str(d / "temps.csv"),
                 "--demographics", str(d / "demo.csv"), "--labels", str(d / "labels.SAS"),
                 "--out", str(tmp_path_factory.mktemp("cli-out"))])
    assert code == 0


def test_star_integrity_counts_orphans(star):
    from starmart.plans.pipeline import star_integrity

    rep = {(r.fact_column, r.dimension): r.orphans for r in star_integrity(star).collect()}
    # fixture arrivals: ports ALC/INT/NAP are all in the port dimension; residence 101 and 236
    # and birth 236 are listed countries; mode 1 is listed; dates come from the fact itself
    assert set(rep.values()) == {0}
    assert len(rep) == 5
    fact = star["fact_i94_us_visitor_arrivals_table"]
    odd = fact.withColumn("arrival_port_code", F.when(F.col("cicid") < 3, "???").otherwise(F.col("arrival_port_code"))) \
              .withColumn("arrival_date", F.when(F.col("cicid") == 5, F.lit("1999-01-01").cast("date"))
                          .otherwise(F.col("arrival_date")))
    rep = {r.fact_column: r.orphans for r in star_integrity(star | {"fact_i94_us_visitor_arrivals_table": odd}).collect()}
    assert (rep["arrival_port_code"], rep["arrival_date"], rep["travel_mode_code"]) == (3, 1, 0)


def test_a_failed_check_leaves_the_old_tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("failed")
    (d / "temps.csv").write_text(TEMPS)
    (d / "demo.csv").write_text(DEMO)
    (d / "labels.SAS").write_bytes(LABEL_FILE.encode())
    rows = [(1.0, 2016.0, 4.0, 236.0, 101.0, "ALC", 20545.0, 1.0, 30.0, 2.0, "F", "AA", "B2")]
    write_table(spark.createDataFrame(rows, TB.ARRIVALS), str(d / "good"))
    write_table(spark.createDataFrame([], TB.ARRIVALS), str(d / "bad"))
    out = str(tmp_path_factory.mktemp("failed-out"))
    rest = (str(d / "temps.csv"), str(d / "demo.csv"), str(d / "labels.SAS"))
    paths = build_all(spark, Inputs(str(d / "good"), *rest), out)
    before = {n: sorted(map(str, df.collect())) for n, df in read_star(spark, paths).items()}
    with pytest.raises(ValueError, match="dim_date_table, fact_i94"):
        build_all(spark, Inputs(str(d / "bad"), *rest), out)
    assert {n: sorted(map(str, df.collect())) for n, df in read_star(spark, paths).items()} == before


def test_spellings_of_one_place_count_once(spark):
    fact = spark.createDataFrame([(i, 2016, m, "P1", 100) for i, m in enumerate([1, 2, 3])],
                                 "cicid long, arrival_year int, arrival_month int, arrival_port_code string, "
                                 "visitor_residence_country int")
    port = spark.createDataFrame([("P1", "Town", "AK")], "port_code string, city string, state_code string")
    country = spark.createDataFrame([(100, "Aland"), (100, "ALAND ")], "country_code int, country string")
    city_t = spark.createDataFrame([(2016, m, c, float(m)) for m in (1, 2, 3) for c in ("Town", "TOWN")],
                                   "year int, month int, city string, average_temperature double")
    country_t = spark.createDataFrame([(2016, m, c, float(m)) for m in (1, 2, 3) for c in ("Aland", "aland")],
                                      "year int, month int, country string, average_temperature double")
    for climatology in (False, True):
        row, = AN.temperature_correlation(fact, port, country, city_t, country_t, climatology).collect()
        assert (row.n_pairs, row["corr"]) == (3, 1.0)
