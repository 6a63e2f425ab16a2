"""Single operators: require, project, dedupe, pivot, profile, lookups, quality, split."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions.dates import calendar_parts, iso_year, sas_date
from starmart.functions.text import split_place
from starmart.operators import aggregate as AG
from starmart.operators.clean import dedupe, project, require
from starmart.operators.lookup import orphans, resolve
from starmart.operators.quality import Check, check_tables, orphan_report, require_ok


def test_require_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, float("nan")), (None, 4.0)], "a int, b double")
    assert sorted(r.a for r in require(df).collect()) == [1]
    assert sorted(r.a for r in require(df, ["b"]).collect() if r.a) == [1]
    assert require(df, ["a"]).count() == 3


def test_project_is_ansi_safe(spark):
    df = spark.createDataFrame([("12", "3.456", "2016-02-30", "x")], "a string, b string, c string, d string")
    schema = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("p", T.DecimalType(4, 2)),
                           T.StructField("c", T.DateType()), T.StructField("bad", T.IntegerType())])
    r = project(df, schema, {"n": "a", "p": "b", "bad": "d"}).collect()[0]
    assert (r.n, str(r.p), r.c, r.bad) == (12, "3.46", None, None)


def test_project_keeps_comments(spark):
    from starmart import tables as TB
    df = spark.createDataFrame([(1, "x")], "country_code int, country string")
    out = project(df, TB.DIM_COUNTRY)
    assert out.schema["country"].metadata["comment"] == "country label"


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_dedupe_is_deterministic(spark, parts):
    rows = [(k % 5, k % 3, f"s{(k * 7) % 11}", None if k % 4 == 0 else k) for k in range(200)]
    df = spark.createDataFrame(rows, "k int, a int, s string, v int").repartition(parts)
    got = sorted(tuple(r) for r in dedupe(df, ["k"]).collect())
    # brute force: per key the smallest (a, s, v) with nulls last
    expect = {}
    for k, a, s, v in rows:
        key = (a, s, (v is None, v or 0))
        if k not in expect or key < expect[k][0]:
            expect[k] = (key, (k, a, s, v))
    assert got == sorted(e[1] for e in expect.values())


def test_dedupe_orders_instants_not_local_hours(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 01:30 twice in the night of the clock change: the later instant must win
        df = (spark.createDataFrame([(1, 1478410200, 0), (1, 1478413800, 1)], "k int, s long, v int")
              .selectExpr("k", "timestamp_seconds(s) as t", "v"))
        assert [r.v for r in dedupe(df, ["k"], [("v", True), ("t", False)]).collect()] == [0]
        assert [r.v for r in dedupe(df.selectExpr("k", "1 as one", "t", "v"), ["k"],
                                    [("one", True), ("t", False)]).collect()] == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_dedupe_against_the_leading_direction(spark):
    low = -2**31
    rows = [(1, 0, low, "b", 1.0, b"\x01", True), (1, 0, 5, "b", 1.0, b"\x02", True), (2, 0, 1, "a", 1.0, b"", True),
            (2, 0, 1, "ab", 1.0, b"", True), (2, 0, 1, None, 1.0, b"", True), (3, 0, 1, "é", float("nan"), b"", True),
            (3, 0, 1, "é", 1e9, b"", False), (4, 0, 1, "x", None, b"\x00", None), (4, 0, 1, "x", None, b"", None)]
    df = spark.createDataFrame(rows, "k int, z int, i int, s string, d double, b binary, o boolean")
    order = [("z", True)] + [(c, False) for c in "isdbo"]
    got = {r.k: r for r in dedupe(df, ["k"], order).collect()}
    assert (got[1].i, got[2].s, bytes(got[4].b)) == (5, "ab", b"\x00")
    assert math.isnan(got[3].d)


def test_dedupe_descending_time_then_key(spark):
    ts = dt.datetime
    rows = [(1, 10, ts(2020, 1, 1, 5)), (1, 11, ts(2020, 1, 1, 5)), (1, 9, ts(2019, 1, 1)),
            (2, 20, None), (2, 21, ts(2000, 1, 1, 0, 0, 0, 500))]
    df = spark.createDataFrame(rows, "c int, k int, t timestamp_ntz")
    got = sorted(tuple(r) for r in dedupe(df, ["c"], [("t", False), ("k", True)]).collect())
    assert got == [(1, 10, ts(2020, 1, 1, 5)), (2, 21, ts(2000, 1, 1, 0, 0, 0, 500))]


def test_dedupe_all_columns_is_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x int, y string")
    assert dedupe(df, ["x", "y"]).count() == 2


def test_dedupe_plans_no_window(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = dedupe(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_pivot_first_lists_values(spark):
    df = spark.createDataFrame([(1, "A", 5), (1, "A", 3), (1, "B", 2), (2, "B", 9)], "k int, c string, v int")
    got = {r.k: (r.A, r.B, r.C) for r in AG.pivot_first(df, ["k"], "c", ["A", "B", "C"], "v").collect()}
    assert got == {1: (3, 2, None), 2: (None, 9, None)}


def test_profile_matches_brute_force(spark):
    vals = [float(x) for x in [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]]
    df = spark.createDataFrame([(v, -0.0) for v in vals], "x double, z double")
    rows = {r.column: r for r in AG.profile(df, ["x", "z"], quantiles=[0.25, 0.5, 0.75]).collect()}
    x = rows["x"]
    mean = sum(vals) / len(vals)
    sd = math.sqrt(sum((v - mean) ** 2 for v in vals) / (len(vals) - 1))
    assert x["count"] == 11 and x["min"] == 1.0 and x["max"] == 9.0
    assert abs(x["mean"] - mean) < 1e-12 and abs(x["stddev"] - sd) < 1e-12
    s = sorted(vals)
    assert (x["p25"], x["p50"], x["p75"]) == (s[math.ceil(0.25 * 11) - 1], s[math.ceil(0.5 * 11) - 1],
                                              s[math.ceil(0.75 * 11) - 1])
    assert math.copysign(1.0, rows["z"]["min"]) == 1.0      # -0.0 is reported as 0.0


def test_mean_by_decimal(spark):
    df = spark.createDataFrame([("a", "1.5"), ("a", "2.4"), ("b", "x")], "k string, v string")
    got = {r.k: r.m for r in AG.mean_by(df, ["k"], "v", alias="m").collect()}
    assert str(got["a"]) == "2.00" and got["b"] is None


def test_lookups(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "b"), (3, "zz")], "id int, code string")
    dim = spark.createDataFrame([("a", "A"), ("b", "B")], "code string, label string")
    assert sorted(r.id for r in resolve(fact, dim, "code").collect()) == [1, 2]
    assert [r.id for r in orphans(fact, dim, "code").collect()] == [3]
    twice = dim.union(dim)   # a repeated dimension key does not multiply orphans
    assert [r.id for r in orphans(fact, twice, "code").collect()] == [3]


def test_orphan_report(spark):
    fact = spark.createDataFrame([(1, "a"), (2, "zz"), (None, "zz"), (7, None)], "n int, code string")
    dim = spark.createDataFrame([("a", 1), ("a", 2)], "code string, n int")
    got = {(r.fact_column, r.dimension): r.orphans for r in orphan_report(fact, [
        ("code", "dim", dim, "code"), ("n", "dim", dim, "n"), ("n", "none", dim.limit(0), "n")]).collect()}
    assert got == {("code", "dim"): 2, ("n", "dim"): 1, ("n", "none"): 3}


def test_quality_report_and_raise(spark):
    good = spark.createDataFrame([(1,), (2,)], "k int")
    dup = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    empty = spark.createDataFrame([], "k int")
    rep = {r.table: r for r in check_tables({"good": (good, ["k"]), "dup": (dup, ["k"]),
                                             "empty": (empty, ["k"])}).collect()}
    assert (rep["good"].rows, rep["good"].ok) == (2, True)
    assert (rep["dup"].null_keys, rep["dup"].duplicate_keys, rep["dup"].ok) == (1, 1, False)
    assert rep["empty"].ok is False
    with pytest.raises(ValueError, match="dup, empty"):
        require_ok(check_tables({"good": (good, ["k"]), "dup": (dup, ["k"]), "empty": (empty, ["k"])}))
    checked = {r.table: r for r in check_tables({
        "types": Check(good, ["k"], good.selectExpr("cast(k as long) as k", "1 as more").schema),
        "same": Check(good, ["k"], good.schema, dup.union(good)),
        "lost": Check(good, ["k"], None, good.union(spark.createDataFrame([(9,)], "k int")))}).collect()}
    assert (checked["types"].type_mismatches, checked["types"].ok) == (2, False)
    assert (checked["same"].source_keys, checked["same"].ok) == (2, True)
    assert (checked["lost"].source_keys, checked["lost"].ok) == (3, False)


def test_dates(spark):
    df = spark.createDataFrame([(20454.0,), (-0.5,), (None,), (float("nan"),), (1e12,),
                                (2147483600.0,)], "d double")
    got = [r.x for r in df.select(sas_date("d").alias("x")).collect()]
    assert got == [dt.date(2016, 1, 1), dt.date(1959, 12, 31), None, None, None, None]
    r = df.limit(1).select(sas_date("d").alias("x")).select(
        *[c.alias(n) for n, c in calendar_parts("x").items()], iso_year("x").alias("iy")).collect()[0]
    assert (r.day, r.week, r.month, r.year, r.quarter, r.iy) == (1, 53, 1, 2016, 1, 2015)


def test_split_place_modes(spark):
    df = spark.createDataFrame([("ANCHORAGE, AK",), ("WASHINGTON DC",), ("PACIFIC, HWY. STATION, CA",),
                                ("CALGARY, CANADA",), ("NAPLES, FL #ARPT",), (None,)], "p string")
    ref = [tuple(r) for r in df.select(*split_place("p", "reference").values()).collect()]
    assert ref == [("ANCHORAGE", "AK"), ("WASHINGTON DC", None), ("PACIFIC", "HW"),
                   ("CALGARY", "CA"), ("NAPLES", "FL"), (None, None)]
    strict = [tuple(r) for r in df.select(*split_place("p", "strict").values()).collect()]
    assert strict == [("ANCHORAGE", "AK"), (None, None), ("PACIFIC, HWY. STATION", "CA"),
                      ("CALGARY", None), ("NAPLES", "FL"), (None, None)]


def test_safe_corr_is_null_where_undefined(spark):
    from starmart.plans.analytics import corr_by

    rows = [("const", 1.0, 2.0), ("const", 1.0, 3.0), ("one", 1.0, 1.0), ("ok", 1.0, 2.0),
            ("ok", 2.0, 4.1), ("ok", 3.0, 5.9), ("ok", None, 7.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r.g: (r.n_pairs, r.corr) for r in corr_by(df, ["g"], "x", "y").collect()}
    assert got["const"] == (2, None) and got["one"] == (1, None)
    xs, ys = [1.0, 2.0, 3.0], [2.0, 4.1, 5.9]
    mx, my = sum(xs) / 3, sum(ys) / 3
    c = sum((a - mx) * (b - my) for a, b in zip(xs, ys)) / (
        sum((a - mx) ** 2 for a in xs) ** 0.5 * sum((b - my) ** 2 for b in ys) ** 0.5)
    assert got["ok"] == (3, round(c, 6))


@pytest.mark.parametrize("accuracy", [2, 200, 100_000])  # splitters far off and close by
def test_exact_quantile_matches_brute_force(spark, accuracy):
    import random
    rnd = random.Random(7)
    vals = [round(rnd.uniform(0, 1000), 2) for _ in range(3000)] + [500.0] * 1500 + [None] * 5
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    s = sorted(v for v in vals if v is not None)
    for q in (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0):
        k = max(1, math.ceil(q * len(s)))
        assert AG.exact_quantile(df, "x", q, accuracy=accuracy) == s[k - 1], q
    hot = spark.createDataFrame([(7.0,)] * 1000 + [(1.0,), (9.0,)], "x double")
    assert AG.exact_quantile(hot, "x", 0.5, accuracy=accuracy) == 7.0
    assert AG.exact_quantile(spark.createDataFrame([(None,)], "x double"), "x", 0.5) is None


def test_order_statistics_of_several_columns_at_once(spark):
    import random
    rnd = random.Random(8)
    rows = [(rnd.gauss(0, 5), 3 if i % 3 == 0 else rnd.randint(-50, 50), None, float("nan") if i % 10 == 0 else
             rnd.choice([-0.0, 0.0, 1.5])) for i in range(4000)]  # one value in a third of the rows, ties, gaps
    df = spark.createDataFrame(rows, "a double, b int, c double, d double").repartition(7)
    qs = [0.0, 0.01, 0.33, 0.5, 0.9, 1.0]
    for accuracy in (10, 1000):
        got = AG.exact_quantiles(df, ["a", "b", "c", "d"], qs, accuracy)
        for i, name in enumerate("abcd"):
            own = sorted(r[i] for r in rows if r[i] is not None and r[i] == r[i])
            want = [float(own[max(1, math.ceil(q * len(own))) - 1]) if own else None for q in qs]
            assert got[name] == want, name
    assert AG.order_statistics(df.limit(0), ["a", "b"], [0.5]).collect() == []


def test_profile_of_text_columns(spark):
    df = spark.createDataFrame([("a", "10", 1), ("b", "x", 2), (None, "7", None)], "s string, m string, n int")
    got = {r.column: r for r in AG.profile(df, ["s", "m", "n"], quantiles=[0.5], exact=True).collect()}
    assert (got["s"]["count"], got["s"]["min"], got["s"]["max"], got["s"]["mean"], got["s"]["p50"]) == (2, "a", "b", None, None)
    assert (got["m"]["count"], got["m"]["min"], got["m"]["max"], got["m"]["mean"], got["m"]["p50"]) == (3, "10", "x", 8.5, 7.0)
    assert (got["n"]["count"], got["n"]["min"], got["n"]["mean"], got["n"]["p50"]) == (2, "1.0", 1.5, 1.0)


def test_sas_dates_to_the_ends_of_the_calendar(spark):
    rows = [(-715510.0,), (-715509.0,), (-0.5,), (1e6,), (2936549.9,), (2936550.0,), (float("nan"),)]
    got = [str(r.d) for r in spark.createDataFrame(rows, "x double").select(sas_date("x").cast("string").alias("d")).collect()]
    assert got == ["None", "0001-01-01", "1959-12-31", "4697-11-27", "9999-12-31", "None", "None"]


def test_csv_by_name_in_any_case_and_never_by_position(spark, tmp_path):
    from starmart.sources.delimited import read_delimited

    schema = T.StructType([T.StructField("city", T.StringType()), T.StructField("n", T.IntegerType())])
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "1.csv").write_text("dt,City,N\n2016-01-01,Oslo,x\n")
    got = read_delimited(spark, str(tmp_path / "a"), schema).collect()
    assert [tuple(r) for r in got] == [("Oslo", None)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "2.csv").write_text("n,City,dt\n5,Bergen,2016-01-02\n")
    both = read_delimited(spark, [str(tmp_path / "a"), str(tmp_path / "b")], schema).collect()
    assert sorted(map(tuple, both)) == [("Bergen", 5), ("Oslo", None)]
    (tmp_path / "a" / "3.csv").write_text("n,City,dt\n5,Bergen,2016-01-02\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, str(tmp_path / "a"), schema).collect()
    with pytest.raises(ValueError, match="missing columns"):
        read_delimited(spark, str(tmp_path / "b"), T.StructType([T.StructField("nope", T.StringType())]))
