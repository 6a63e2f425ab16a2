"""Weekly series, moving means, slopes (G4); kept and rejected rows."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import types as T

from starmart.operators import rejects as RJ
from starmart.plans import trends as TR
from starmart.sources.delimited import read_delimited, read_lines


def days(n, start=dt.date(2014, 12, 20), seed=3):
    import random
    rnd = random.Random(seed)
    return [(rnd.choice(["P", "Q", None]), start + dt.timedelta(days=rnd.choice([0, 1, 5, 40, 41, 200, 371, 372, 735])))
            for _ in range(n)] + [("one", dt.date(2016, 1, 1)), ("P", None)]


def brute_series(rows):
    counts = Counter((p, (d - dt.date(1969, 12, 29)).days // 7) for p, d in rows if d)
    out = {}
    for p in {p for p, _ in counts}:
        own = [w for q, w in counts if q == p]
        for w in range(min(own), max(own) + 1):
            iso = (dt.date(1969, 12, 29) + dt.timedelta(weeks=w)).isocalendar()
            out[p, w] = (iso[0], iso[1], counts[p, w])
    return out


def test_series_means_and_the_year_before(spark):
    rows = days(300) + [("hot", dt.date(2015, 5, 5))] * 300
    df = spark.createDataFrame(rows, "port string, d date")
    want = brute_series(rows)
    got = TR.weekly_series(df, "d", ["port"]).collect()
    assert {(r.port, r.week_no): (r.year, r.week, r.n) for r in got} == want and len(got) == len(want)
    iso = {(p, y, w): n for (p, _), (y, w, n) in want.items()}
    moving = TR.trend_moving(df, "d", ["port"], weeks=3).collect()
    assert len(moving) == len(want)
    place = {(p, y, w): k for (p, k), (y, w, _) in want.items()}
    for r in moving:
        k = place[r.port, r.year, r.week]
        last = [want[r.port, i][2] for i in range(k - 2, k + 1) if (r.port, i) in want]
        assert r.moving_mean == pytest.approx(sum(last) / len(last), abs=1e-6)
        assert r.n_year_before == iso.get((r.port, r.year - 1, r.week))
        assert r.change == (None if r.n_year_before is None else r.n - r.n_year_before)
    slopes = {r.port: r for r in TR.trend_slope(df, "d", ["port"]).collect()}
    assert slopes["one"].slope is None and slopes["hot"].r2 is None
    own = [(k, n) for (p, k), (_, _, n) in want.items() if p == "P"]
    mx, my = (sum(v) / len(own) for v in zip(*own))
    slope = sum((x - mx) * (y - my) for x, y in own) / sum((x - mx) ** 2 for x, _ in own)
    assert slopes["P"].slope == pytest.approx(slope, abs=1e-6) and slopes["P"].weeks == len(own)
    assert TR.trend_slope(df.limit(0), "d", ["port"]).count() == TR.trend_moving(df.limit(0), "d").count() == 0


SCHEMA = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("x", T.DoubleType()),
                       T.StructField("s", T.StringType())])


def test_every_row_is_kept_or_rejected_with_its_reasons(spark, scratch, tmp_path):
    (tmp_path / "rows.csv").write_text("1,2.5,a\n,x,b\n7,,\n1,2\n1,2,3,4\n3,NaN,c\n99999999999,1,d\n4,y,e\n")
    raw = read_lines(spark, str(tmp_path / "rows.csv"), ["n", "x", "s"])
    rows = RJ.judged(raw, SCHEMA, ["n", "x"], corrupt="_corrupt_record")
    path = scratch("judged")
    counts = RJ.write_judged(rows, path, RJ.reasons_of(SCHEMA, ["n", "x"]))
    assert counts == {"read": 8, "kept": 1, "rejected": 7, "malformed row": 2, "n: missing": 1, "n: not int": 1,
                      "x: missing": 2, "x: not double": 2}
    assert [tuple(r) for r in RJ.read_kept(spark, path, SCHEMA).collect()] == [(1, 2.5, "a")]
    bad = {r.raw["_corrupt_record"] or tuple(r.raw)[:3]: r.reasons for r in RJ.read_rejected(spark, path, raw.schema).collect()}
    assert bad["1,2"] == bad["1,2,3,4"] == ["malformed row"]
    assert bad[(None, "x", "b")] == ["n: missing", "x: not double"]
    assert bad[("3", "NaN", "c")] == ["x: missing"] and bad[("99999999999", "1", "d")] == ["n: not int"]


def test_optional_fields_reject_nothing_and_empty_tables_count_zero(spark, scratch):
    df = spark.createDataFrame([("1", "x", None)], "n string, x string, s string")
    rows = RJ.judged(df, SCHEMA, ["n"])
    assert rows.first().outcome == "kept" and rows.first().x is None
    counts = RJ.write_judged(RJ.judged(df.limit(0), SCHEMA, ["n"]), scratch("none"), RJ.reasons_of(SCHEMA, ["n"]))
    assert set(counts.values()) == {0}
    with pytest.raises(ValueError):
        RJ.judged(df, SCHEMA, ["nowhere"])


def test_columns_that_differ_in_case_only_are_refused(spark, tmp_path):
    (tmp_path / "c.csv").write_text("City,city\na,b\n")
    with pytest.raises(ValueError):
        read_delimited(spark, str(tmp_path / "c.csv"), T.StructType([T.StructField("City", T.StringType())]))
