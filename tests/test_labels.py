"""Label-file parsing (S5 E8 E9) and the code tables built from it (C3, J1)."""

import random
import re

from pyspark.sql import functions as F

from starmart.plans.pipeline import code_tables
from starmart.sources.labels import parse_formats, read_blocks, read_formats, write_formats

# A synthetic label file with the shapes of the real one: CRLF, tabs and blanks around '=',
# padded labels, a doubled quote, a blank after the closing quote, a code with an inner blank,
# '=' lines in a comment after the last block, and place labels without a comma, with two
# commas, foreign, and with a suffix.
LABEL_FILE = "\r\n".join([
    "libname library 'Your file location' ;",
    "proc format library=library ;",
    "/* I94CIT & I94RES - codes */",
    "  value i94cntyl",
    "   582 =  'MEXICO Air Sea, and Not Reported (I-94, no land arrivals)'",
    "   236 =  'AFGHANISTAN'",
    "   101 =  'ALBANIA' ",
    "   999 =  'No Country Code (999)' ;",
    "",
    "/* I94PORT - ports */",
    "  value $i94prtl",
    "   'ALC'\t=\t'ALCAN, AK             '",
    "   'INT'\t=\t'INT''L FALLS, MN      '",
    "   'DCA'\t=\t'WASHINGTON DC'",
    "   'PHW'\t=\t'PACIFIC, HWY. STATION, CA'",
    "   'CLG'\t=\t'CALGARY, CANADA'",
    "   'NAP'\t=\t'NAPLES, FL #ARPT'",
    "   'LIT'\t=\t'LITTLE ROCK, AR (BPS)'",
    "   'CP '\t=\t'No PORT Code (CP)'",
    "   'NK' \t=\t'No PORT Code (NK)'",
    ";",
    "",
    "value i94model",
    "\t1 = 'Air'",
    "\t2 = 'Sea'",
    "\t3 = 'Land'",
    "\t9 = 'Not reported' ;",
    "\t",
    "value i94addrl",
    "\t'AK'='ALASKA'",
    "\t'MN'='MINNESOTA'",
    "\t'CA'='CALIFORNIA'",
    "\t'FL'='FLORIDA'",
    "\t'AR'='ARKANSAS'",
    "\t'WY'='WYOMING' ",
    "\t'99'='All Other Codes' ;",
    "",
    "/* I94VISA - Visa codes collapsed into three categories:",
    "   1 = Business",
    "   2 = Pleasure",
    "   3 = Student",
    "*/",
    "",
])


def _write(tmp_path):
    p = tmp_path / "labels.SAS"
    p.write_bytes(LABEL_FILE.encode())
    return str(p)


def test_block_counts_and_comment_lines_ignored(spark, tmp_path):
    f = read_formats(spark, _write(tmp_path))
    counts = {r["fmt"]: r["count"] for r in f.groupBy("fmt").count().collect()}
    assert counts == {"i94cntyl": 4, "i94prtl": 9, "i94model": 4, "i94addrl": 7}
    assert f.filter(F.col("label").isin("Business", "Pleasure", "Student")).count() == 0


def test_codes_and_labels_cleaned(spark, tmp_path):
    f = {(r["fmt"], r["code"]): r["label"] for r in read_formats(spark, _write(tmp_path)).collect()}
    assert f[("i94prtl", "ALC")] == "ALCAN, AK"                 # padded label trimmed
    assert f[("i94prtl", "INT")] == "INTL FALLS, MN"            # quotes removed, as the reference
    assert f[("i94prtl", "CP")] == "No PORT Code (CP)"          # inner-blank code trimmed
    assert f[("i94prtl", "NK")] == "No PORT Code (NK)"
    assert f[("i94cntyl", "101")] == "ALBANIA"                  # blank after closing quote
    assert f[("i94addrl", "WY")] == "WYOMING"
    assert f[("i94cntyl", "582")].startswith("MEXICO Air Sea, and")


def test_code_tables_reference_mode(spark, tmp_path):
    country, port, mode = code_tables(read_formats(spark, _write(tmp_path)), "reference")
    assert sorted(r["country_code"] for r in country.collect()) == [101, 236, 582, 999]
    assert [(r["travel_mode_code"], r["travel_mode"]) for r in mode.orderBy("travel_mode_code").collect()] \
        == [(1, "Air"), (2, "Sea"), (3, "Land"), (9, "Not reported")]
    ports = {r["port_code"]: (r["city"], r["state_code"], r["state"]) for r in port.collect()}
    # no comma (DCA) and two commas (PHW -> 'HW') are lost; a foreign port gets a state (CA)
    assert ports == {
        "ALC": ("ALCAN", "AK", "ALASKA"),
        "INT": ("INTL FALLS", "MN", "MINNESOTA"),
        "CLG": ("CALGARY", "CA", "CALIFORNIA"),
        "NAP": ("NAPLES", "FL", "FLORIDA"),
        "LIT": ("LITTLE ROCK", "AR", "ARKANSAS"),
    }
    assert [f.name for f in port.schema.fields] == ["port_code", "city", "state_code", "state"]


def test_code_tables_strict_mode(spark, tmp_path):
    _, port, _ = code_tables(read_formats(spark, _write(tmp_path)), "strict")
    ports = {r["port_code"]: (r["city"], r["state_code"]) for r in port.collect()}
    assert ports["PHW"] == ("PACIFIC, HWY. STATION", "CA")    # two commas: last piece
    assert "CLG" not in ports                                   # 'CANADA' is not a state token
    assert ports["NAP"] == ("NAPLES", "FL")
    assert ports["LIT"] == ("LITTLE ROCK", "AR")
    assert "DCA" not in ports


def test_render_then_parse_round_trip(spark, scratch):
    rows = [("A1", "O'HARE, IL"), ("B 2", "PLAIN"), ("C3", "X, Y, Z")]
    df = spark.createDataFrame(rows, "code string, label string").repartition(2)
    path = scratch("labels")
    write_formats(df, path, "i94prtl", "code", "label")
    back = read_formats(spark, path)
    got = sorted((r["code"], r["label"]) for r in back.collect())
    # the doubled quote written for O'HARE is removed on the way back, as in the reference
    assert got == [("A1", "OHARE, IL"), ("B 2", "PLAIN"), ("C3", "X, Y, Z")]
    assert {r["fmt"] for r in back.collect()} == {"i94prtl"}


def test_parse_from_dataframe_with_many_files(spark):
    text = spark.createDataFrame([("value a\n 1='x' ;",), ("value $b\n 'k' = 'v' ;",)], "value string")
    got = sorted(tuple(r) for r in parse_formats(text).collect())
    assert got == [("a", "1", "x"), ("b", "k", "v")]


def test_rendered_files_are_bounded(spark, scratch):
    import glob
    df = spark.range(50).selectExpr("cast(id as string) as code", "concat('L', id) as label").coalesce(1)
    path = scratch("bounded")
    write_formats(df, path, "i94prtl", "code", "label", max_blocks_per_file=10)
    local = path.replace("file:", "")
    assert len(glob.glob(f"{local}/part-*")) == 5
    assert read_formats(spark, path).count() == 50


TRICKY = ("/* a; value x 1='no'; */ value a 1='x' /* ; */ 2='y' /* one; two; three */ 3='z';"
          "/*/ value b 9='no'; */ value b /*;*/ 1='u';value c 1='v';/* open; value d 1='no'; ")


def _small_ranges(spark, size):
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = {n: spark.conf.get(n) for n in names}
    for n in names:
        spark.conf.set(n, str(size))
    return old


def test_comments_reach_over_cuts_and_ranges(spark, tmp_path):
    (tmp_path / "a.txt").write_text(TRICKY)
    (tmp_path / "b.txt").write_text(TRICKY.replace("value c", "value e"))
    (tmp_path / "empty.txt").write_text("")
    want = sorted([("a", str(i), l) for i, l in enumerate("xyz", 1)] * 2 + [("b", "1", "u")] * 2
                  + [("c", "1", "v"), ("e", "1", "v")])
    for size in (1 << 20, 64, 7, 3):
        old = _small_ranges(spark, size)
        try:
            df = read_formats(spark, str(tmp_path))
            assert sorted(tuple(r) for r in df.collect()) == want, size
        finally:
            for n, v in old.items():
                spark.conf.set(n, v)


def test_one_large_file_is_read_by_many_tasks_alike(spark, tmp_path):
    blocks = [f"/* n; {i} */ value $f{i % 3} 'k{i}' = 'it''s {i}' /* ;; */ 'l{i}'='{'w' * (i % 90)}';\r\n"
              for i in range(3000)]
    p = tmp_path / "large.txt"
    p.write_bytes(("".join(blocks) + LABEL_FILE).encode())
    want = sorted(tuple(r) for r in parse_formats(spark.read.text(str(p), wholetext=True)).collect())
    old = _small_ranges(spark, 20_000)
    try:
        assert spark.read.option("lineSep", ";").text(str(p)).rdd.getNumPartitions() > 8
        assert sorted(tuple(r) for r in read_formats(spark, str(p)).collect()) == want
    finally:
        for n, v in old.items():
            spark.conf.set(n, v)
    assert len(want) == 6000 + 24


def test_the_text_of_label_files_is_not_shuffled(spark, tmp_path):
    """Only a row per range goes through an exchange, by file; before, every piece did, by file and range."""
    (tmp_path / "a.txt").write_text(TRICKY)
    plan = read_formats(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    dealt = [x for x in plan.splitlines() if "Exchange" in x and "hashpartitioning" in x]
    assert dealt and not any("start" in x for x in dealt)


def test_any_soup_of_marks_is_cut_as_the_whole_text_is(spark, tmp_path):
    """Against the comments of each whole file taken out at once; Latin-1 bytes as Spark reads them."""
    rng = random.Random(5)
    marks = ["/*", "*/", "/*/", "*", "/", ";", ";;", " value a 'k'='v' ", "\r\n", "value $b 1='\xe9' ", "x", ""]
    want = []
    for i in range(6):
        text = "".join(rng.choices(marks, k=(0, 3, 40, 80)[i % 4]))
        (tmp_path / f"{i}.txt").write_bytes(text.encode("latin-1"))
        seen = re.sub(r"(?s)/\*.*$", " ", re.sub(r"(?s)/\*.*?\*/", " ", text))
        own = seen.split(";")
        # nothing stands behind a last mark
        want += own[:-1] if text.endswith(";") and not own[-1] else own if text else []
    want = sorted(x.replace("\xe9", "�") + ";" for x in want)
    for size in (1 << 20, 24):
        old = _small_ranges(spark, size)
        try:
            got = read_blocks(spark, str(tmp_path)).collect()
            assert sorted(r["value"].replace("\xe9", "�") for r in got) == want, size
        finally:
            for n, v in old.items():
                spark.conf.set(n, v)
