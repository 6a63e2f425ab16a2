"""Source mixing: closed-form water filling against the iterative rule, copies, odd rows."""

import re

import pytest

from starmart.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, rate string"


def targets(sizes, weights=(1, 2, 3), most=3):
    """The rule as it reads: share by weight, stop at the limit, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s])
    names += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= most * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in open_})
            break
        target.update({s: most * sizes[s] for s in over})
        left -= sum(most * sizes[s] for s in over)
        open_ -= over
    return target


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


CASES = [
    {"a": 100, "b": 100, "c": 100},
    {"a": 1000, "b": 1, "c": 2, "d": 3},
    {"a": 5, None: 500, "b": 40, "Z": 7, "é": 9, "😀": 11, "￿": 3},
    {"only": 10},
    {"big": 900, "none": 0, "x": 30},
]


@pytest.mark.parametrize("sizes", CASES)
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r for r in mixing.source_targets(df).collect()}
    want = targets(sizes)
    assert set(got) == set(want)
    for s, r in got.items():
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s], rel=1e-12)
        assert 0 <= r.rate <= 3


def rows_of(n=600):
    rows = [(i, " ".join(["w"] * (i % 13)) + "\t\x85\xa0 x", "hot" if i % 3 == 0 else f"s{i % 5}", i, None)
            for i in range(n)]
    return rows + [(None, None, None, 0, "r"), (5, "", "s1", 0, None), (5, "one two", None, 0, None)]


def test_counts_and_mix_agree(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mix_counts(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + size_of(text)
    want = targets(sizes)
    taken = {}
    by_target = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
        by_target.setdefault((r.source_size, round(r.target, 6)), []).append(r)
    for s, t in want.items():
        own = by_target[(sizes[s], round(t, 6))]
        taken[s] = sum(r.taken for r in own)
    for s, t in want.items():  # near every target, also of small sources
        assert taken[s] == pytest.approx(t, rel=0.1, abs=15)
    again = mixing.mix_counts(df).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r.copies for r in got)


def test_many_sources_are_not_gathered_in_one_task(spark, monkeypatch):
    asked, real = [], mixing.stored
    monkeypatch.setattr(mixing, "stored", lambda df, name, n=None: asked.append((name, n)) or real(df, name, n))
    rows = [(i, "a b c", f"s{i}", i, None) for i in range(300)]
    assert mixing.mix_counts(spark.createDataFrame(rows, SCHEMA)).count() == 300
    assert {"mix-rates", "mix-plan"} <= {name for name, _ in asked} and {n for _, n in asked} == {None}


def test_copies_are_floor_plus_a_seeded_draw(spark):
    rows = spark.range(2000).selectExpr("id", "1.4D as rate")
    got = rows.select("id", mixing.copies(rows.rate, mixing.uniform("s", rows.id)).alias("n")).collect()
    assert {r.n for r in got} == {1, 2}
    assert sum(r.n == 2 for r in got) / 2000 == pytest.approx(0.4, abs=0.05)


def test_empty_table_and_no_words(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_counts(df).count() == 0
    assert mixing.mix(df).count() == 0
    silent = spark.createDataFrame([(1, "", "a", 0, None), (2, None, None, 0, None)], SCHEMA)
    assert {(r.target, r.taken) for r in mixing.mix_counts(silent).collect()} == {(0.0, 0)}


def test_no_python_on_the_main_path(spark):
    df = spark.createDataFrame(rows_of(20), SCHEMA)
    df = mixing.stored(df, "native")
    for out in (mixing.mix_counts(df), mixing.mix(df)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
