"""Versioned publication: whole versions whatever dies, shared partitions, keyed merge, release."""

import os

import pytest
from pyspark.sql import types as T

from starmart.operators.merge import merge_by_key
from starmart.plans import pipeline as PL
from starmart.sources import parquet as PQ
from starmart.sources import versions as V

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("x", T.StringType()),
                       T.StructField("y", T.IntegerType()), T.StructField("m", T.IntegerType())])
PARTS = ["y", "m"]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(version, name="t", only=None):
    return sorted((tuple(r) for r in version.read(name, SCHEMA, only).select("k", "x", "y", "m").collect()), key=str)


BASE = [(1, "a", 2016, 1), (2, "b", 2016, 1), (3, "c", 2016, 2), (4, "d", 2016, 3), (5, "e", None, 3)]


@pytest.fixture
def versions(spark, scratch):
    v = V.Versions(spark, scratch("versions"))
    assert v.latest() is None and v.numbers() == []
    change = v.change()
    change.replace("t", frame(spark, BASE), PARTS)
    change.replace("flat", frame(spark, BASE[:2]))
    change.commit()
    return v


def test_partitions_are_replaced_and_shared(spark, versions):
    first = versions.latest()
    change = versions.change()
    change.replace_partitions("t", frame(spark, [(9, "z", 2016, 2)]), PARTS, drop=["y=2016/m=3"])
    change.replace("flat", frame(spark, []))
    assert rows_of(versions.latest()) == sorted(BASE, key=str)  # nothing is visible yet
    second = change.commit()
    assert (first.number, second.number) == (1, 2) and versions.latest().tables == second.tables
    assert rows_of(second) == sorted([*BASE[:2], (9, "z", 2016, 2), BASE[4]], key=str)
    assert rows_of(second, "flat") == [] and rows_of(first) == sorted(BASE, key=str)
    assert set(first.tables["t"][1]) & set(second.tables["t"][1])  # months that did not change: same files
    assert rows_of(second, only=["y=2016/m=2"]) == [(9, "z", 2016, 2)]


def test_two_writers_cannot_publish_one_version(spark, versions):
    a, b = versions.change(), versions.change()
    a.append("flat", frame(spark, [(7, "a", 1, 1)]))
    b.append("flat", frame(spark, [(8, "b", 1, 1)]))
    a.commit()
    with pytest.raises(RuntimeError):
        b.commit()
    assert versions.numbers() == [1, 2]
    assert [r[0] for r in rows_of(versions.latest(), "flat")] == [1, 2, 7]


def test_release_keeps_what_versions_use(spark, versions):
    change = versions.change()
    change.replace_partitions("t", frame(spark, [(9, "z", 2016, 2)]), PARTS)
    change.replace("flat", frame(spark, BASE[:1]))
    second = change.commit()
    versions.change().write("t", frame(spark, BASE))  # a job that died
    assert len(versions.release(keep=2)) == 1
    assert versions.release(keep=1) == []  # version 2 still uses the first generation
    assert versions.numbers() == [2]
    assert rows_of(second) == sorted([*BASE[:2], (9, "z", 2016, 2), *BASE[3:]], key=str)
    with pytest.raises(ValueError):
        versions.release(keep=0)


def test_merge_moves_changes_adds_and_deletes(spark, versions):
    first = versions.latest()
    change = versions.change()
    upserts = frame(spark, [(1, "moved", 2016, 2), (6, "new", 2017, 1), (3, "same month", 2016, 2), (6, "zz", 2017, 1)])
    deletes = spark.createDataFrame([(5,), (3,), (77,), (None,)], "k int")
    folders = merge_by_key(change, "t", SCHEMA, "k", PARTS, upserts, deletes)
    assert folders == sorted(["y=2016/m=1", "y=2016/m=2", "y=2017/m=1", "y=__HIVE_DEFAULT_PARTITION__/m=3"])
    second = change.commit()
    assert rows_of(second) == sorted([(1, "moved", 2016, 2), (2, "b", 2016, 1), (3, "same month", 2016, 2),
                                      (4, "d", 2016, 3), (6, "new", 2017, 1)], key=str)
    assert rows_of(first) == sorted(BASE, key=str)
    root = next(iter(first.tables["t"][1]))
    assert second.tables["t"][1][root] == ["y=2016/m=3"]  # not rewritten


def test_merge_of_nothing_and_of_broken_upserts(spark, versions):
    change = versions.change()
    assert merge_by_key(change, "t", SCHEMA, "k", PARTS) == []
    assert merge_by_key(change, "t", SCHEMA, "k", PARTS, frame(spark, []), spark.createDataFrame([(99,)], "k long")) == []
    assert change.tables == versions.latest().tables
    with pytest.raises(Exception, match="has no k"):
        merge_by_key(change, "t", SCHEMA, "k", PARTS, frame(spark, [(None, "x", 2016, 1)]))
    every = spark.createDataFrame([(i,) for i in range(10)], "k long")
    merge_by_key(change, "t", SCHEMA, "k", PARTS, deletes=every)
    assert rows_of(change.commit()) == []


class Killed(Exception):
    pass


def test_a_job_killed_at_any_step_leaves_the_old_version(spark, versions, monkeypatch):
    """Every call that writes, renames or lists may be the last one."""
    def work():
        change = versions.change()
        change.replace_partitions("t", frame(spark, [(9, "z", 2016, 2)]), PARTS)
        change.replace("flat", frame(spark, []))
        change.commit()

    steps = [(V, "write_table"), (V.Change, "_folders"), (V.Versions, "_publish"), (V.Versions, "_file")]
    died = 0
    for owner, name in steps:
        for nth in range(2):
            calls, real = [0], getattr(owner, name)

            def dying(*args, _real=real, _nth=nth, _calls=calls, **kw):
                if _calls[0] == _nth:
                    raise Killed
                _calls[0] += 1
                return _real(*args, **kw)

            with monkeypatch.context() as m:
                m.setattr(owner, name, dying)
                try:
                    work()
                    break
                except Killed:
                    died += 1
            assert versions.numbers() == [1]
            assert rows_of(versions.latest()) == sorted(BASE, key=str)
            assert rows_of(versions.latest(), "flat") == BASE[:2]
        if versions.numbers() != [1]:
            versions._fs.delete(versions._path(versions._file(2)), False)
    assert died >= 6
    work()
    assert versions.numbers() == [1, 2]


def test_a_crash_between_the_renames_loses_no_history(spark, scratch):
    """``publish`` sets the old table aside; what stands aside comes back before anything is deleted."""
    root = scratch("publish").removeprefix("file:")
    target = f"{root}/t.parquet"
    spark.range(3).write.parquet(target)
    os.rename(target, f"{target}.replaced")  # the job died here
    assert PQ.recover(spark, target) and spark.read.parquet(target).count() == 3
    assert not PQ.recover(spark, target)
    os.rename(target, f"{target}.replaced")
    spark.range(5).write.parquet(f"{root}/new")
    PQ.publish(spark, f"{root}/new", target)
    assert spark.read.parquet(target).count() == 5 and not os.path.exists(f"{target}.replaced")


def test_builds_as_versions(spark, star_inputs, scratch, monkeypatch):
    base = scratch("star")
    first = PL.build_version(spark, star_inputs, base)
    before = {n: df.count() for n, df in PL.read_version(first).items()}
    assert len(before) == 8 and all(before.values())
    monkeypatch.setattr(PL, "require_ok", lambda _: (_ for _ in ()).throw(Killed()))
    with pytest.raises(Killed):  # a failed check publishes nothing
        PL.build_version(spark, star_inputs, base, dynamic=True)
    assert V.Versions(spark, base).numbers() == [1]
    monkeypatch.undo()
    second = PL.build_version(spark, star_inputs, base, dynamic=True)
    assert {n: df.count() for n, df in PL.read_version(second).items()} == before


@pytest.fixture
def star_inputs(spark, tmp_path):
    from starmart import tables as TB
    from tests.test_labels import LABEL_FILE
    from tests.test_pipeline import DEMO, TEMPS

    (tmp_path / "temps.csv").write_text(TEMPS)
    (tmp_path / "demo.csv").write_text(DEMO)
    (tmp_path / "labels.SAS").write_bytes(LABEL_FILE.encode())
    rows = [(float(i), 2016.0, 4.0, 236.0, 101.0, "ALC", 20545.0 + (i % 3), 1.0, 25.0, 2.0, "F", "AA", "B2")
            for i in range(10)]
    spark.createDataFrame(rows, TB.ARRIVALS).write.parquet(str(tmp_path / "arrivals"))
    return PL.Inputs(str(tmp_path / "arrivals"), str(tmp_path / "temps.csv"), str(tmp_path / "demo.csv"),
                     str(tmp_path / "labels.SAS"))
