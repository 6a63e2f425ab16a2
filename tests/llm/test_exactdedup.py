"""Exact de-duplication: the stateful stream against a dictionary, collisions and odd rows."""

import hashlib

import pytest

from starmart.llm import exactdedup
from starmart.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, digest string, n int"


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows_of():
    texts = ["Same Text", "same text", "SAME TEXT", "other", None, "", "É", "é", "x" * 5000, "İ", "i̇", " same text"]
    rows = [(i, texts[i % len(texts)], "en", None, i) for i in range(40)]
    return rows + [(None, "same text", None, "d", 1), (7, "another text of seven", "de", "d", 2),
                   (100, "twice the same row", None, None, 0), (100, "twice the same row", None, None, 0)]


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(folded(text), []).append(doc_id)
    return {k: (max((i for i in ids if i is not None), default=None), len(ids)) for k, ids in groups.items()}


@pytest.mark.parametrize("digest_bytes", [32, 0, 1])
def test_matches_a_dictionary_even_when_digests_collide(spark, digest_bytes):
    rows = rows_of()
    want = brute(rows)
    got = exactdedup.exact_groups(spark.createDataFrame(rows, SCHEMA), digest_bytes=digest_bytes).collect()
    assert len(got) == len(rows)
    by_sha = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in want.items()}
    kept = {}
    for r in got:
        assert (r.keep_id, r.group_size) == by_sha[r.text_sha256]
        kept.setdefault(r.text_sha256, []).extend([r.doc_id] if r.kept else [])
    assert kept == {k: [v[0]] for k, v in by_sha.items()}  # exactly one row of each text


def test_many_micro_batches_give_the_same(spark):
    rows = [(i, f"text {i % 7}", "en", None, i) for i in range(60)]
    docs = stored(spark.createDataFrame(rows, SCHEMA).repartition(6), "many")
    got = exactdedup.exact_groups(docs, max_bytes_per_trigger=1).collect()
    want = brute(rows)
    assert {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == {
        (i, *want[t], want[t][0] == i) for i, t, *_ in rows}


def test_the_stage_keeps_all_columns_and_one_row_of_each_text(spark):
    rows = rows_of()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "text as norm", "doc_id as id", "lang as locator",
                                                           "lang as row", "n as sha")
    out = exactdedup.drop_exact_copies(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = {folded(r.text): r.doc_id for r in out.collect()}
    assert got == {k: v[0] for k, v in brute(rows).items()}
    assert out.count() == len(got)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert exactdedup.exact_groups(docs).count() == 0
    assert exactdedup.drop_exact_copies(docs).columns == docs.columns


def test_no_python_on_the_main_path(spark):
    docs = stored(spark.createDataFrame(rows_of(), SCHEMA), "native")
    for df in (exactdedup.exact_groups(docs), exactdedup.drop_exact_copies(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
