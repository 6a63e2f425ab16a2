"""The registered queries: against DuckDB where there is SQL, the pipeline against a plain version."""

import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from scripts.oracle_check import digest
from starmart.llm import mixing, quality, simhash
from starmart.llm.queries import ORACLE, QUERIES, vocabulary
from starmart.sources.driver import TABLES
from tests.llm.test_licences import brute as brute_licences
from tests.llm.test_mixing import size_of, targets
from tests.llm.test_packing import check_pack
from tests.llm.test_ppm import brute as brute_ppm
from tests.llm.test_ppm import folded
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    want, names = cur.fetchall(), [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, rows) == digest(names, want)


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_op5_against_the_tokenizer(spark):
    check_pack(QUERIES["op5_best_fit_packing"](spark, SF).collect(), documents(spark))


def test_op9_against_a_dictionary(spark):
    want = {r[0]: r for r in brute_ppm(documents(spark), 5)}
    got = QUERIES["op9_ppm_scores"](spark, SF).collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[:5] == want[r.doc_id][:5]
        assert tuple(r)[5:] == pytest.approx(want[r.doc_id][5:], rel=1e-9)


def test_op10_against_all_pairs(spark):
    docs = documents(spark)
    fps = [brute_fingerprint(t) for _, t, *_ in docs]
    comp = brute_components(fps, [d[0] for d in docs], 2)
    got = {tuple(r) for r in QUERIES["op10_simhash_dedup"](spark, SF).collect()}
    assert got == {(d[0], f"{f:016x}", c) for d, f, c in zip(docs, fps, comp)}


def test_op12_against_plain_word_matching(spark):
    docs = {d[0]: d[1] for d in documents(spark)}
    got = QUERIES["op12_licence_scan"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r)[1:6] == brute_licences(docs[r.doc_id])
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))


def test_classifier_queries_score_every_document(spark):
    n = len(documents(spark))
    for name in ("op2_pu_quality", "op6_counterfactual_toxicity", "op8_centroid_language"):
        rows = QUERIES[name](spark, SF).collect()
        assert len(rows) == n and all(0 <= r.score <= 1 for r in rows)


def test_pipeline_against_a_plain_version(spark):
    docs = documents(spark)
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality.fit(table, spark.read.parquet(f"{SF}/labels.parquet"))
    good = [d for d in docs if model.score(quality.np.array([quality.features(d[1])]))[0] >= 0.7]
    by_text = {}
    for d in good:
        by_text.setdefault(folded(d[1]), []).append(d)
    once = [max(own, key=lambda d: d[0]) for own in by_text.values()]
    comp = brute_components([simhash.fingerprint(d[1]) for d in once], [d[0] for d in once], 2)
    apart = [d for d, c in zip(once, comp) if d[0] == c]
    sizes = {}
    for d in apart:
        sizes[d[3]] = sizes.get(d[3], 0) + size_of(d[1])
    want = targets(sizes)
    ids = spark.createDataFrame([(d[0],) for d in apart], "doc_id long")
    draws = {r[0]: r[1:] for r in ids.select("doc_id", *[mixing.uniform(f"mix{k}", ids.doc_id).alias(f"u{k}")
                                                         for k in range(16)]).collect()}
    mixed = []
    for source in sizes:
        own = [d for d in apart if d[3] == source]
        rate = min(3.0, want[source] / sizes[source]) if sizes[source] else 0.0
        options = [[d for d in own for _ in range(int(rate) + (draws[d[0]][k] < rate - int(rate)))]
                   for k in range(16)]
        mixed += min(options, key=lambda o: abs(sum(size_of(d[1]) for d in o) - want[source]))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    rows = corpus_pipeline.run(spark, SF).collect()
    assert check_pack(rows, mixed) <= -(-sum(r.length for r in rows) // 4096) + 2


def test_stages_return_the_columns_of_documents_also_for_odd_and_no_rows(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (5, "", "en", None, 0), (5, "", "en", None, 0),
                                 (6, "x " * 40_000, None, "src1", 1)], table.schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, corpus_pipeline.stored(docs, "odd"), SF)
            assert out.columns == table.columns, name
            assert out.count() <= 3 * docs.count()
        assert corpus_pipeline.packed(spark, docs, SF).count() >= docs.count()


def test_the_entry_imports_without_the_subpackage(tmp_path):
    root = os.path.dirname(os.path.abspath(E.__file__))
    for name in os.listdir(root):
        if name not in ("corpus_pipeline.py", "starmart", ".git"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "starmart")
    for name in os.listdir(f"{root}/starmart"):
        if name != "llm":
            os.symlink(f"{root}/starmart/{name}", tmp_path / "starmart" / name)
    code = ("import os, sys; sys.path.insert(0, os.getcwd()); src = open('__spark_entry__.py').read(); "
            "g = {'__name__': 'entry', '__file__': os.path.join(os.getcwd(), '__spark_entry__.py')}; "
            "exec(compile(src, 'entry', 'exec'), g); print(sorted(g['queries']())[:1], "
            "any(n.startswith('op') and n[2].isdigit() for n in g['queries']()))")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert "False" in out.stdout, out.stderr[-500:]
    assert vocabulary()
