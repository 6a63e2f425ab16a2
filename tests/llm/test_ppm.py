"""Language-model scores against a dictionary implementation of the same model."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from starmart.llm import ppm

SCHEMA = "doc_id long, text string, note string"


def folded(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", folded(text)) if w]


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 1


def stream(text, order):
    return [ppm.PAD] * order + list(" ".join(words_of(text)).encode()) + [ppm.END]


def brute(rows, order):
    trie = defaultdict(Counter)
    c, n_docs = Counter(), 0
    for doc_id, text, *_ in rows:
        if held(doc_id):
            continue
        s = stream(text, order)
        for i in range(order, len(s)):
            for k in range(order + 1):
                trie[tuple(s[i - k:i])][s[i]] += 1
        c.update(words_of(text))
        n_docs += 1
    total, types = sum(c.values()) + n_docs, len(c) + (n_docs > 0)
    out = []
    for doc_id, text, *_ in rows:
        s, lp = stream(text, order), 0.0
        for i in range(order, len(s)):
            gone = set()
            for k in range(order, -1, -1):
                seen = trie.get(tuple(s[i - k:i]))
                left = {x: v for x, v in (seen or {}).items() if x not in gone}
                if left:
                    mass = 2 * sum(left.values())
                    if s[i] in left:
                        lp += math.log10((2 * left[s[i]] - 1) / mass)
                        break
                    lp += math.log10(len(left) / mass)
                gone |= set(left)
            else:
                lp -= math.log10(ppm.ALPHABET - len(gone))
        ws = words_of(text)
        base = sum(math.log10((k + 0.5) / (total + 0.5 * (types + 1))) for k in [*(c[w] for w in ws), n_docs])
        out.append((doc_id, held(doc_id), len(ws) + 1, sum(c[w] > 0 for w in ws) + (n_docs > 0), total, base, lp))
    return out


def compare(spark, rows, order, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in ppm.scores(df, order=order, **options).collect()]
    want = brute(rows, order)
    key = lambda r: (str(r[0]), r[6], r[5])
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


TEXTS = ["The cat sat on the mat", "the CAT ate  the rat", "a rat\tran\non", "", None, "é è 日本 ñ", "zzz zzz",
         "x" * 300, "the the the the", "\x00 \x1c odd", "Ab ba AB", "the cat sat on the mat"]


@pytest.mark.parametrize("order", [1, 3, 5])
def test_matches_a_dictionary_trie(spark, order):
    rows = [(i, TEXTS[i % len(TEXTS)] and TEXTS[i % len(TEXTS)] + (f" w{i}" if i % 3 else ""), "n")
            for i in range(40)]
    rows += [(None, "no id", None), (3, "the same id", None), (3, "the same id", None)]
    compare(spark, rows, order, chunk_bytes=200)


def test_chunks_do_not_change_scores(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], None) for i in range(25)]
    compare(spark, rows, 4, chunk_bytes=1)
    compare(spark, rows, 4, chunk_bytes=1 << 30)


def test_chunks_are_cut_by_bytes_where_long_texts_lie_together(spark, monkeypatch):
    from pyspark.sql import functions as F

    limit = 2000
    rows = ([(i, f"a b w{i}", None) for i in range(150)] + [(200 + i, f"long {i} " * 100, None) for i in range(40)]
            + [(300 + i, f"alone {i} " * 600, None) for i in range(3)] + [(400 + i, None, None) for i in range(90)])
    monkeypatch.setattr(ppm, "SUM_ROWS", 16, raising=False)
    monkeypatch.setattr(ppm, "LOOKUP_ROWS", 64, raising=False)
    seen, real = [], ppm.requests
    monkeypatch.setattr(ppm, "requests", lambda rows, *a: seen.append(rows) or real(rows, *a))
    df = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    got = ppm.scores(df, order=2, chunk_bytes=limit).collect()
    assert len(got) == len(rows)
    chunks = seen[0].groupBy("chunk").agg(F.sum(F.octet_length(F.coalesce("text", F.lit("")))).alias("bytes"),
                                          F.count("*").alias("n")).collect()
    assert sum(c.n for c in chunks) == len(rows)
    assert all(c.bytes < 2 * limit or c.n == 1 for c in chunks)
    assert sum(c.bytes > 2 * limit for c in chunks) == 3 and len(chunks) > 15
    assert all(c.n <= 2 * limit / 64 for c in chunks)  # rows without text fill a chunk, too


def test_long_texts_are_scored_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ppm, "BLOCK", 7)
    text = "some words that go on and on " * 3
    joined = [x for p in ppm.nodes(text.encode(), 2) for x in p.tolist()]
    monkeypatch.setattr(ppm, "BLOCK", 1 << 20)
    assert joined == [x for p in ppm.nodes(text.encode(), 2) for x in p.tolist()]


def test_without_training_rows_symbols_are_uniform(spark):
    ids = [i for i in range(200) if held(i)][:3]
    compare(spark, [(i, "ab c", None) for i in ids], 3)


def test_empty_table(spark):
    out = ppm.scores(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_clashing_column_names(spark):
    rows = [(1, "a b", 5), (2, "b c", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk long").selectExpr(
        "*", "doc_id as node", "text as locator", "chunk as held_out", "chunk as id", "chunk as row")
    assert ppm.scores(df, order=2).count() == 2


def test_table_finds_every_key():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 1000, 70_000):
        keys = np.unique(rng.integers(0, 1 << 54, n))
        values = rng.normal(size=len(keys))
        table = ppm.Table(keys, values)
        asked = rng.integers(0, len(keys), 5000)
        assert (table[keys[asked]] == values[asked]).all()
    assert len(ppm.Table(np.zeros(0, np.int64), np.zeros(0))[np.zeros(0, np.int64)]) == 0
