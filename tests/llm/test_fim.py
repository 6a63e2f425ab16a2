"""Fill-in-the-middle: the sparse index and the cuts against plain string operations."""

import hashlib
import random
import re

import numpy as np
import pytest

from starmart.llm import fim

SCHEMA = "doc_id long, text string, n string, output int, id string"
TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def brute(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
    toks = TOKEN.findall(text)
    n = len(toks)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(toks[:a]), "".join(toks[a:b]), "".join(toks[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def texts_of():
    rng = random.Random(11)
    pool = ["abc", "Z", "é", "日本", "😀", " ", "\n", "\t", "1", "<", "<S", "P>", "[", "`", "{", "@", "ſ", " ", "\x00"]
    texts = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 50))) for _ in range(300)]
    return texts + ["", None, "a", "é", "😀" * 9, "a<P>b", "<S>", "x<M>", "<", "abc def " * 200_000, "日本 é a " * 150_000]


@pytest.mark.parametrize("text", ["", "plain", "aé", "é", "日x😀", "x" * 50 + "ü" + "y" * 50])
def test_index_converts_both_ways(text):
    data = text.encode()
    index = fim.Exceptions(np.frombuffer(data, np.uint8))
    assert index.n_chars == len(text)
    assert len(index.at) == sum(ord(c) > 127 for c in text)
    for k in range(len(text) + 1):
        at = len(text[:k].encode())
        assert index.to_byte(k) == at and index.to_char(at) == k


def test_tokens_found_across_blocks():
    text = "abc  dé日fgh😀ij1kl" * 7
    starts = [len(text[:m.start()].encode()) for m in TOKEN.finditer(text)]
    raw = np.frombuffer(text.encode(), np.uint8)
    for block in (1, 2, 3, 5, 1 << 20):
        tokens = fim.Tokens(raw, block)
        assert tokens.n == len(starts)
        assert [tokens.to_byte(k) for k in range(len(starts) + 1)] == [*starts, len(raw)]


def test_dataframe_against_a_plain_version(spark):
    texts = texts_of()
    rows = [(i, t, "x", 1, None) for i, t in enumerate(texts)] + [(None, "a b c", None, None, None)] * 2
    out = fim.fill_in_middle(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = out.withColumn("back", fim.restored(out.output, out.form)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = "a b c" if r.doc_id is None else texts[r.doc_id] or ""
        assert tuple(r)[1:6] == brute(r.doc_id, text)
        assert r.back == text
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0


def test_cuts_in_code_points(spark):
    rows = [(i, t or "") for i, t in enumerate(texts_of())]
    out = fim.fill_in_middle(spark.createDataFrame(rows, "k long, body string"), "k", "body", unit="char",
                             fim_percent=100, spm_percent=50)
    for r in out.withColumn("back", fim.restored(out.output, out.form)).collect():
        text = rows[r.k][1]
        assert r.n == len(text) and r.back == text
        if r.form == "psm":
            assert r.output.startswith("<P>" + text[:r.prefix_chars] + "<S>")
            assert r.output.endswith("<M>" + text[r.prefix_chars:r.prefix_chars + r.middle_chars])
    with pytest.raises(ValueError):
        fim.fill_in_middle(spark.createDataFrame(rows, "k long, body string"), "k", "body", unit="word")


def test_bytes_that_are_no_utf8_are_replaced(spark):
    df = spark.sql("select 1L as doc_id, cast(x'61ff62' as string) as text")
    assert fim.fill_in_middle(df).first().n == 3
