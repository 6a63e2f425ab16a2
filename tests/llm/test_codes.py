"""Vector codes: slices and masks against all distances, the whole job against a plain version."""

import hashlib
import math

import numpy as np
import pytest

from starmart.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code int, q string"


@pytest.mark.parametrize("n, dims, spread", [(1, 3, 5), (2, 1, 2), (63, 4, 6), (64, 2, 3), (65, 16, 500), (256, 16, 400),
                                             (200, 3, 2), (256, 2, 10 ** 8)])
def test_nearest_entry_is_that_of_all_distances(n, dims, spread):
    rng = np.random.default_rng(n * dims)
    entries = rng.integers(-spread, spread + 1, (n, dims))
    points = np.concatenate((rng.integers(-2 * spread, 2 * spread + 1, (500, dims)), entries,
                             rng.integers(-spread * 1000, spread * 1000, (20, dims))))
    points = points.clip(-codes.clamp_limit(dims), codes.clamp_limit(dims))
    s = codes.Slices(entries)
    index, dist = s.nearest(points)
    table = ((points[:, None, :] - entries[None]) ** 2).sum(2)
    assert (index == table.argmin(1)).all() and (dist == table.min(1)).all()
    mask = s.box(points, np.full(len(points), spread))
    inside = (np.abs(points[:, None, :] - entries[None]) <= spread).all(2)
    bits = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little")[:, :n]
    assert (bits == inside).all()


def brute(rows, parts=4, rounds=4, dims=None):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v) and len(v) == dims]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = dims // parts
    books = [[r[1][p * w:p * w + w] for r in kept[:256]] for p in range(parts)]

    def near(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(e, x)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = {}
            for _, v, _ in kept:
                x = v[p * w:p * w + w]
                own.setdefault(near(books[p], x)[1], []).append(x)
            books[p] = [[sum(c) // len(own[k]) for c in zip(*own[k])] if k in own else e
                        for k, e in enumerate(books[p])]
    out, by_label = [], {}
    for i, v, label in kept:
        found = [near(books[p], v[p * w:p * w + w]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label]) for i, c, e, label in out), key=str), sha


def fixture(n, dims, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, dims)], int(rng.integers(4)))
            for i in rng.permutation(n)]
    return [(i, v, None if label == 3 else label) for i, v, label in rows]


@pytest.mark.parametrize("n", [3, 256, 700])
def test_whole_job_against_a_plain_version(spark, n):
    rows = fixture(n, 8)
    odd = [(1000, None, 1), (1001, [math.nan] + [0.0] * 7, 1), (1002, [math.inf] * 8, 2), (1003, [None] * 8, 2),
           (1004, [0.5] * 7, 0), (1005, [], 0), (None, rows[0][1], None), (None, None, None), rows[0], rows[0]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + odd], SCHEMA).repartition(5)
    out, books = codes.compress(df)
    assert out.columns == ["vec_id", "code", "error", "label_error"]
    want, sha = brute(rows + odd, dims=8)
    assert sorted(map(tuple, out.collect()), key=str) == want
    assert codes.books_sha256(books) == sha


def test_equal_rows_and_huge_numbers_and_no_rows(spark):
    same = [(i, [1e30, -1e30, 0.25, 3.0], None, 0, "") for i in range(600)]
    out, books = codes.compress(spark.createDataFrame(same, SCHEMA))
    rows = out.collect()
    assert {tuple(r)[1:] for r in rows} == {("00000000", 0, 0)} and len(rows) == 600
    far = [(0, [1e30] * 4, 0, 0, ""), (1, [-1e30] * 4, 0, 0, "")]
    assert codes.compress(spark.createDataFrame(far, SCHEMA))[0].count() == 2
    out, books = codes.compress(spark.createDataFrame([], SCHEMA))
    assert out.count() == 0 and codes.books_sha256(books) == hashlib.sha256(b"").hexdigest()
    with pytest.raises(ValueError):
        codes.compress(spark.createDataFrame(same, SCHEMA), dims=6)
