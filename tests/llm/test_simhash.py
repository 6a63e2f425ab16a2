"""SimHash: fingerprints, bit-sliced distances, tiles and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from tests.llm.test_ppm import words_of

from starmart.llm import simhash

SCHEMA = "doc_id long, text string, fp string, root int"


def brute_fingerprint(text, width=3):
    words = words_of(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, ids, radius):
    distinct = sorted(set(fps))
    parent = {x: x for x in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    least = {}
    for x, i in zip(fps, ids):
        least.setdefault(find(x), []).append(i)
    return [min((i for i in least[find(x)] if i is not None), default=None) for x in fps]


def near_numbers(rng, groups=40, most=12):
    out = []
    for _ in range(groups):
        own = [rng.getrandbits(64)]
        for _ in range(rng.randint(0, most)):  # chains, so that components are wider than the radius
            x = rng.choice(own)
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            own.append(x)
        out += own
    return out


def test_fingerprints():
    rng = random.Random(3)
    texts = ["", " \n", "one", "Two words", "a b c", "a a a a a a"] + [
        " ".join(rng.choice(["Ab", "É", "c\n", "", "d\te", "\x85x", "日本"]) for _ in range(rng.randint(0, 30)))
        for _ in range(150)]
    for t in texts:
        assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_long_texts_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 91} Q" for i in range(3000))
    blocks = simhash.word_blocks
    monkeypatch.setattr(simhash, "word_blocks", lambda data: blocks(data, 50))
    assert simhash.fingerprint(text) == brute_fingerprint(text)


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 6])
def test_bit_sliced_distances(radius):
    fps = np.array(near_numbers(random.Random(radius)), np.uint64)
    bits = np.unpackbits(simhash.near_bits(fps, radius).view(np.uint8), axis=1, bitorder="little")
    want = [[(int(a) ^ int(b)).bit_count() <= radius for b in fps] for a in fps]
    assert (bits[:, :len(fps)].astype(bool) == np.array(want)).all()
    assert not bits[:, len(fps):].any()


@pytest.mark.parametrize("tile", [2048, 3])
def test_links_keep_every_component_also_in_split_buckets(spark, tile):
    numbers = near_numbers(random.Random(9)) + [0xABCDEF << 40 | i for i in range(60)]
    ids = list(range(len(numbers)))
    signed = [x - (1 << 64) if x >> 63 else x for x in numbers]
    fps = spark.createDataFrame(list(zip(ids, signed)), "id long, fp long")
    found = {r.fp: r.component_id for r in simhash.component_of(fps, "id", 2, 4, tile).collect()}
    assert [found[x] for x in signed] == brute_components(numbers, ids, 2)


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i + 1, i) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 50)] + [(5, 5), (7, 3)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{1000 + i: 1000 for i in range(1, 50)}}


def rows_of():
    rng = random.Random(5)
    base = [" ".join(f"w{rng.randrange(500)}" for _ in range(400)) for _ in range(6)]
    rows = []
    for i in range(60):
        words = base[i % 6].split()
        if i % 4 == 1:
            words[rng.randrange(len(words))] = "changed"
        if i % 10 == 7:
            words = [f"new{i}", *words[::-1]]
        rows.append((i + 10, " ".join(words), None, i))
    return rows + [(3, None, None, 0), (2, "", "x", 0), (1, "  \n", None, 0), (None, "", None, 0),
                   (12, "the same id", None, 0), (500, "short", None, 0), (500, "short", None, 0)]


def test_groups_and_stage(spark):
    rows = rows_of()
    df = spark.createDataFrame(rows, SCHEMA)
    fps = [brute_fingerprint(t) for _, t, *_ in rows]
    comp = brute_components(fps, [r[0] for r in rows], 2)
    got = simhash.near_groups(df).collect()
    want = [(r[0], f"{f:016x}", c) for r, f, c in zip(rows, fps, comp)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    out = simhash.drop_near_copies(df)
    assert out.columns == df.columns
    group = brute_components(fps, list(range(len(rows))), 2)  # ids may repeat, row numbers do not
    assert sorted(r.doc_id for r in out.collect()) == sorted(dict(zip(group, comp)).values())


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert simhash.near_groups(df).count() == 0
    assert simhash.drop_near_copies(df).count() == 0
