"""The name join against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from starmart.operators.match import best_matches


def brute(left, right, percent):
    def words(name):
        return frozenset(re.findall(r"[^\W_]+", (name or "").upper()))

    cities = [(i, words(n)) for i, n in right]
    out = []
    for i, n in left:
        a, links = words(n), []
        for j, b in cities:
            both = len(a & b)
            if a and b and both * 100 >= percent * len(a | b):
                links.append((-both / len(a | b), j))
        best = min(links, default=(None, None))
        out.append((i, best[1], None if best[0] is None else -best[0], len(links)))
    return sorted(out)


def names(rnd, n):
    words = [f"w{i}" for i in range(40)] + ["ümlaut", "São"]
    out = []
    for i in range(n):
        w = rnd.sample(words, rnd.randint(0, 6))
        if i % 3 == 0:
            w.append("Saint")  # a word of a third of all names
        if i % 7 == 0:
            w = ["saint", "w1"]  # many equal sets
        rnd.shuffle(w)
        out.append((i, None if i % 50 == 49 else rnd.choice([", ", " ", " - ", "/"]).join(w).title()))
    return out


@pytest.mark.parametrize("percent", [1, 34, 50, 60, 67, 100])
def test_every_link_is_found(spark, percent):
    rnd = random.Random(percent)
    left, right = names(rnd, 260), names(rnd, 180)
    got = best_matches(spark.createDataFrame(left, "a long, name string"), "a", "name",
                       spark.createDataFrame(right, "b long, name string"), "b", "name", percent)
    assert sorted((r.a, r.match, r.similarity, r.n_links) for r in got.collect()) == brute(left, right, percent)


def test_repeated_rows_empty_tables_and_other_columns(spark):
    left = spark.createDataFrame([(1, "New York", 5), (1, "New York", 5), (None, "york NEW new", 6), (2, "", 7), (3, "?!", 8)],
                                 "id int, label string, n int")
    right = spark.createDataFrame([("c", "YORK, New"), ("b", "new-york"), ("b", "new-york"), (None, "x")],
                                  "rid string, word string")
    got = best_matches(left, "id", "label", right, "rid", "word", 100).collect()
    assert sorted(map(tuple, got), key=str) == sorted(
        [(1, "b", 1.0, 3)] * 2 + [(None, "b", 1.0, 3), (2, None, None, 0), (3, None, None, 0)], key=str)
    assert best_matches(left.limit(0), "id", "label", right, "rid", "word").count() == 0
    assert {r.n_links for r in best_matches(left, "id", "label", right.limit(0), "rid", "word").collect()} == {0}
    with pytest.raises(ValueError):
        best_matches(left, "id", "label", right, "rid", "word", 0)


def test_a_word_of_every_name_does_not_pair_them_all(spark):
    n = 3000
    df = spark.range(n).select("id", F.concat(F.lit("Port of town"), F.col("id").cast("string")).alias("name"))
    got = best_matches(df, "id", "name", df.withColumnRenamed("id", "city"), "city", "name", 80)
    plan = got.agg(F.sum("n_links"), F.count_if(F.col("id") == F.col("match")))
    assert tuple(plan.first()) == (n, n)
