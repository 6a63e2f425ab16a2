"""Quality, toxicity and language classifiers: learning rules, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest

from starmart.llm import langid, quality, toxicity

SCHEMA = "doc_id long, text string, lang string, score double, id int"


def remainder(doc_id, mod):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % mod


def prose(rng, n=60):
    return ". ".join(" ".join(f"{rng.choice('bcdfgh')}{rng.choice('aeiou')}{rng.choice('lmnrst')}{rng.randrange(30)}"
                              for _ in range(9)).capitalize() for _ in range(n // 9 + 1)) + "."


# ---------------------------------------------------------------------------------- quality

def test_features_cover_whole_texts_and_empty_ones():
    assert quality.features("") == [0.0] * len(quality.FEATURES) == quality.features(" \n\t")
    a, b = (dict(zip(quality.FEATURES, quality.features(t)))
            for t in ("good words here. " * 10, "good words here. " * 10 + "BUY!! " * 90_000))
    assert b["bang"] > 50 * (a["bang"] + 0.01) and b["adjacent"] > 0.9


def test_windows_and_ends_are_counted_behind_the_head_and_behind_the_first_block():
    def of(text):
        f = dict(zip(quality.FEATURES, quality.features(text)))
        return f["distinct_200"], f["end_stop"]

    head = " ".join(f"w{i}" for i in range(200))
    assert of(head) == (1.0, 0.0)
    assert of(head + " junk." * 800) == pytest.approx(((200 + 4) / 1000, 0.8))
    assert of(head + " junk." * 100) == pytest.approx((201 / 300, 1 / 3))
    clean = " ".join(f"w{i}" for i in range(200_000))  # more than 1 MB
    assert of(clean) == (1.0, 0.0)
    assert of(clean + " junk." * 200_000) == pytest.approx((201_000 / 400_000, 0.5))


def test_the_risk_stays_non_negative_and_negatives_are_found_without_their_labels():
    rng = np.random.default_rng(0)
    good = rng.normal(0, 1, (3000, 4))
    bad = rng.normal([3, 0, -3, 0], 1, (600, 4))
    positive, unlabelled = good[:1500], np.concatenate([good[1500:], bad])
    model = quality.fit_pu(positive, unlabelled)
    assert model.prior == pytest.approx(1500 / 2100, abs=0.1)
    test_good, test_bad = rng.normal(0, 1, (500, 4)), rng.normal([3, 0, -3, 0], 1, (500, 4))
    assert (model.score(test_good) > 0.5).mean() > 0.9
    assert (model.score(test_bad) > 0.5).mean() < 0.1
    # a prior far too high makes the unclipped estimate negative; the scores must not collapse
    over = quality.fit_pu(positive, unlabelled, prior=0.97)
    assert (over.score(test_good) > 0.5).mean() > 0.9


def quality_rows(rng, n=360):
    docs, labels = [], []
    for i in range(n):
        junk = i % 5 == 0
        docs.append((i, " ".join(rng.choice("XYZ") * 4 + "!!" for _ in range(50)) if junk else prose(rng), None, None, i))
        if i % 3:
            labels.append((i, int(not junk)))
    return docs, labels


def test_quality_query_and_stage(spark):
    docs, labels = quality_rows(random.Random(1), 1200)
    docs += [(None, None, None, None, None), (5000, "", "x", None, 1), (3, docs[3][1], None, None, 3)]
    labels += [(1, None), (2, 1), (9999, 1)]
    d, lab = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    out = quality.quality_scores(d, lab).collect()
    assert len(out) == len(docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 1000]
    assert len(held) > 50
    assert np.mean([r.predicted == int(r.doc_id % 5 != 0) for r in held]) > 0.95
    assert [tuple(r) for r in quality.quality_scores(d, lab).collect()] == [tuple(r) for r in out]
    kept = quality.keep_quality(d, lab)
    assert kept.columns == d.columns and kept.count() == sum(r.predicted for r in out)
    # labels of held-out rows change nothing
    turned = spark.createDataFrame([(i, q if q is None or remainder(i, 4) != 2 else 1 - q) for i, q in labels],
                                   "doc_id long, quality int")
    assert [r.score for r in quality.quality_scores(d, turned).collect()] == [r.score for r in out]


def test_quality_without_labels_and_on_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    d = spark.createDataFrame([(1, "some text", None, None, 1)], SCHEMA)
    assert [(r.score, r.predicted) for r in quality.quality_scores(d, none).collect()] == [(0.5, 0)]
    assert quality.quality_scores(d.limit(0), none).count() == 0


# ---------------------------------------------------------------------------------- toxicity

INSULTS = ["idiot", "scumbag", "moronic", "trashy"]


def toxic_rows(rng, n=400, term=None):
    docs, labels = [], []
    for i in range(n):
        words = prose(rng).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(INSULTS) + rng.choice(["", ",", "."])
            if term:
                words[rng.randrange(len(words))] = term
        docs.append((i, " ".join(words), None, None, i))
        labels.append((i, int(bad)))
    return docs, labels


def test_toxicity_query(spark):
    docs, labels = toxic_rows(random.Random(2))
    docs += [(None, None, None, None, None), (1000, "", None, None, 0), (1000, "", None, None, 0)]
    d = spark.createDataFrame(docs, SCHEMA)
    lab = spark.createDataFrame(labels + [(7, None), (8, 1)], "doc_id long, toxic int")
    out = toxicity.toxicity_scores(d, lab).collect()
    assert len(out) == len(docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    assert all(r.held_out == (remainder(r.doc_id, 5) == 0) for r in out)
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 400]
    assert np.mean([r.predicted == int(r.doc_id % 4 == 0) for r in held]) > 0.97
    assert {r.predicted for r in out if r.doc_id in (None, 1000)} == {0}
    assert toxicity.toxicity_scores(d.limit(0), lab).count() == 0
    zeros = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert {r.predicted for r in toxicity.toxicity_scores(d, zeros).collect()} == {0}


def test_swapping_terms_keeps_neutral_mentions_of_a_group_clean():
    # the group is only met in toxic text: without the penalty its name turns toxic
    docs, labels = toxic_rows(random.Random(3), 800, term="muslims")
    label = np.array([y for _, y in labels], float)
    words = toxicity.Words()
    present = [np.array(sorted(words.present(t)), np.int64) for _, t, *_ in docs]
    pairs = [p for _, t, *_ in docs for p in toxicity.counterfactuals(t, 2)]
    weight = np.ones(len(docs))
    plain = toxicity.fit_sparse(present, label, weight, [])
    fair = toxicity.fit_sparse(present, label, weight, pairs)

    def gap(m):
        return abs(m.logit("The muslims met at noon") - m.logit("The neighbours met at noon"))

    assert gap(plain) > 1 and gap(fair) < 0.4 * gap(plain)
    assert fair.logit("The muslims met at noon") < 0
    assert fair.logit("what an idiot and scumbag, moronic") > 0


def test_swaps_differ_in_the_term_only():
    for plus, minus in toxicity.counterfactuals("The women spoke first. Nobody else did so today.", 2):
        terms = {f for t in toxicity.TERMS for f in toxicity.word_features(t)}
        assert plus and minus and set(plus) <= terms and set(minus) <= terms and not set(plus) & set(minus)
    assert toxicity.counterfactuals("", 2) == [] == toxicity.counterfactuals("...", 2)


def test_every_term_of_every_sentence_is_swapped_in_all_forms(spark):
    for term in "gay muslim jewish woman black lesbian".split():
        assert toxicity.MENTION.findall(f"Some {term.title()} folk") == [term.title()]
    own = ["gay", "muslim", "woman", "lesbian"]
    text = "A gay and a Muslim met. Nobody spoke. The woman's friend left. A lesbian saw a lesbian. End."
    whole = {f for w in text.split() for f in toxicity.word_features(w)}
    pairs = toxicity.counterfactuals(text, 2)
    assert len(pairs) == 4 and all(set(plus) <= whole for plus, _ in pairs)
    assert {f for plus, _ in pairs for f in plus} >= {toxicity.word_features(w)[0] for w in own if w != "woman"}
    assert toxicity.word_features("woman's")[0] in {f for plus, _ in pairs for f in plus}
    assert len(toxicity.counterfactuals("The gay man spoke. " * 50, 2)) == 100
    # through the query: a singular term met in toxic text only, late in long documents
    docs, labels = toxic_rows(random.Random(3), 800)
    docs = [(i, f"One girl came. Two boys came. {t} A lesbian left." if y else t, *r)
            for (i, t, *r), (_, y) in zip(docs, labels)]
    d, lab = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int")
    fair, plain = toxicity.fit(d, lab), toxicity.fit(d, lab, swap=0.0)

    def gap(m):
        return abs(m.logit("A lesbian left") - m.logit("A neighbour left"))

    assert gap(plain) > 0.5 and gap(fair) < 0.4 * gap(plain)


# ---------------------------------------------------------------------------------- language

ALPHABETS = {"aa": "abcde", "bb": "vwxyz", "cc": "жзийк"}


def language_rows(rng, n=300):
    out = []
    for i in range(n):
        lang = ("aa", "bb", "cc")[i % 3]
        words = ("".join(rng.choice(ALPHABETS[lang]) for _ in range(rng.randint(2, 7))) for _ in range(30))
        out.append((i, " ".join(words).upper() if i % 7 == 0 and lang != "cc" else " ".join(words),
                    lang if i % 11 else None, None, i))
    return out


def test_language_query(spark):
    docs = language_rows(random.Random(4))
    odd = [(1000, None, "aa", None, 1), (1001, "123 !? \n", "aa", None, 1), (None, "abc dea", None, None, None),
           (1002, "漢字 かな", None, None, 2), (1003, "", "bb", None, 1), (5, docs[5][1], "cc", None, 5)]
    df = spark.createDataFrame(docs + odd, SCHEMA)
    out = langid.languages(df).collect()
    assert len(out) == len(docs) + len(odd)
    by_id = {r.doc_id: r for r in out}
    for r in out:
        assert 0 <= r.score <= 1 and r.held_out == (remainder(r.doc_id, 5) == 0)
        if r.doc_id is not None and r.doc_id < 300:
            assert r.lang_pred == ("aa", "bb", "cc")[r.doc_id % 3]
    for i in (1000, 1001, 1003):
        assert (by_id[i].lang_pred, by_id[i].score, by_id[i].rejected) == ("und", 0.0, True)
    assert by_id[1002].rejected and by_id[1002].lang_pred in ALPHABETS
    assert np.mean([r.rejected for r in out if r.doc_id is not None and r.doc_id < 300]) < 0.15
    assert {r.lang_pred for r in langid.languages(df.where("doc_id = 3").selectExpr(
        "doc_id", "text", "cast(null as string) as lang")).collect()} == {"und"}
    assert langid.languages(df.limit(0)).count() == 0


def test_several_centroids_per_language():
    rng = np.random.default_rng(0)
    a, b = np.eye(50)[3], np.eye(50)[17]
    x = np.concatenate([a + rng.normal(0, 0.02, (40, 50)), b + rng.normal(0, 0.02, (25, 50))])
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    c = langid.spherical_kmeans(x, 2)
    assert sorted(c.argmax(axis=1).tolist()) == [3, 17]
    assert len(langid.spherical_kmeans(x[:1], 3)) == 1


def test_counts_take_whole_texts(monkeypatch):
    text = "Some Words, über 42 lines\n" * 50
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert (langid.counts(text) == whole).all()
    assert whole.sum() > 500


# ---------------------------------------------------------------------------------- bounded samples

def test_a_sample_is_bounded_in_ids_and_bytes(spark):
    from starmart.llm.common import bounded_sample

    rows = ([("p", 7, f"text {i % 50}") for i in range(700)] + [("p", i, "y" * 1000) for i in range(100, 140)]
            + [("u", None, None), ("u", None, "z"), ("u", 1, "w" * 10_000_000), ("u", 2, "ok")])
    df = spark.createDataFrame(rows, "kind string, id long, text string").repartition(6)
    got = bounded_sample(df, "s", 20_000).collect()
    assert len({(r.kind, r.id) for r in got}) == len(got)
    assert sum(len(r.text) + 64 for r in got if r.kind == "p") <= 20_000
    assert sum(r.kind == "p" for r in got) >= 18
    assert {r.id for r in got if r.kind == "u"} <= {None, 2}
    whole = bounded_sample(df, "s", 1 << 30).collect()
    assert len(whole) == 44 and {r.text for r in whole if r.id == 7} == {"text 0"} or \
        all(len(r.text) == 6 for r in whole if r.id == 7)
    assert [r.text for r in whole if r.kind == "u" and r.id is None] == [""]
    assert bounded_sample(df.limit(0), "s", 10).count() == 0


def test_one_id_in_a_third_of_the_rows_teaches_once(spark):
    rng = random.Random(9)
    ids = [i for i in range(1, 400) if remainder(i, 4) != 2 and remainder(i, 5) != 0]
    rows = [(i, prose(rng), "de" if i % 2 else "en", 0.0, 0) for i in ids] + [(ids[0], f"{k} again", "en", 0.0, 0)
                                                                              for k in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).cache()
    labels = spark.createDataFrame([(i, 1, i % 2) for i in ids], "doc_id long, quality int, toxic int")
    slim, marked = docs.selectExpr("doc_id as id", "text"), labels.selectExpr("doc_id as id", "quality as label")
    got = quality.training_rows(slim, marked, 50, 4, 2).collect()
    assert len({(r.kind, r.id) for r in got}) == len(got) <= 250
    got, _ = toxicity.training_rows(slim, labels.selectExpr("doc_id as id", "toxic as label"), 10_000, 5, 0, 1 << 30)
    assert got.count() == len(ids)
    assert langid.languages(docs).count() == len(rows)


def test_very_many_values_of_the_language_column(spark):
    rows = [(i, f"{'abcdefgh'[i % 8] * 3} text of {i}", f"x{i % 3000}", 0.0, 0) for i in range(6000)]
    model = langid.fit(spark.createDataFrame(rows, SCHEMA), per_language=1)
    assert 2000 < len(model.languages) <= 3000


# ---------------------------------------------------------------------------------- held-out accuracy

SF = "/root/testdata/sf0.01"


def _auc(score, truth):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    ones = truth.sum()
    return (rank[truth == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(truth) - ones))


@pytest.mark.parametrize("name, kind, least", [("op2_pu_quality", "quality", 0.97),
                                               ("op6_counterfactual_toxicity", "toxic", 0.95)])
def test_held_out_ranking_on_the_given_tables(spark, name, kind, least):
    from starmart.llm.queries import QUERIES

    truth = {r.doc_id: r[kind] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = [r for r in QUERIES[name](spark, SF).collect() if r.held_out and truth.get(r.doc_id) is not None]
    assert len(rows) > 50
    assert _auc(np.array([r.score for r in rows]), np.array([truth[r.doc_id] for r in rows])) > least


def test_held_out_languages_on_the_given_tables(spark):
    from starmart.llm.queries import QUERIES

    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = [r for r in QUERIES["op8_centroid_language"](spark, SF).collect()
            if r.held_out and lang[r.doc_id] and r.lang_pred != "und"]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows]) > 0.97


# ---------------------------------------------------------------------------------- plain versions

def test_the_risk_gradient_is_that_of_finite_differences(monkeypatch):
    """The gradient that ``fit_pu`` descends by, against the plainly written non-negative risk."""
    rng = np.random.default_rng(6)
    p, u = rng.normal(1, 1, (60, 3)), rng.normal(0, 1, (90, 3))
    seen = {}
    monkeypatch.setattr(quality, "descend", lambda g, size, rounds, rate: seen.update(g=g, size=size) or np.zeros(size))
    model = quality.fit_pu(p, u, prior=0.4, decay=0.0)
    edges = model.edges
    ap, au = quality.one_hot(edges, p), quality.one_hot(edges, u)

    def risk(w):
        zp, zu = (np.array([sum(w[k] for k in row) + w[-1] for row in a]) for a in (ap, au))
        positive = 0.4 * np.log1p(np.exp(-zp)).mean()
        negative = np.log1p(np.exp(zu)).mean() - 0.4 * np.log1p(np.exp(zp)).mean()
        return (positive + negative, negative)

    for scale in (0.1, 1.0):
        w = rng.normal(0, scale, seen["size"])
        total, negative = risk(w)
        g = seen["g"](w)
        for k in range(0, seen["size"], 5):
            step = np.zeros(seen["size"])
            step[k] = 1e-5
            part = 0 if negative >= 0 else 1
            numeric = (risk(w + step)[part] - risk(w - step)[part]) / 2e-5
            assert g[k] == pytest.approx(numeric if part == 0 else -numeric, abs=1e-6)
