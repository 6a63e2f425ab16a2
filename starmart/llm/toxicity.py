"""Counterfactually regularised toxicity classifier.

A sparse logistic regression over the words of a text and their first four and five letters, each
present or not.  Beside the labelled documents it sees pairs of sentences from them that differ in
one identity term only: every term of every sentence is swapped, wherever it stands there, for another
one or for a neutral word; a document with fewer than ``pairs_per_doc`` of these also gives sentences
that get two terms in the same place.  A document's pairs weigh as much as any other's.  Swapping must not move the
score: the squared difference of the two logits is penalised, so a group's name does not turn toxic
because it is often met in toxic text, and neutral mentions keep a low score.

Fitted on at most ``max_rows`` labelled documents, half of each class if there are enough, picked by
a hash of the id; class weights restore the labelled share.  Weights are shrunk by a lasso penalty,
so a long text does not gather many small ones.  Every document is scored, whole.

Defined results: a null text counts as empty and gets the score of a text without known words;
null labels are left out, repeated labels of one id count once, the largest.  Without labels of both
kinds to learn from, every score is the labelled share (0 without labels).  Rows that repeat an id are
scored each and teach once; texts of any length are scored whole, those of the sample as far as
``max_bytes`` per label goes; equal texts score alike; an empty table gives an empty result; columns
other than those named are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (bounded_sample, map_batches, quoted, split_remainder, texts_of, uniform_hash,
                     word_blocks)

#: identity terms (plural, singular and adjective forms) and neutral words, by language: fixed values
IDENTITY = sorted(set((
    "women woman female females men man male males girls girl boys boy muslims muslim islamic "
    "christians christian jews jew jewish hindus hindu buddhists buddhist atheists atheist "
    "blacks black whites white asians asian africans african europeans european americans american "
    "arabs arab arabic latinos latino latinas latina mexicans mexican immigrants immigrant migrants "
    "migrant refugees refugee foreigners foreigner foreign gays gay lesbians lesbian homosexuals "
    "homosexual queers queer transgender transgenders trans transsexual transsexuals heterosexuals "
    "heterosexual bisexuals bisexual disabled deaf blind elderly teenagers teenager teenage "
    "frauen frau männer mann weiblich männlich muslime muslim muslimin muslimisch muslimische "
    "muslimischen christen christ christlich christliche christlichen juden jude jüdin jüdisch "
    "jüdische jüdischen ausländer ausländerin ausländisch ausländische ausländischen flüchtlinge "
    "flüchtling schwule schwuler schwulen schwul lesben lesbe lesbisch lesbische lesbischen "
    "behinderte behinderter behinderten behindert "
    "femmes femme hommes homme féminin féminine masculin masculine musulmans musulman musulmane "
    "musulmanes chrétiens chrétien chrétienne chrétiennes juifs juif juive juives étrangers étranger "
    "étrangère étrangères réfugiés réfugié réfugiée réfugiées homosexuels homosexuel homosexuelle "
    "homosexuelles lesbiennes lesbienne handicapés handicapé handicapée handicapées "
    "mujeres mujer hombres hombre femenino femenina masculino masculina musulmanes musulmán musulmana "
    "musulmanas cristianos cristiano cristiana cristianas judíos judío judía judías extranjeros "
    "extranjero extranjera extranjeras refugiados refugiado refugiada refugiadas gays gay lesbianas "
    "lesbiana discapacitados discapacitado discapacitada discapacitadas").split()))
NEUTRAL = ("people persons person neighbours neighbour leute menschen mensch gens personnes personne "
           "gente personas persona vecinos vecino").split()
TERMS = sorted(set(IDENTITY + NEUTRAL))
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
MENTION = re.compile(r"\b(?:" + "|".join(IDENTITY) + r")\b", re.IGNORECASE)
SENTENCE = re.compile(r"[.!?\n]+")
CACHE_WORDS = 500_000


def word_features(word: str) -> tuple[int, ...]:
    """Signed 64-bit feature numbers of one word; none if it has no letter or digit."""
    word = EDGES.sub("", word.lower())
    if not word:
        return ()
    keys = ["w:" + word] + [f"{n}:{word[:n]}" for n in (4, 5) if len(word) >= n]
    return tuple(xxhash.xxh64_intdigest(k.encode("utf-8", "replace")) - (1 << 63) for k in keys)


class Words:
    """Feature numbers by word, optionally only known ones; emptied when full."""

    def __init__(self, known: dict[int, float] | None = None):
        self.known, self.cache = known, {}

    def of(self, word: bytes) -> tuple[int, ...]:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= CACHE_WORDS:
                self.cache.clear()
            found = word_features(word.decode("utf-8", "replace"))
            if self.known is not None:
                found = tuple(f for f in found if f in self.known)
            self.cache[word] = found
        return found

    def present(self, text: str) -> set[int]:
        out: set[int] = set()
        for words in word_blocks(text.encode("utf-8", "replace")):
            for w in set(words):
                if found := self.of(w):
                    out.update(found)
        return out


def swaps(text: str, count: int) -> Iterator[tuple[tuple[int, ...], tuple[int, ...]]]:
    """A pair for every identity term of every sentence, filled up to ``count`` with insertions of two
    terms: the features only in the one, only in the other sentence."""
    sentences = [s for s in SENTENCE.split(text) if s.strip()]
    if not sentences:
        return
    pick = xxhash.xxh64_intdigest(text.encode("utf-8", "replace"))

    def partner(own: str, k: int) -> str:
        others = NEUTRAL if k % 2 else TERMS  # neutral words take part in every other swap
        at = ((pick >> 24) + 7 * k) % len(others)
        return others[at] if others[at] != own else others[(at + 1) % len(others)]

    k = 0
    if MENTION.search(text):
        for sentence in sentences:
            for own in sorted({m.lower() for m in MENTION.findall(sentence)}):  # all its places at once
                here = re.compile(rf"\b{re.escape(own)}\b", re.IGNORECASE)
                words, other = set(sentence.split()), partner(own, k)
                k += 1
                hit = {w for w in words if here.search(w)}
                shared = {f for w in words - hit for f in word_features(w)}
                a = {f for w in hit for f in word_features(w)} - shared
                b = {f for w in hit for f in word_features(here.sub(other, w))} - shared
                if a != b:
                    yield tuple(sorted(a - b)), tuple(sorted(b - a))
    for k in range(k, min(count, len(sentences))):  # two terms in the same place
        own = TERMS[(pick >> 16) % len(TERMS)]
        rest = sentences[(pick + k) % len(sentences)].split()
        del rest[(pick >> 8) % len(rest)]
        shared = {f for w in rest for f in word_features(w)}
        a, b = set(word_features(own)) - shared, set(word_features(partner(own, k))) - shared
        if a != b:
            yield tuple(sorted(a - b)), tuple(sorted(b - a))


def counterfactuals(text: str, count: int) -> list[tuple[list[int], list[int]]]:
    """All pairs of the text (see ``swaps``)."""
    return [(list(a), list(b)) for a, b in swaps(text, count)]


# -------------------------------------------------------------------------------------- learning

@dataclass(frozen=True)
class Model:
    weights: dict[int, float]
    bias: float

    @cached_property
    def words(self) -> Words:
        return Words(self.weights)

    def logit(self, text: str) -> float:
        return self.bias + sum(map(self.weights.__getitem__, self.words.present(text)))


def _rows(names: np.ndarray, rows: list) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every known feature of the rows; ``names`` are sorted and not empty."""
    flat = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.minimum(np.searchsorted(names, flat), len(names) - 1)
    known = names[col] == flat
    return row[known], col[known]


def fit_sparse(docs: list, labels: np.ndarray, weight: np.ndarray, pairs: list, lasso: float = 3e-4,
               swap: float = 5.0, rounds: int = 300, least: int = 3,
               pair_weight: np.ndarray | None = None) -> Model:
    """Accelerated proximal gradient for the weighted logistic loss + swap penalty + lasso.

    The penalty is the mean over the pairs, weighted by ``pair_weight`` (default: alike).  Features in fewer than ``least`` of the documents are left out.
    """
    names, counts = np.unique(np.concatenate(docs), return_counts=True)
    names = names[counts >= least]
    if not len(names):
        names = np.zeros(1, np.int64)
    n, m = len(docs), len(names)
    row, col = _rows(names, docs)
    (pr, pc), (mr, mc) = (_rows(names, [p[k] for p in pairs]) for k in (0, 1))
    sw_row, sw_col = np.r_[pr, mr], np.r_[pc, mc]
    sign = np.r_[np.ones(len(pr)), -np.ones(len(mr))]
    weight = weight / weight.sum()
    pull = np.ones(len(pairs)) if pair_weight is None else np.asarray(pair_weight, float)
    pull = 2 * swap * pull / max(pull.sum(), 1e-300)

    def step_of(w: np.ndarray, b: float) -> tuple[np.ndarray, float]:
        z = np.bincount(row, w[col], n) + b
        slope = weight * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - labels)
        g = np.bincount(col, slope[row], m)
        if len(pairs):
            d = np.bincount(sw_row, sign * w[sw_col], len(pairs))
            g = g + np.bincount(sw_col, sign * (pull * d)[sw_row], m)
        return g, slope.sum()

    # step lengths per feature from an upper bound of the curvature of its own row and column sums
    size = np.bincount(row, minlength=n) + 1.0
    curve = 0.25 * np.bincount(col, (weight * size)[row], m) + 1e-9
    if len(pairs):
        width = np.bincount(sw_row, minlength=len(pairs))
        curve += np.bincount(sw_col, (pull * width)[sw_row], m)
    curve_b = 0.25 * (weight * size).sum()
    w, b = np.zeros(m), 0.0
    vw, vb, t = w, b, 1.0
    for _ in range(rounds):
        g, gb = step_of(vw, vb)
        new = vw - g / curve
        new = np.sign(new) * np.maximum(np.abs(new) - lasso / curve, 0)
        new_b, t2 = vb - gb / curve_b, (1 + np.sqrt(1 + 4 * t * t)) / 2
        vw, vb = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    return Model({int(names[k]): float(w[k]) for k in np.flatnonzero(w)}, float(b))


# ----------------------------------------------------------------------------------------- Spark

def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, mod: int, held: int,
                  max_bytes: int) -> tuple:
    """(label, text) of the chosen labelled documents - one row per id, at most ``max_bytes`` of text per
    label - and the labelled share of 1."""
    known = (labels.where("label is not null").groupBy("id").agg(F.max("label").alias("label"))
             .where(split_remainder(F.col("id"), mod) != held))
    ones, zeros = (known.agg(F.count_if(F.col("label") == k)).first()[0] for k in (1, 0))
    limit = F.when(F.col("label") == 1, max_rows / 2 / max(ones, 1)).otherwise(max_rows / 2 / max(zeros, 1))
    chosen = known.where(uniform_hash("toxic", F.col("id")) < limit)
    rows = docs.join(F.broadcast(chosen), "id").select(F.col("label").alias("kind"), "id", "text")
    rows = bounded_sample(rows, "toxic-bytes", max_bytes).select(F.col("kind").alias("label"), "text")
    return rows, ones / max(ones + zeros, 1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", max_rows: int = 6000, mod: int = 5, held: int = 0,
        swap: float = 5.0, pairs_per_doc: int = 2, max_bytes: int = 16 << 20) -> Model:
    rows, share = training_rows(
        docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text")),
        labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).cast("int").alias("label")),
        max_rows, mod, held, max_bytes)

    def run(batch: pa.RecordBatch) -> dict:
        words, texts = Words(), texts_of(batch)
        pairs = [Counter(swaps(t, pairs_per_doc)) for t in texts]  # equal ones once, with their share
        return {"label": batch.column("label"), "key": [xxhash.xxh64_intdigest(t.encode("utf-8", "replace"))
                                                       - (1 << 63) for t in texts],
                "present": [sorted(words.present(t)) for t in texts],
                "swaps": [list(c) for c in pairs],
                "shares": [[v / c.total() for v in c.values()] for c in pairs]}

    got = map_batches(rows, run, "label int, key long, present array<long>, swaps array<array<array<long>>>, "
                                 "shares array<double>").toArrow()  # bounded by max_bytes
    got = got.sort_by([("key", "ascending"), ("label", "ascending")])  # the same order in every run
    label = np.array(got["label"].to_pylist(), float)
    if not len(label) or label.min() == label.max():
        return Model({}, float(np.log(share / (1 - share))) if 0 < share < 1 else 40.0 * np.sign(share - 0.5))
    weight = np.where(label == 1, share / (label == 1).sum(), (1 - share) / (label == 0).sum())
    docs_ = [x.values.to_numpy() for x in got["present"]]
    pairs = [p for s in got["swaps"].to_pylist() for p in s]
    shares = np.array([x for s in got["shares"].to_pylist() for x in s])  # a document's pairs add up to 1
    return fit_sparse(docs_, label, weight, pairs, swap=swap, pair_weight=shares)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the text column replaced by ``score``."""
    keep = [f for f in docs.schema.fields if f.name != text_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        known = shared.value
        z = np.array([known.logit(t) for t in texts_of(batch, text_col)])
        return ({f.name: batch.column(f.name) for f in keep}
                | {"score": pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))})

    ddl = ", ".join([*(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in keep), "score double"])
    return map_batches(docs, run, ddl)


def toxicity_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", threshold: float = 0.5, max_rows: int = 6000,
                    mod: int = 5, held: int = 0, swap: float = 5.0) -> DataFrame:
    """Per document: id, held_out, score, predicted."""
    model = fit(docs, labels, id_col, text_col, label_col, max_rows, mod, held, swap)
    slim = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    return score(slim, model).select(
        F.col("id").alias(id_col), (split_remainder(F.col("id"), mod) == held).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
