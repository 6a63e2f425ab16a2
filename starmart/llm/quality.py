"""Quality classifier by positive-unlabelled learning.

Trusted positives (documents labelled 1 in the training split) and unlabelled web text (any
documents of the training split, labels unseen) give a non-negative unbiased estimate of the risk:
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))``.  When the second part falls below zero its
gradient is turned around, as overfitting would otherwise drive it down without end.  The label
0 is used nowhere.  The class prior is estimated from the data: a plain classifier of
positives against unlabelled text is trained on one half, and on the other half the prior is the
smallest ratio, over score thresholds, of the share of unlabelled rows above it (less three standard
errors: too high a prior hides the negatives, one slightly too low does no harm) to that of positives.

The model is additive: about twenty statistics of the whole text, each cut at quantiles of the
unlabelled sample, with one weight per bin.  It is fitted on at most ``max_rows`` positives and
``max_rows`` unlabelled rows, picked by a hash of the id; every document is scored.

Defined results: a null text counts as empty and is scored like any text; labels that are null are
left out, repeated labels of one id count once, the smallest (a document is a trusted positive only
if all its labels are 1).  Without positives to learn from, every score is the prior 0.5.  Rows that
repeat an id are scored each and teach once; texts of any length are read whole; equal
feature rows score alike; an empty table gives an empty result; columns other than those named are not
read, whatever their names (the stage carries them along).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, quoted, split_remainder, texts_of, uniform_hash, word_blocks

CLASSES = {"upper": bytes(range(65, 91)), "lower": bytes(range(97, 123)), "digit": b"0123456789",
           "stop": b".!?", "bang": b"!?", "comma": b",;:", "symbol": b"#*$%&<>@^~=+_\\/{}[]",
           "bar": b"|", "quote": b"\"'()-", "high": bytes(range(128, 256))}
FEATURES = ["log_words", "word_len", "distinct", "distinct_200", "adjacent", "pair_repeat", "top_word",
            "log_line_words", "open_lines", "copied_lines", "end_stop", *CLASSES]
BANDS = np.zeros((len(CLASSES), 256))
for _row, _bytes in enumerate(CLASSES.values()):
    BANDS[_row, list(_bytes)] = 1


def features(text: str) -> list[float]:
    """The statistics of one text, whole; zeros for a text without words."""
    data = text.encode("utf-8", "surrogatepass")
    counts, pairs, n, adjacent, n_pairs = Counter(), set(), 0, 0, 0
    ended, near, rest = 0, 0, []  # near: the distinct words of each window of 200, summed
    for words in word_blocks(data):
        counts.update(words)
        pairs.update(map(hash, zip(words, words[1:])))
        adjacent += sum(map(bytes.__eq__, words, words[1:]))
        n_pairs += max(0, len(words) - 1)
        ended += sum(w[-1] in b".!?" for w in words)
        n += len(words)
        rest += words
        whole = len(rest) - len(rest) % 200
        near += sum(len(set(rest[at:at + 200])) for at in range(0, whole, 200))
        rest = rest[whole:]
    if not n:
        return [0.0] * len(FEATURES)
    lines = [x for x in data.split(b"\n") if x.strip()]
    closed = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    share = BANDS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    return [np.log1p(n), len(data) / n, len(counts) / n, (near + len(set(rest))) / n, adjacent / n,
            1 - len(pairs) / max(1, n_pairs), counts.most_common(1)[0][1] / n,
            np.log1p(n / len(lines)), 1 - closed / len(lines), 1 - len(set(lines)) / len(lines),
            ended / n, *(share / n)]


# -------------------------------------------------------------------------------------- learning

def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass(frozen=True)
class Model:
    """Bin edges per feature and a weight per bin."""
    edges: tuple[np.ndarray, ...]
    weights: tuple[np.ndarray, ...]
    bias: float
    prior: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for k, (edges, w) in enumerate(zip(self.edges, self.weights)):
            z += w[np.searchsorted(edges, x[:, k], side="right")]
        return z

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(x))


def bins(x: np.ndarray, per: int = 16) -> tuple[np.ndarray, ...]:
    """Edges at quantiles, finer in the tails."""
    at = np.unique(np.r_[0.005, 0.01, 0.02, 0.98, 0.99, 0.995, np.linspace(0, 1, per + 1)[1:-1]])
    return tuple(np.unique(np.quantile(col, at)) for col in x.T)


def one_hot(edges: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """Column indices of the active bins, one per feature."""
    starts = np.cumsum([0, *(len(e) + 1 for e in edges)])[:-1]
    return np.stack([s + np.searchsorted(e, col, side="right")
                     for s, e, col in zip(starts, edges, x.T)], axis=1)


def descend(gradient, size: int, rounds: int, rate: float) -> np.ndarray:
    """Adam from zero; ``gradient(w)`` is the gradient of the risk."""
    w, m, v = (np.zeros(size) for _ in range(3))
    for t in range(1, rounds + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return w


def _sums(active: np.ndarray, slope: np.ndarray, size: int) -> np.ndarray:
    """Gradient of sum(slope * z) for z = bias + the active bins' weights; the bias comes last."""
    g = np.bincount(active.ravel(), np.repeat(slope, active.shape[1]), size - 1)
    return np.r_[g, slope.sum()]


def _value(active: np.ndarray, w: np.ndarray) -> np.ndarray:
    return w[active].sum(axis=1) + w[-1]


def estimate_prior(p: np.ndarray, u: np.ndarray, size: int, rounds: int, rate: float, decay: float
                   ) -> float:
    """Share of positives in the unlabelled rows: the mean of two halves, each judged by the other."""
    found = []
    for k in (0, 1):
        train_p, test_p, train_u, test_u = p[k::2], p[1 - k::2], u[k::2], u[1 - k::2]

        def gradient(w: np.ndarray) -> np.ndarray:
            return (_sums(train_p, (sigmoid(_value(train_p, w)) - 1) / len(train_p), size)
                    + _sums(train_u, sigmoid(_value(train_u, w)) / len(train_u), size) + decay * w)

        w = descend(gradient, size, rounds, rate)
        a, b = np.sort(_value(test_p, w)), np.sort(_value(test_u, w))
        cuts = np.quantile(a, np.linspace(0, 0.3, 31))
        over_p = 1 - np.searchsorted(a, cuts) / len(a)
        over_u = 1 - np.searchsorted(b, cuts) / len(b)
        found.append(np.min((over_u - 3 * np.sqrt(over_u * (1 - over_u) / len(b))) / over_p))
    return float(np.clip(np.mean(found), 0.02, 0.98))


def fit_pu(positive: np.ndarray, unlabelled: np.ndarray, rounds: int = 1000, rate: float = 0.05,
           decay: float = 0.3, prior: float | None = None, least_rows: int = 20,
           few_prior: float = 0.5) -> Model:
    """Minimise the non-negative risk with the logistic loss over the binned features.

    ``decay`` is the weights' penalty for one row; it falls with the number of rows.  The class prior
    is estimated unless given; with fewer than ``least_rows`` positives or unlabelled rows two halves
    tell nothing, and ``few_prior`` is taken.
    """
    if not len(positive) or not len(unlabelled):
        return Model((), (), 0.0, 0.5)
    edges, decay = bins(unlabelled), decay / min(len(positive), len(unlabelled))
    size = sum(len(e) + 1 for e in edges) + 1
    p, u = one_hot(edges, positive), one_hot(edges, unlabelled)
    if prior is None:
        prior = (estimate_prior(p, u, size, rounds // 4, rate, decay)
                 if min(len(p), len(u)) >= least_rows else few_prior)

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = _value(p, w), _value(u, w)
        as_positive = _sums(p, prior * (sigmoid(zp) - 1) / len(p), size)
        as_negative = (_sums(u, sigmoid(zu) / len(u), size)
                       - _sums(p, prior * sigmoid(zp) / len(p), size))
        risk = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        return (as_positive + as_negative if risk >= 0 else -as_negative) + decay * w

    w = descend(gradient, size, rounds, rate)
    cuts = np.cumsum([len(e) + 1 for e in edges])
    return Model(edges, tuple(np.split(w[:-1], cuts[:-1])), float(w[-1]), prior)


# ----------------------------------------------------------------------------------------- Spark

def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int, mod: int, held: int) -> DataFrame:
    """(kind, id, x): the features of about ``max_rows`` trusted positives and as many unlabelled
    documents, one row per id however often it is repeated (of several texts the one with the smallest
    features).  Texts stay where they are; only their features are shuffled."""
    train = split_remainder(F.col("id"), mod) != held
    known = (labels.where("label is not null").groupBy("id").agg(F.min("label").alias("label"))
             .where((F.col("label") == 1) & train))
    n_known, n_docs = known.count(), docs.count()
    chosen = known.where(uniform_hash("quality-p", F.col("id")) < max_rows / max(n_known, 1)).select("id")
    positive = docs.join(F.broadcast(chosen), "id").select(F.lit("p").alias("kind"), "id", "text")
    unlabelled = docs.where(train & (uniform_hash("quality-u", F.col("id")) < max_rows / max(n_docs, 1)))
    drawn = positive.unionByName(unlabelled.select(F.lit("u").alias("kind"), "id", "text"))
    id_type = drawn.schema["id"].dataType.simpleString()
    rows = map_batches(drawn, lambda b: {"kind": b.column("kind"), "id": b.column("id"),
                                         "x": [features(t) for t in texts_of(b)]},
                       f"kind string, id {id_type}, x array<double>", sliced=True)
    return rows.groupBy("kind", "id").agg(F.min("x").alias("x"))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_rows: int = 20_000, mod: int = 4, held: int = 2) -> Model:
    rows = training_rows(
        docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text")),
        labels.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(label_col)).alias("label")),
        max_rows, mod, held)
    got = rows.toArrow()  # one row of features per id, bounded by max_rows
    kind = np.array(got["kind"].to_pylist())
    x = np.array(got["x"].to_pylist(), float).reshape(len(kind), len(FEATURES))
    order = np.lexsort(x.T)  # the fit must not depend on the order in which rows arrive
    order = order[np.argsort(np.modf(np.abs(x[order]).sum(axis=1) * 7919)[0], kind="stable")]
    x, kind = x[order], kind[order]
    return fit_pu(x[kind == "p"], x[kind == "u"])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the text column replaced by ``score``."""
    keep = [f for f in docs.schema.fields if f.name != text_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> dict:
        x = np.array([features(t) for t in texts_of(batch, text_col)]).reshape(-1, len(FEATURES))
        return {f.name: batch.column(f.name) for f in keep} | {"score": pa.array(shared.value.score(x))}

    ddl = ", ".join([*(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in keep), "score double"])
    return map_batches(docs, run, ddl, sliced=True)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", threshold: float = 0.7, max_rows: int = 20_000,
                   mod: int = 4, held: int = 2) -> DataFrame:
    """Per document: id, held_out, score, predicted."""
    model = fit(docs, labels, id_col, text_col, label_col, max_rows, mod, held)
    slim = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    return score(slim, model).select(
        F.col("id").alias(id_col), (split_remainder(F.col("id"), mod) == held).alias("held_out"),
        "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "quality", threshold: float = 0.7, max_rows: int = 20_000,
                 mod: int = 4, held: int = 2) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    model = fit(docs, labels, id_col, text_col, label_col, max_rows, mod, held)
    rows = docs.select(F.struct(*[F.col(quoted(c)) for c in docs.columns]).alias("row"),
                       F.col(quoted(text_col)).alias("text"))
    return score(rows, model).where(F.col("score") >= threshold).select("row.*")
