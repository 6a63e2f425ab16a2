"""Language identification by nearest centroid.

A text is the vector of its byte trigrams (ASCII case folded, runs of anything but letters taken as
one space), hashed to a fixed number of dimensions, with logarithmic counts times inverse document
frequency, scaled to length one.  Document frequencies are counted over all training documents.
Each language has several centroids, found by spherical k-means, one task per language, on at most
``max_rows`` of its training documents (one row per id) picked by a hash of the id; their trigram counts,
not their texts, meet in that task.  A text gets the language of the
centroid with the largest cosine.

Distance-based rejection: a text whose distance to its centroid (1 - cosine) is beyond the
language's limit - the ``reject_quantile`` quantile over its own training sample - is ``rejected``;
its ``lang_pred`` still names the nearest language.  A null text and a text without a letter have
``lang_pred`` ``und``, score 0 and count as rejected.  Null ``lang`` rows teach nothing; without any
training row every text is ``und``.  Of centroids equally near the first counts, languages in the order of
their names.  Rows that repeat an id are answered each and teach the centroids once; texts of any length
are read whole; an empty table gives an empty result; columns other than those named are not read,
whatever their names.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (bounded_sample, map_batches, quoted, small_side, split_remainder, stored, texts_of,
                     uniform_hash)

DIMENSIONS = 4096
#: ASCII letters folded, every other ASCII byte a space, bytes of longer characters kept
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
GAPS = re.compile(rb"  +")
LETTER = re.compile(r"[^\W\d_]")
BLOCK = 1 << 20


def counts(text: str) -> np.ndarray:
    """How often each hashed trigram occurs in the whole text."""
    data = np.frombuffer(GAPS.sub(b" ", b" " + text.encode("utf-8", "replace").translate(FOLD) + b" "),
                         np.uint8)
    out = np.zeros(DIMENSIONS, np.int64)
    for at in range(0, max(len(data) - 2, 0), BLOCK):
        part = data[at:at + BLOCK + 2].astype(np.uint32)
        gram = part[:-2] << 16 | part[1:-1] << 8 | part[2:]
        slot = gram * np.uint32(2654435761) >> np.uint32(20)  # the top 12 bits of a product hash
        out += np.bincount(slot, minlength=DIMENSIONS)
    return out


def vector(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of trigram counts as unit TF-IDF vectors."""
    x = (np.log1p(found) * idf).astype(np.float32)
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    """Unit centroids of unit rows; the first is the mean's nearest row, the next ones far rows."""
    centres = [x[np.argmax(x @ x.mean(axis=0))]]
    while len(centres) < min(k, len(x)):
        near = np.max(x @ np.stack(centres).T, axis=1)
        # not the farthest, which may be an oddity, but one at the lowest tenth of similarity
        centres.append(x[np.argsort(near, kind="stable")[len(x) // 10]])
    c = np.stack(centres)
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        new = np.stack([x[own == j].sum(axis=0) if (own == j).any() else c[j] for j in range(len(c))])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, c, atol=1e-6):
            break
        c = new
    return c


@dataclass(frozen=True)
class Model:
    languages: np.ndarray  # of each centroid
    centres: np.ndarray
    limits: np.ndarray  # largest distance accepted
    idf: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, rejected) of each text."""
        blank = np.array([t is None or not LETTER.search(t) for t in texts], bool)
        if not len(self.languages):
            blank[:] = True
        lang, score = np.full(len(texts), "und", object), np.zeros(len(texts))
        rejected = blank.copy()
        some = np.flatnonzero(~blank)
        for at in range(0, len(some), 256):
            own = some[at:at + 256]
            cosine = vector(np.stack([counts(texts[i]) for i in own]), self.idf) @ self.centres.T
            best = cosine.argmax(axis=1)
            near = cosine[np.arange(len(own)), best]
            lang[own] = self.languages[best]
            score[own] = np.clip(near, 0, 1)
            rejected[own] = 1 - near > self.limits[best]
        return lang.tolist(), score, rejected


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = 3, max_rows: int = 2000, reject_quantile: float = 0.999, mod: int = 5,
        held: int = 0, max_bytes: int = 64 << 20) -> Model:
    """Learn from the rows of the training split with a language and a letter in the text.

    Centroids come from at most about ``max_rows`` ids and ``max_bytes`` of text per language; the model
    has ``per_language`` centroids of 4096 floats per value of the language column.
    """
    rows = (docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"),
                        F.col(quoted(lang_col)).cast("string").alias("lang"))
            .where((split_remainder(F.col("id"), mod) != held) & F.col("lang").isNotNull()
                   & F.col("text").isNotNull()))

    def frequencies(batches):
        # one row per task: in how many texts each slot occurs
        df, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                df += counts(text) > 0
                n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()),
                                          "df": pa.array([df.tolist()], pa.list_(pa.int64()))})

    summed = (rows.select("text").mapInArrow(frequencies, "n long, df array<long>")
              .select("n", F.posexplode("df").alias("slot", "df"))
              .groupBy("slot").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).toPandas())
    n = int(summed["n"].max()) if len(summed) else 0
    df = np.zeros(DIMENSIONS)
    df[summed["slot"].to_numpy(int)] = summed["df"].to_numpy(float)
    idf = np.log((1 + n) / (1 + df)) + 1e-3

    per = rows.groupBy("lang").count()  # joined, however many values the column has
    drawn = rows.join(small_side(stored(per, "language-counts")), "lang").where(
        uniform_hash("language", F.col("id")) < F.lit(float(max_rows)) / F.col("count"))
    sample = bounded_sample(drawn.select(F.col("lang").alias("kind"), "id", "text"), "language-bytes", max_bytes)

    def sparse(batch: pa.RecordBatch) -> dict:
        texts = [t if LETTER.search(t) else "" for t in texts_of(batch)]
        found = [counts(t) for t in texts]
        slots = [np.flatnonzero(f) if t else np.zeros(0, np.int64) for t, f in zip(texts, found)]
        return {"lang": batch.column("kind"), "slots": [s.tolist() for s in slots],
                "n": [f[s].tolist() for f, s in zip(found, slots)]}

    def cluster(table: pa.Table) -> pa.Table:
        rows = sorted((tuple(s), tuple(n)) for s, n in zip(table.column("slots").to_pylist(),
                                                           table.column("n").to_pylist()) if s)
        if not rows:
            return pa.table({"lang": pa.array([], pa.string()), "centre": pa.array([], pa.list_(pa.float32())),
                             "limit": pa.array([], pa.float64())})
        x = np.zeros((len(rows), DIMENSIONS), np.float32)
        for i, (slots, n) in enumerate(rows):
            x[i, list(slots)] = np.log1p(n) * idf[list(slots)]
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        c = spherical_kmeans(x, per_language)
        limit = float(np.quantile(1 - np.max(x @ c.T, axis=1), reject_quantile))
        lang = table.column("lang")[0].as_py()
        return pa.table({"lang": pa.array([lang] * len(c), pa.string()),
                         "centre": pa.array(list(c), pa.list_(pa.float32())),
                         "limit": pa.array([limit] * len(c), pa.float64())})

    vectors = map_batches(sample, sparse, "lang string, slots array<int>, n array<long>")
    found = (vectors.groupBy("lang")
             .applyInArrow(cluster, "lang string, centre array<float>, limit double").toPandas())
    found = found.sort_values("lang", kind="stable")
    centres = np.array(found["centre"].tolist(), np.float32).reshape(-1, DIMENSIONS)
    return Model(found["lang"].to_numpy(object), centres, found["limit"].to_numpy(float), idf)


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              mod: int = 5, held: int = 0, **options) -> DataFrame:
    """Per document: id, held_out, lang_pred, score, rejected."""
    model = fit(docs, id_col, text_col, lang_col, mod=mod, held=held, **options)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))

    def run(batch: pa.RecordBatch) -> dict:
        lang, score, rejected = shared.value.predict(batch.column("text").to_pylist())
        return {"id": batch.column("id"), "lang_pred": lang, "score": pa.array(score),
                "rejected": pa.array(rejected)}

    out = map_batches(slim, run, f"id {slim.schema['id'].dataType.simpleString()}, lang_pred string, "
                                 "score double, rejected boolean")
    return out.select(F.col("id").alias(id_col),
                      (split_remainder(F.col("id"), mod) == held).alias("held_out"),
                      "lang_pred", "score", "rejected")
