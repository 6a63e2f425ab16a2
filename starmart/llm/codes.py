"""Vector code compression: product quantisation, its nearest entries found by slices and bitmasks.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts.  Each part position has a
codebook of at most 256 entries, refined by k-means rounds in integers; a vector's code names the
nearest entry of each of its parts.

The nearest entry is found exactly (:class:`Slices`): per dimension the entries' coordinates are sorted,
and a prefix mask after each says which entries come so far, one bit an entry in uint64 words.  A radius
around a point selects a range per dimension (two binary searches); the exclusive-or of the masks at its
ends is the set of entries in that slice, and the slices of all dimensions ANDed are the entries in the
box.  The initial radius is the codebook's own spacing; points whose box is empty double theirs.  The
nearest entry in the box bounds the distance of the nearest of all, so the box of that distance holds it
and every tie: what it adds is compared, too.

Spark job: tasks turn vectors into integers, stored once in the shared folder; each round is one pass of
map tasks that send one row of sums per used entry, added up by Spark.  The codebooks (``parts`` x 256
entries: as many numbers as 256 vectors have) are all that reaches the driver and all that is sent to the
tasks, whatever the number of rows.  A label is a key of one sum per group, combined before the shuffle.

Defined results: rows whose vector is null or has a null or non-finite component are dropped, as are
vectors of another length than ``dims`` (by default the most frequent length, the larger of ties);
integers are clamped at ``+-limit``, far beyond any embedding, so squares and sums stay exact longs; fewer
than 256 rows make as many entries; of equal vec_ids the smaller vectors come first in the codebook, null
ids last; equal distances go to the lower index; a label's sum beyond a long is null; an empty table gives
an empty result; columns other than id, vector and label are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted, small_side, stored

ENTRIES = 256
BLOCK = 8192


def clamp_limit(dims: int) -> int:
    """Integers up to this keep the squared distance of two vectors within a long."""
    return math.isqrt((1 << 60) // max(1, dims)) // 2


class Slices:
    """Sorted coordinates and prefix masks of one codebook (entries x dimensions, integers)."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries = np.ascontiguousarray(entries, np.int64)
        n, dims = entries.shape
        self.words = -(-max(n, 1) // 64)
        bits = np.zeros((n, self.words), np.uint64)
        at = np.arange(n)
        bits[at, at // 64] = np.uint64(1) << (at % 64).astype(np.uint64)
        order = np.argsort(entries, axis=0, kind="stable")
        self.sorted = [entries[order[:, d], d] for d in range(dims)]
        self.prefix = [np.concatenate((np.zeros((1, self.words), np.uint64),
                                       np.bitwise_or.accumulate(bits[order[:, d]], axis=0)))
                       for d in range(dims)]
        self.all = np.bitwise_or.reduce(bits, axis=0) if n else np.zeros(self.words, np.uint64)
        self.radius = self._spacing()

    def _spacing(self) -> int:
        """Half of the entries have another one in the box of this radius."""
        near = [np.abs(np.delete(self.entries, i, 0) - e).max(1).min()
                for i, e in enumerate(self.entries)] if min(self.entries.shape) and len(self.entries) > 1 else [1]
        return max(1, int(np.median(near)))

    def box(self, points: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """Masks (points x words) of the entries within ``radius`` of each point in every dimension."""
        mask = np.repeat(self.all[None, :], len(points), axis=0)
        for d, (coords, prefix) in enumerate(zip(self.sorted, self.prefix)):
            lo = np.searchsorted(coords, points[:, d] - radius, side="left")
            hi = np.searchsorted(coords, points[:, d] + radius, side="right")
            mask &= prefix[hi] ^ prefix[lo]
        return mask

    def _compare(self, points: np.ndarray, mask: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        """Lower ``best`` and ``index`` to the nearest entry of each point's mask (ties: lower index)."""
        chosen = np.unpackbits(mask.view(np.uint8), axis=1, bitorder="little").T
        for e in np.flatnonzero(chosen.any(axis=1)):
            rows = np.flatnonzero(chosen[e])
            gap = points[rows] - self.entries[e]
            dist = np.einsum("ij,ij->i", gap, gap)
            better = (dist < best[rows]) | ((dist == best[rows]) & (e < index[rows]))
            best[rows[better]], index[rows[better]] = dist[better], e

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each point."""
        n = len(points)
        best = np.full(n, np.iinfo(np.int64).max)
        index = np.full(n, len(self.entries))
        seen = np.zeros((n, self.words), np.uint64)
        open_, radius = np.arange(n), self.radius
        while len(open_):  # boxes grow until they hold an entry
            mask = self.box(points[open_], np.full(len(open_), radius))
            self._update(points, open_, mask, best, index)
            seen[open_] = mask
            open_ = open_[~mask.any(axis=1)]
            radius *= 2
        reach = np.sqrt(best.astype(np.float64)).astype(np.int64) + 1  # not below the distance
        mask = self.box(points, reach) & ~seen
        self._update(points, np.flatnonzero(mask.any(axis=1)), mask, best, index, whole=True)
        return index, best

    def _update(self, points, rows, mask, best, index, whole: bool = False) -> None:
        b, i = best[rows], index[rows]
        self._compare(points[rows], np.ascontiguousarray(mask[rows] if whole else mask), b, i)
        best[rows], index[rows] = b, i


def integers(batch: pa.RecordBatch, dims: int, scale: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their integer vectors) of a batch with a column ``vector`` of doubles."""
    lists = batch.column("vector")
    length = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(length == dims)
    if not len(rows):
        return rows, np.zeros((0, dims), np.int64)
    flat = lists.take(pa.array(rows)).flatten()
    holes = flat.is_null().to_numpy(zero_copy_only=False).reshape(len(rows), dims)
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), dims)
    good = np.isfinite(x).all(axis=1) & ~holes.any(axis=1)
    with np.errstate(over="ignore"):
        scaled = np.clip(np.floor(x[good] * float(scale)), -limit, limit)
    return rows[good], scaled.astype(np.int64)


def _points(batch: pa.RecordBatch, parts: int) -> np.ndarray:
    """The integer vectors of a stored batch: rows x parts x part's dimensions."""
    flat = batch.column("q").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(batch.num_rows, parts, -1)


def _lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()),
                                    pa.array(rows.reshape(-1), kind))


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for lo in range(0, batch.num_rows, BLOCK):
        yield batch.slice(lo, BLOCK)


def _sums(batches, books: Sequence[np.ndarray]):
    """Per used entry of a task's rows: part, entry, number of parts and the sum of their numbers."""
    slices = [Slices(b) for b in books]
    total = [np.zeros_like(b) for b in books]
    count = [np.zeros(len(b), np.int64) for b in books]
    for batch in batches:
        for block in _blocks(batch):
            points = _points(block, len(books))
            for p, s in enumerate(slices):
                index, _ = s.nearest(points[:, p])
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                total[p][used] += np.add.reduceat(points[order, p], first, axis=0)
                count[p][used] += np.diff([*first, len(order)])
    for p in range(len(books)):
        used = np.flatnonzero(count[p])
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p), pa.int32()), pa.array(used, pa.int32()),
                 pa.array(count[p][used]), _lists(total[p][used], pa.int64())],
                names=["part", "entry", "n", "sums"])


def _codes(batches, books: Sequence[np.ndarray]):
    """Per row: its code in hex and the squared distance of its parts to their entries."""
    slices = [Slices(b) for b in books]
    for batch in batches:
        for block in _blocks(batch):
            points = _points(block, len(books))
            found = [s.nearest(points[:, p]) for p, s in enumerate(slices)]
            code = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [block.column("id"), block.column("label"),
                 pa.array([c.tobytes().hex() for c in code], pa.string()),
                 pa.array(sum(dist for _, dist in found))],
                names=["id", "label", "code", "error"])


def refine(kept: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """One k-means round: every entry becomes the componentwise floor of its parts' mean; unused
    entries stay."""
    sent = kept.select("q").mapInArrow(partial(_sums, books=books),
                                       "part int, entry int, n long, sums array<long>")
    rows = (sent.select("part", "entry", "n", F.posexplode("sums").alias("at", "s"))
            .groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())
    new = [b.copy() for b in books]
    for r in rows:
        new[r.part][r.entry, r.at] = r.s // r.n
    return new


def books_sha256(books: Sequence[np.ndarray]) -> str:
    """SHA-256 of all entries' components by part, entry and position, as decimal text."""
    return hashlib.sha256(",".join(str(x) for b in books for x in b.reshape(-1).tolist()).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
             label_col: str | None = "label", parts: int = 4, rounds: int = 4, scale: int = 1024,
             dims: int | None = None) -> tuple[DataFrame, list[np.ndarray]]:
    """The codes of all kept vectors (id, ``code``, ``error``, ``label_error``) and the codebooks.

    ``label_error`` sums ``error`` over the rows of equal labels (nulls together; without a label
    column over all rows).  ``dims`` must be a multiple of ``parts``.
    """
    label = F.col(quoted(label_col)) if label_col else F.lit(None).cast("int")
    slim = vectors.select(F.col(quoted(id_col)).alias("id"), label.alias("label"),
                          F.col(quoted(vector_col)).cast("array<double>").alias("vector"))
    if dims is None:
        common = (slim.filter(F.size("vector") % parts == 0).groupBy(F.size("vector").alias("dims")).count()
                  .filter("dims >= 0").orderBy(F.desc("count"), F.desc("dims")).first())
        dims = common.dims if common else 0
    if dims % parts:
        raise ValueError(f"{dims} dimensions are no {parts} equal parts")
    limit = clamp_limit(dims)
    types = {f.name: f.dataType.simpleString() for f in slim.schema.fields}

    def kept_rows(batches):
        for batch in batches:
            rows, q = integers(batch, dims, scale, limit)
            if len(rows):
                at = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(at), batch.column("label").take(at), _lists(q, pa.int64())],
                    names=["id", "label", "q"])

    kept = stored(slim.mapInArrow(kept_rows, f"id {types['id']}, label {types['label']}, q array<long>"),
                  "integer-vectors")
    first = kept.orderBy(F.col("id").asc_nulls_last(), "q").select("q").limit(ENTRIES).collect()
    table = np.array([r.q for r in first], np.int64).reshape(len(first), parts, dims // parts)
    books = [table[:, p] for p in range(parts)]
    for _ in range(rounds):
        books = refine(kept, books)
    codes = stored(kept.mapInArrow(partial(_codes, books=books),
                                   f"id {types['id']}, label {types['label']}, code string, error long"),
                   "vector-codes")
    sums = codes.groupBy(F.col("label").alias("l")).agg(
        F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    out = codes.join(small_side(sums), F.col("label").eqNullSafe(F.col("l")))
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error"), books
