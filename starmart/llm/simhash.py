"""SimHash near-duplicates, compared bit-sliced.

A text is folded (A-Z), cut in words and ``width``-word shingles; a fingerprint bit is 1 if it is
set in over half of the shingles' XXH64.  Fingerprints link at ``radius`` or fewer differing bits;
linked fingerprints, directly or through others, form one component.

Search: the 64 bits fall into ``blocks`` equal blocks.  Two fingerprints within the radius agree on
at least ``blocks - radius`` blocks, so each distinct fingerprint is dealt once per choice of that
many blocks, under the agreed bits as key (with 4 blocks and radius 2: six keys of 32 bits).  A
bucket larger than ``tile`` is split into chunks whose pairs make tiles, so no bucket, however
large, lands in one task.  Within a tile the bit planes are stored vertically: one 64-bit word holds
one bit of 64 fingerprints.  Carry-save counters add up the differing planes for many distances at
once and saturate above the radius; a word is abandoned as soon as all of its 64 distances exceed
the radius.  Of the links of a tile only a spanning forest leaves the task, which keeps
connectivity and bounds the output by the tile's rows.

Defined results: null and empty texts have fingerprint zero and link like any other; the component
id is the smallest id reachable (null ids count only if there is no other).  Repeated rows share a
fingerprint and are linked; a bit set in just half the hashes is 0; texts of any length are read whole; an
empty table gives an empty result; columns other than those named are not read, whatever their names
(the stage carries them along).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, quoted, small_side, stored, texts_of, with_locator, word_blocks

BITS = 64
SEED = 42


# ------------------------------------------------------------------------------ fingerprints

def fingerprint(text: str, width: int = 3) -> int:
    """The fingerprint of one text, as an unsigned 64-bit number."""
    data = text.encode("utf-8", "surrogatepass").lower()  # of bytes: only A-Z change
    counts, total, tail = np.zeros(BITS, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks(data):
        words = tail + words
        if len(words) >= width:
            shifted = [words[i:] for i in range(width)]
            hashes = [digest(s, SEED) for s in map(b" ".join, zip(*shifted))]
            for i in range(0, len(hashes), 1 << 15):
                part = np.array(hashes[i:i + (1 << 15)], "<u8")
                bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[max(0, len(words) - width + 1):]
    if not total:  # fewer words than a shingle: the whole sequence
        return digest(b" ".join(tail), SEED) if tail else 0
    return int(((2 * counts > total).astype(np.uint64) << np.arange(BITS, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, text_col: str = "text", width: int = 3) -> DataFrame:
    """``docs`` with the text column replaced by ``fp`` (the 64 bits as a signed long)."""
    keep = [f for f in docs.schema.fields if f.name != text_col]
    ddl = ", ".join([*(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in keep), "fp long"])

    def run(batch: pa.RecordBatch) -> dict:
        out = {f.name: batch.column(f.name) for f in keep}
        fps = np.array([fingerprint(t, width) for t in texts_of(batch, text_col)], np.uint64)
        return out | {"fp": pa.array(fps.view(np.int64))}

    return map_batches(docs, run, ddl, sliced=True)


# ------------------------------------------------------------------------- bit-sliced comparison

def near_bits(fps: np.ndarray, radius: int) -> np.ndarray:
    """(n, words) uint64: bit j of row i is set if fingerprints i and j differ in <= radius bits.

    Plane by plane over a block of 64 fingerprints; after every 8 planes only the (row, word) cells
    with a distance still within the radius go on.
    """
    n = len(fps)
    words = -(-n // 64)
    lanes = np.zeros((words * 64, 8), np.uint8)
    lanes[:n] = fps.astype("<u8").view(np.uint8).reshape(n, 8)
    bits = np.unpackbits(lanes, axis=1, bitorder="little")  # (lanes, 64)
    planes = np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u8")  # (64, words)
    query = np.where(bits[:n].T.astype(bool), ~np.uint64(0), np.uint64(0))  # (64, n)
    digits = radius.bit_length()
    row, word = (x.ravel() for x in np.indices((n, words)))
    count = [np.zeros(n * words, np.uint64) for _ in range(digits)]
    over = np.zeros(n * words, np.uint64)

    def exceeded() -> np.ndarray:
        """Lanes whose counter is above the radius: overflown, or greater bit by bit."""
        above, equal = over.copy(), ~np.uint64(0)
        for k in reversed(range(digits)):
            if radius >> k & 1:
                equal = equal & count[k]
            else:
                above |= equal & count[k]
                equal = equal & ~count[k]
        return above

    for start in range(0, BITS, 8):
        for b in range(start, start + 8):
            carry = planes[b, word] ^ query[b, row]
            for k in range(digits):
                carry, count[k] = carry & count[k], carry ^ count[k]
            over |= carry
        live = exceeded() != ~np.uint64(0)
        if not live.all():
            row, word, over = row[live], word[live], over[live]
            count = [c[live] for c in count]
    out = np.zeros((n, words), np.uint64)
    out[row, word] = ~exceeded()
    if n % 64:
        out[:, -1] &= np.uint64((1 << n % 64) - 1)
    return out


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """(root, member) of every connected component of a packed adjacency, by breadth-first search."""
    n, edges = len(near), []
    seen = np.zeros(near.shape[1], np.uint64)
    for root in range(n):
        if seen[root >> 6] >> np.uint64(root & 63) & np.uint64(1):
            continue
        reached = np.zeros_like(seen)
        reached[root >> 6] = np.uint64(1) << np.uint64(root & 63)
        front = np.array([root])
        while len(front):
            new = np.bitwise_or.reduce(near[front], axis=0) & ~reached
            reached |= new
            front = np.flatnonzero(np.unpackbits(new.view(np.uint8), bitorder="little"))
            edges += [(root, int(i)) for i in front]
        seen |= reached
    return edges


def links(fps: DataFrame, radius: int = 2, blocks: int = 4, tile: int = 2048) -> DataFrame:
    """Links (u, v) between the distinct fingerprints ``fp`` that keep all connectivity."""
    if not 0 <= radius < blocks:
        raise ValueError("there must be more blocks than the radius")
    edges = np.linspace(0, BITS, blocks + 1).astype(int)
    keys = []
    for table, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(((1 << int(edges[b + 1])) - 1) ^ ((1 << int(edges[b])) - 1) for b in chosen)
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(table).alias("tab"),
                             F.col("fp").bitwiseAND(F.lit(signed).cast("long")).alias("key")))
    dealt = fps.select("fp", F.inline(F.array(*keys)))
    buckets = dealt.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / tile).cast("int")
    own = F.pmod(F.xxhash64("fp"), chunks).cast("int")
    tiles = F.transform(F.sequence(F.lit(0), chunks - 1),
                        lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j")))
    rows = (dealt.join(buckets, ["tab", "key"])
            .select("tab", "key", "fp", F.inline(tiles)))
    parted = rows.repartition("tab", "key", "i", "j").sortWithinPartitions("tab", "key", "i", "j")

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch:
        own = np.unique(np.concatenate(parts))
        found = forest(near_bits(own.view(np.uint64), radius))
        u, v = (own[[e[k] for e in found]] if found else own[:0] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    def run(batches):
        # whole tiles are gathered until there are enough rows for full words; comparing two small
        # tiles of one gathering with each other is harmless: any link found is a true one
        held, size, last, open_ = [], 0, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            tag = np.stack([batch.column(c).to_numpy().astype(np.int64)
                            for c in ("tab", "key", "i", "j")], axis=1)
            fp = batch.column("fp").to_numpy()
            cuts = np.flatnonzero((tag[1:] != tag[:-1]).any(axis=1)) + 1
            for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(fp)]):
                if last is not None and (tag[a] != last).any():
                    held += open_
                    open_ = []
                    if size >= 512:
                        yield flush(held)
                        held, size = [], 0
                open_.append(fp[a:b])
                size += b - a
                last = tag[a]
        if held or open_:
            yield flush(held + open_)

    return parted.mapInArrow(run, "u long, v long")


# ------------------------------------------------------------------------- connected components

def files(rows: int, least: int = 2, per_file: int = 250_000) -> int:
    """In how many files to store so many narrow rows: few for small tables, more as they grow."""
    return max(least, -(-rows // per_file))


def components(edges: DataFrame, partitions: int | None = None) -> DataFrame:
    """(node, root): each linked node and the smallest node of its component.

    Alternates the large-star and small-star steps until the edges are stars; every step is a
    map-side combined minimum per node and a join with it, stored in the shared folder.
    """
    def canonical(df: DataFrame) -> DataFrame:
        return (df.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct())

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                            F.bit_xor(F.xxhash64("v", "u"))).first())

    now = stored(canonical(edges), "components", partitions)
    before = state(now)
    while before[0]:
        parts = files(before[0])
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(canonical(large), "components", parts)
        least = now.groupBy("u").agg(F.min("v").alias("m"))
        small = now.join(least, "u")
        small = (small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
        now = stored(canonical(small), "components", parts)
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def component_of(fps: DataFrame, id_col: str, radius: int, blocks: int, tile: int) -> DataFrame:
    """(fp, component_id) for every distinct ``fp`` of (id_col, fp) rows."""
    n, tasks = fps.count(), fps.sparkSession.sparkContext.defaultParallelism
    nodes = stored(fps.groupBy("fp").agg(F.min(id_col).alias("least_id")), "simhash-nodes", files(n))
    found = links(nodes.select("fp"), radius, blocks, tile)
    roots = components(stored(found, "simhash-links", files(n, tasks)), files(n))
    rooted = (nodes.join(roots, nodes.fp == roots.node, "left")
              .select("fp", "least_id", F.coalesce("root", "fp").alias("root")))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                radius: int = 2, blocks: int = 4, tile: int = 2048) -> DataFrame:
    """Per document: id, fingerprint (16 hexadecimal digits), component_id."""
    slim = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    fps = stored(fingerprints(slim, "text", width), "simhash-fingerprints")
    found = component_of(fps, "id", radius, blocks, tile)
    return (fps.join(found, "fp")
            .select(F.col("id").alias(id_col),
                    F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     width: int = 3, radius: int = 2, blocks: int = 4, tile: int = 2048) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id (of rows that share it, the
    first by place); the columns of ``docs``."""
    rows = with_locator(docs, F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    slim = rows.select(F.struct(F.col("id").isNull().alias("none"), "id", "locator").alias("key"), "text")
    fps = stored(fingerprints(slim, "text", width), "simhash-fingerprints")
    found = component_of(fps, "key", radius, blocks, tile)
    drop = (fps.join(found, "fp").where(~F.col("key").eqNullSafe(F.col("component_id")))
            .select("key.locator"))
    return rows.join(small_side(stored(drop, "simhash-drop")), "locator", "left_anti").select("row.*")
