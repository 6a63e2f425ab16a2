"""Language-model scoring by prediction by partial matching (PPM).

A text is folded (A-Z), cut in words, and spelled as its words' UTF-8 bytes with one space between
words and one end symbol.  The model is the byte-context trie of all training documents: for every
context of up to ``order`` symbols, how often each symbol followed.  The probability of a symbol comes
from the longest context that has seen it; on the way down every context that has not pays its
escape probability (method D: unseen mass is half a count per distinct symbol), and symbols that a
longer context has seen are excluded from the shorter ones' counts.  What no context has seen is
uniform over the rest of the alphabet.  A document's score is the base-10 logarithm of the whole
text's probability under this pretrained model.

A trie node is a packed number: ``order + 1`` symbols of nine bits, the last one predicted.  As a
symbol seen after a context was also seen after the context's suffix, the symbols excluded at a level
are just those of the next longer context: their sum is one number per context.

Spark job, for a corpus of any size, with nothing of it on the driver but totals:

1. Documents fall into chunks of consecutive rows of a file, cut by a running sum of their bytes: a
   chunk has less than twice ``chunk_bytes``, a longer text is a chunk of its own.  A task counts the distinct nodes and words of a
   chunk and sends them in blocks by hash bucket (a sorted, deflated list with its training counts).
2. Per bucket the counts of all chunks are summed.  Words are answered at once: each chunk gets the
   corpus counts of its words.  The nodes' counts go into tables by order (built by grouping the
   next longer one) and contexts; nodes met only outside training escape through these tables.
3. Each chunk's blocks are answered with the logarithms of its nodes, and the chunk's documents
   meet the answers of the chunk, and only those, for scoring.

A frequent word or node occurs once per chunk at most, so there are no hot keys; the tables of the
two shortest orders have at most 258**2 rows and are broadcast.

Beside the score, the unigram base: sum over the words and one end token of
``log10((c + 0.5) / (N + 0.5 * (V + 1)))`` with counts over training documents.

Tasks by bucket and by chunk are as many as there are buckets, one per ``chunk_bytes`` of text, so what
one task reads does not grow with the corpus.

Defined results: null and empty texts are the end symbol alone; without training documents every
symbol is uniform and the base is that of N = V = 0; repeated rows count and are scored each; a null id
splits as the empty text; ties do not exist; an empty table gives an empty result; columns other than the
id and the text are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, split_remainder, stored, text_or_empty, texts_of, with_locator, word_blocks

BITS, END, PAD = 9, 256, 257
ALPHABET = 257  # 256 bytes and the end; the pad before the text is never predicted
BLOCK = 1 << 20
ROW_BYTES = 64  # what a row counts for beside its text, so that empty ones fill a chunk too
#: rows of a file whose bytes one window sums up, and whose chunks one look-up row holds
SUM_ROWS, LOOKUP_ROWS = 1 << 10, 1 << 16


# ------------------------------------------------------------------------------ nodes of a text

def spelled(text: str) -> tuple[list[list[bytes]], bytes]:
    """The folded words, in blocks, and the words with one space between."""
    blocks = [b for b in word_blocks(text.encode("utf-8", "surrogatepass").lower()) if b]
    return blocks, b" ".join(map(b" ".join, blocks))


def nodes(data: bytes, order: int) -> Iterator[np.ndarray]:
    """The packed nodes of every symbol of a spelled text and its end, in blocks."""
    symbols = np.concatenate([np.full(order, PAD, np.uint16), np.frombuffer(data, np.uint8),
                              np.array([END], np.uint16)])
    for at in range(0, len(data) + 1, BLOCK):
        part = symbols[at:at + BLOCK + order].astype(np.int64)
        n = len(part) - order
        packed = np.zeros(n, np.int64)
        for k in range(order + 1):
            packed = packed << BITS | part[k:k + n]
        yield packed


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    counts = np.bincount(where, np.concatenate([p[1] for p in parts]), len(keys))
    return keys, counts.astype(np.int64)


class Gather:
    """Distinct nodes and words of a chunk with their counts in training documents."""

    def __init__(self, order: int):
        self.order, self.words, self.parts, self.held = order, Counter(), [], 0
        self.wait: dict[bool, list] = {True: [], False: []}
        self.size = 0

    def add(self, text: str, train: bool) -> None:
        blocks, data = spelled(text)
        for words in blocks:
            if train:
                self.words.update(words)
            else:
                for w in set(words):
                    self.words.setdefault(w, 0)
        for packed in nodes(data, self.order):
            self.wait[train].append(packed)
            self.size += len(packed)
            if self.size >= 4 * BLOCK:
                self.settle()

    def settle(self) -> None:
        for train, packed in self.wait.items():
            if packed:
                keys, counts = np.unique(np.concatenate(packed), return_counts=True)
                self.parts.append((keys, counts if train else np.zeros(len(keys), np.int64)))
                packed.clear()
        self.size = 0
        if len(self.parts) > 16:
            self.parts = [merged(self.parts)]

    def blocks(self, buckets: int) -> Iterator[tuple[int, str, bytes, bytes]]:
        """(bucket, kind, keys, counts): sorted nodes ('n') and words ('w') by bucket."""
        self.settle()
        keys, counts = merged(self.parts)
        own = (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(buckets)
        order = np.argsort(own, kind="stable")
        cuts = np.flatnonzero(np.diff(own[order])) + 1
        for part in np.split(order, cuts):
            yield int(own[part[0]]), "n", pack_numbers(np.diff(keys[part], prepend=0)), pack_numbers(counts[part])
        by_bucket: dict[int, list[bytes]] = {}
        for w in sorted(self.words):
            by_bucket.setdefault(zlib.crc32(w) % buckets, []).append(w)
        for bucket, words in by_bucket.items():
            yield (bucket, "w", zlib.compress(b"\n".join(words), 1),
                   pack_numbers(np.array([self.words[w] for w in words], np.int64)))


def pack_numbers(x: np.ndarray) -> bytes:
    """Deflated numbers, the bytes of equal weight together."""
    return zlib.compress(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpack_numbers(data: bytes, kind: type = np.int64) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def unpack_nodes(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(data))


#: odd multiplier: its high bits spread packed nodes evenly
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Table:
    """Values by node, found by hash: nodes sorted by their spread number, and where each stretch of
    equal high bits starts.  A look-up is one jump and, for a few, steps to the next entries - no binary
    search of the whole table.  Every node asked for must be there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.spread = keys.astype(np.uint64) * SPREAD
        order = np.argsort(self.spread)
        self.spread, self.values = self.spread[order], values[order]
        del order
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted(self.spread >> self.shift,
                                     np.arange(1 << bits, dtype=np.uint64)).astype(np.int32)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        want = keys.astype(np.uint64) * SPREAD
        at = self.start[want >> self.shift]
        open_ = np.flatnonzero(self.spread[at] != want)
        while len(open_):
            at[open_] += 1
            open_ = open_[self.spread[at[open_]] != want[open_]]
        return self.values[at]


def row_bytes(text: Column) -> Column:
    return F.octet_length(text_or_empty(text)).cast("long") + ROW_BYTES


def chunk_starts(sizes: DataFrame, chunk_bytes: int) -> DataFrame:
    """(file, span, cuts) of (file, row, bytes) rows: per ``LOOKUP_ROWS`` rows of a file the chunks met
    there with their first rows.  A chunk is the rows that start in one stretch of ``chunk_bytes``."""
    part = F.floor(F.col("row") / SUM_ROWS)
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("part", part)
    firsts = (sizes.groupBy("file", "part").agg(F.sum("bytes").alias("n"))
              .select("file", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    at = F.col("first") + F.coalesce(F.sum("bytes").over(inside), F.lit(0))
    return (sizes.join(firsts, ["file", "part"])
            .select("file", "row", F.floor(at / chunk_bytes).alias("k"))
            .groupBy("file", F.floor(F.col("row") / LOOKUP_ROWS).alias("span"), "k").agg(F.min("row").alias("row"))
            .groupBy("file", "span").agg(F.collect_list(F.struct("row", "k")).alias("cuts")))


def chunked(rows: DataFrame, starts: DataFrame, chunk_bytes: int) -> DataFrame:
    """(chunk, id, held_out, text): the rows with their chunk, those of one chunk together."""
    n_spans, n_cuts = starts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("cuts")), F.lit(0))).first()
    small = 32 * n_spans + 16 * n_cuts <= 32 << 20
    row = F.col("row_index")
    k = F.array_max(F.transform(F.filter("cuts", lambda c: c["row"] <= row), lambda c: c["k"]))
    alone = F.when(row_bytes(F.col("text")) > chunk_bytes, row)  # null, which a hash leaves out, otherwise
    out = (rows.withColumn("span", F.floor(row / LOOKUP_ROWS))
           .join(F.broadcast(starts) if small else starts, ["file", "span"])
           .select(F.xxhash64("file", k, alone).alias("chunk"), "id", "held_out", "text"))
    return out if small else out.sortWithinPartitions("chunk")


BLOCKS = "chunk long, bucket int, kind string, keys binary, vals binary"


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)


BLOCK_NAMES = [c.split()[0] for c in BLOCKS.split(", ")]
BLOCK_TYPES = [pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()]


def requests(rows: DataFrame, order: int, buckets: int) -> DataFrame:
    """The blocks of every chunk of (chunk, held_out, text) rows; a chunk's rows may come in pieces."""
    def run(batches):
        chunk, gather = None, None
        for batch in batches:
            held = batch.column("held_out").to_pylist()
            for own, h, text in zip(batch.column("chunk").to_pylist(), held, texts_of(batch)):
                if own != chunk:
                    if gather:
                        yield from sent(chunk, gather)
                    chunk, gather = own, Gather(order)
                gather.add(text, not h)
        if gather:
            yield from sent(chunk, gather)

    def sent(chunk: int, gather: Gather):
        found = [(chunk, *b) for b in gather.blocks(buckets)]
        for at in range(0, len(found), 256):
            yield _batch(found[at:at + 256], BLOCK_NAMES, BLOCK_TYPES)

    return rows.select("chunk", "held_out", "text").mapInArrow(run, BLOCKS)


# ---------------------------------------------------------------------------------- corpus counts

def answer_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """Word blocks with the corpus counts; one row per bucket has its ``tokens`` and ``types``."""
    names, kinds = [*BLOCK_NAMES, "tokens", "types"], [*BLOCK_TYPES, pa.int64(), pa.int64()]

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words = [zlib.decompress(r["keys"]).split(b"\n") for r in rows]
        total: Counter = Counter()
        for own, r in zip(words, rows):
            for w, c in zip(own, unpack_numbers(r["vals"]).tolist()):
                total[w] += c
        seen = [c for c in total.values() if c]
        out = [(r["chunk"], r["bucket"], "w", r["keys"],
                pack_numbers(np.array([total[w] for w in own], np.int64)),
                *((0, 0) if i else (sum(seen), len(seen)))) for i, (own, r) in enumerate(zip(words, rows))]
        return pa.Table.from_batches([_batch(out, names, kinds)])

    return (blocks.where("kind = 'w'").repartition(buckets, "bucket").groupBy("bucket")
            .applyInArrow(run, BLOCKS + ", tokens long, types long"))


def node_counts(blocks: DataFrame, buckets: int) -> DataFrame:
    """(bucket, node, c): every node met, with its count in training documents (0: not seen)."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys, counts = merged([(unpack_nodes(r["keys"]), unpack_numbers(r["vals"])) for r in rows])
        return pa.table({"bucket": pa.array(np.full(len(keys), rows[0]["bucket"], np.int32)),
                         "node": pa.array(keys), "c": pa.array(counts)})

    return (blocks.where("kind = 'n'").repartition(buckets, "bucket").groupBy("bucket")
            .applyInArrow(run, "bucket int, node long, c long"))


def suffix(node: Column, order: int) -> Column:
    """The node one or more orders down: its last ``order + 1`` symbols."""
    return node.bitwiseAND(F.lit((1 << BITS * (order + 1)) - 1).cast("long"))


def context(node: Column) -> Column:
    return F.shiftright(node, BITS)


def bounded(df: DataFrame, symbols: int) -> DataFrame:
    """Broadcast a table keyed by ``symbols`` symbols if that bounds it by 258**2 rows."""
    return F.broadcast(df) if symbols <= 2 else df


def log_probabilities(counts: DataFrame, order: int) -> DataFrame:
    """(bucket, node, lp) for all of (bucket, node, c), by the trie of the nodes with c > 0."""
    seen = {order: counts.where("c > 0").select("node", "c")}
    for j in range(order - 1, -1, -1):
        seen[j] = stored(seen[j + 1].groupBy(suffix(F.col("node"), j).alias("node"))
                         .agg(F.sum("c").alias("c")), f"ppm-nodes-{j}")
    contexts = {}  # per context: t counts, u distinct symbols, x their counts one order down
    for j in range(order + 1):
        rows = seen[j].select(context(F.col("node")).alias("ctx"), "c",
                              *([suffix(F.col("node"), j - 1).alias("low")] if j else []))
        if j:
            low = seen[j - 1].select(F.col("node").alias("low"), F.col("c").alias("x"))
            rows = rows.join(bounded(low, j), "low")
        else:
            rows = rows.withColumn("x", F.lit(0).cast("long"))
        contexts[j] = stored(rows.groupBy("ctx").agg(
            F.sum("c").alias("t"), F.count(F.lit(1)).alias("u"), F.sum("x").alias("x")), f"ppm-contexts-{j}")

    top = counts.withColumn("ctx", context(F.col("node")))
    found = (top.where("c > 0").join(contexts[order].select("ctx", "t"), "ctx")
             .select("bucket", "node", F.log10((2 * F.col("c") - 1) / (2 * F.col("t"))).alias("lp")))

    # not seen after the longest context: escape downwards
    q = (top.where("c = 0").join(contexts[order], "ctx", "left")
         .select("bucket", "node", F.lit(False).alias("done"),
                 F.when(F.col("t").isNull(), 0.0).otherwise(F.log10(F.col("u") / (2 * F.col("t")))).alias("lp"),
                 F.coalesce("x", F.lit(0)).alias("out_t"), F.coalesce("u", F.lit(0)).alias("out_u")))
    for j in range(order - 1, -1, -1):
        own = suffix(F.col("node"), j)
        q = (q.withColumn("own", own).withColumn("ctx", context(F.col("own")))
             .join(bounded(contexts[j], j), "ctx", "left")
             .join(bounded(seen[j].withColumnRenamed("node", "own"), j + 1), "own", "left"))
        t, u = F.col("t") - F.col("out_t"), F.col("u") - F.col("out_u")
        hit = ~F.col("done") & F.col("c").isNotNull()
        q = q.select("bucket", "node", (F.col("done") | F.col("c").isNotNull()).alias("done"),
                     (F.col("lp") + F.when(hit, F.log10((2 * F.col("c") - 1) / (2 * t)))
                      .when(~F.col("done") & (u > 0), F.log10(u / (2 * t))).otherwise(0.0)).alias("lp"),
                     F.coalesce("x", F.lit(0)).alias("out_t"), F.coalesce("u", F.lit(0)).alias("out_u"))
    rest = q.select("bucket", "node", (F.col("lp") - F.when(F.col("done"), 0.0).otherwise(
        F.log10(F.lit(ALPHABET) - F.col("out_u")))).alias("lp"))
    return found.unionByName(rest)


def answer_nodes(blocks: DataFrame, logs: DataFrame, buckets: int) -> DataFrame:
    """Node blocks with the logarithms of their nodes' probabilities."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, lp = right.column("node").to_numpy(), right.column("lp").to_numpy()
        order = np.argsort(names, kind="stable")
        names, lp = names[order], lp[order]
        out = [(r["chunk"], r["bucket"], "n", r["keys"],
                pack_numbers(lp[np.searchsorted(names, unpack_nodes(r["keys"]))])) for r in left.to_pylist()]
        return pa.Table.from_batches([_batch(out, BLOCK_NAMES, BLOCK_TYPES)])

    return (blocks.where("kind = 'n'").repartition(buckets, "bucket").groupBy("bucket")
            .cogroup(logs.repartition(buckets, "bucket").groupBy("bucket")).applyInArrow(run, BLOCKS))


# ---------------------------------------------------------------------------------------- scoring

def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = 5,
           mod: int = 5, held: int = 1, chunk_bytes: int = 24 << 20) -> DataFrame:
    """Per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    if not 1 <= order <= 6:
        raise ValueError("a node of more than seven symbols does not fit 64 bits")
    spark = docs.sparkSession
    rows = with_locator(docs, F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"),
                        (split_remainder(F.col(quoted(id_col)), mod) == held).alias("held_out"))
    rows = rows.select(F.xxhash64(F.substring_index("locator", "#", 1)).alias("file"),
                       F.substring_index("locator", "#", -1).cast("long").alias("row_index"),
                       "id", "held_out", "text")
    sizes = stored(rows.select("file", F.col("row_index").alias("row"), row_bytes(F.col("text")).alias("bytes"),
                               "held_out"), "ppm-sizes")
    n, size, trained = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0)),
                                 F.count_if(~F.col("held_out"))).first()
    size -= ROW_BYTES * n
    rows = chunked(rows, stored(chunk_starts(sizes, chunk_bytes), "ppm-chunks"), chunk_bytes)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // chunk_bytes))

    blocks = stored(requests(rows, order, buckets), "ppm-blocks")
    words = stored(answer_words(blocks, buckets), "ppm-words")
    tokens, types = words.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", "types"))).first()
    n_train, n_types = tokens + trained, types + (trained > 0)  # with the end token
    counts = stored(node_counts(blocks, buckets), "ppm-counts")
    logs = log_probabilities(counts, order)
    answers = words.drop("tokens", "types").unionByName(answer_nodes(blocks, logs, buckets))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known: dict[bytes, int] = {}
        names, logs = [np.zeros(0, np.int64)], [np.zeros(0)]
        for kind, keys, vals in zip(*(right.column(c).to_pylist() for c in ("kind", "keys", "vals"))):
            if kind == "w":
                known.update(zip(zlib.decompress(keys).split(b"\n"), unpack_numbers(vals).tolist()))
            else:
                names.append(unpack_nodes(keys))
                logs.append(unpack_numbers(vals, np.float64))
        name, log = np.concatenate(names), np.concatenate(logs)
        del names[:], logs[:]  # a chunk's nodes are the largest thing a task holds
        lp = Table(name, log)
        del name, log
        below = np.log10(n_train + 0.5 * (n_types + 1))
        out = {c: [] for c in ("n_tokens", "n_known", "base_score", "score")}
        for text in texts_of(left):
            spelt, data = spelled(text)
            tokens, hit, base = 1, int(trained > 0), np.log10(trained + 0.5) - below
            for own in spelt:
                c = np.fromiter(map(known.__getitem__, own), np.int64, len(own))
                tokens, hit = tokens + len(own), hit + int((c > 0).sum())
                base += float((np.log10(c + 0.5) - below).sum())
            out["n_tokens"].append(tokens)
            out["n_known"].append(hit)
            out["base_score"].append(base)
            out["score"].append(sum(float(lp[p].sum()) for p in nodes(data, order)))
        return pa.table({"id": left.column("id"), "held_out": left.column("held_out"),
                         "n_tokens": pa.array(out["n_tokens"], pa.int64()),
                         "n_known": pa.array(out["n_known"], pa.int64()),
                         "train_tokens": pa.array([n_train] * left.num_rows, pa.int64()),
                         "base_score": pa.array(out["base_score"], pa.float64()),
                         "score": pa.array(out["score"], pa.float64())})

    kind = rows.schema["id"].dataType.simpleString()
    return (rows.repartition(buckets, "chunk").groupBy("chunk")
            .cogroup(answers.repartition(buckets, "chunk").groupBy("chunk"))
            .applyInArrow(run, f"id {kind}, held_out boolean, n_tokens long, n_known long, "
                               "train_tokens long, base_score double, score double")
            .withColumnRenamed("id", id_col))
