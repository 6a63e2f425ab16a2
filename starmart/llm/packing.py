"""Best-fit packing of tokenised documents into sequences, by linear grouping.

1. Tasks tokenise whole texts, add the end token and cut only documents longer than a sequence.
2. Spark counts the pieces per length - a histogram of at most ``capacity`` rows, however many
   documents there are - and the driver plans on that histogram alone:
   * large lengths (over ``capacity / small_parts``) are sorted and cut into ``groups`` groups of
     equal cardinality; every length is rounded up to the largest of its group;
   * for these few sizes the configurations of a sequence are optimised: the linear programme over
     all configurations is solved by column generation (a knapsack prices new ones), its solution is
     rounded down and what is left over goes on with the small lengths;
   * the actual lengths of a group are substituted into its slots, largest first, so that sequences
     of one configuration fall into runs with equal free space;
   * the left-over large and the small lengths are placed best-fit, longest first, into those runs.
   This is done for a few settings of the groups and of what counts as large; the best one stands.
   A plan row says: of the pieces of this length, numbers lo to hi go to these sequences, so many
   each, from this offset on.
3. Spark numbers the pieces of each length - in salted partitions, so a length that holds a third of
   all pieces is no hot key - and each piece looks its place up in the plan.

The plan is broadcast; its size depends on ``capacity`` and ``groups`` only: a run is entered again
only with a shorter length than its free space, which at least halves, so there are at most
``log2(capacity)`` rows per run, and each length splits at most one run.

Defined results: a null or empty text is the end token alone; repeated rows are packed each; pieces of
equal length are interchangeable, so a rerun may number the sequences otherwise; a text of any length is
read whole, in pieces of ``capacity``; an empty table gives an empty result; columns other than the id and
the text are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_batches, quoted, stored, texts_of

CACHE_WORDS = 400_000
#: (groups, small_parts) to plan with; the plan of fewest sequences is taken
SETTINGS = ((64, 8), (128, 4), (256, 3))


# ------------------------------------------------------------------------------------ tokenising

#: white space to a space and A-Z to a-z: the tokenizer's own normaliser does both
FOLD = bytes.maketrans(b"\t\n\x0b\x0c\r" + bytes(range(65, 91)), b" " * 5 + bytes(range(97, 123)))
#: what byte-level tokenizers write for the bytes of ``plain`` words that are no printable characters
SHOWN = (("\x9f", "\u0141"), ("\xa0", "\u0142"), ("\xad", "\u0143"))
SAMPLE = b"the words a \xc3\xa0 \xc3\xad stra\xc3\x9fe \xc3\xa9t\xc3\xa9 \xc3\xbe\xc3\xbf \xc3\xb1and\xc3\xba"
#: words of printable ASCII and Latin-1 letters (two bytes in UTF-8), and what they are split into:
#: contractions, letters, single digits, runs of other marks
LETTER = rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])"
LATIN = re.compile(rb"(?:[\x21-\x7e]|" + LETTER + rb")+")
SPLIT = re.compile(rb"'(?:s|t|re|ve|m|ll|d)|" + LETTER + rb"+|[0-9]|[\x21-\x2f\x3a-\x60\x7b-\x7e]+")


def stops_apart(text: np.ndarray) -> np.ndarray:
    """Where a folded text has a full stop or comma between a letter and a space or its end: a token of
    its own."""
    at = np.flatnonzero((text == 46) | (text == 44))
    before, after = text[np.maximum(at, 1) - 1], text[np.minimum(at + 1, len(text) - 1)]
    return at[(at > 0) & (before >= 97) & (before <= 122) & ((after == 32) | (at + 1 == len(text)))]


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` at ``starts``, ``lengths`` long, one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - (ends - lengths), lengths) + np.arange(lengths.sum())]


def bytes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, lengths and bytes (with eight zeros after) of words."""
    marks = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = words.buffers()[2]
    data = np.frombuffer(data, np.uint8)[:marks[-1]] if data is not None else np.zeros(0, np.uint8)
    return marks[:-1], np.diff(marks), np.concatenate([data, np.zeros(8, np.uint8)])


def hashed(words: pa.Array) -> np.ndarray:
    """A number of each word from its length, its first 64 and its last 8 bytes."""
    starts, lengths, data = bytes_of(words)
    eights = np.ndarray(max(len(data) - 7, 0), "<u8", data, strides=(1,))
    out = lengths.astype(np.uint64)
    on = np.arange(len(words))

    def more(on: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        part = eights[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * (8 - n)).astype(np.uint64))
        x = (out[on] ^ part) * np.uint64(0x9E3779B97F4A7C15)
        out[on] = x ^ (x >> np.uint64(29))

    for k in range(0, 64, 8):
        on = on[lengths[on] > k]
        if not len(on):
            break
        more(on, starts[on] + k, np.minimum(lengths[on] - k, 8))
    on = on[lengths[on] > 64]
    more(on, starts[on] + lengths[on] - 8, np.full(len(on), 8))
    return out


def plain(words: pa.Array) -> np.ndarray:
    """Which words are lower-case ASCII and Latin-1 letters only: the tokenizer takes them as they are."""
    starts, lengths, data = bytes_of(words)
    second = (data >= 0x9F) & (data <= 0xBF) & (data != 0xB7)
    pair = (data[:-1] == 0xC3) & second[1:]
    good = (data >= 97) & (data <= 122)
    good[:-1] |= pair
    good[1:] |= pair
    count = np.concatenate([[0], np.cumsum(good)])
    return (count[starts + lengths] - count[starts] == lengths) & (lengths > 0)


class WordIds:
    """Words and their ids in flat arrays, some 60 bytes a word, found by a sorted number of each.

    A word found is compared whole; of different words with one number only one is found, the others
    are met as new each time.
    """

    def __init__(self):
        self.words = pa.array([], pa.large_binary())
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, "<u4")
        self.numbers, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.words)

    def find(self, words: pa.Array) -> np.ndarray:
        """The places of words, -1 for those not here."""
        out = np.full(len(words), -1)
        if len(self) and len(words):
            numbers = hashed(words)
            order = np.argsort(numbers)
            at = np.searchsorted(self.numbers, numbers[order])
            at[at == len(self)] = 0
            hit = self.numbers[at] == numbers[order]
            asked, at = order[hit], self.places[at[hit]]
            same = pc.equal(words.take(asked), self.words.take(at)).to_numpy(zero_copy_only=False)
            out[asked[same]] = at[same]
        return out

    def add(self, words: pa.Array, lengths: np.ndarray, flat: np.ndarray) -> None:
        numbers = hashed(words)
        order = np.argsort(numbers)
        at = np.searchsorted(self.numbers, numbers[order])
        self.numbers = np.insert(self.numbers, at, numbers[order])
        self.places = np.insert(self.places, at, (len(self) + order).astype(np.int32))
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.words = pa.concat_arrays([self.words, words])
        self.starts = np.concatenate([self.starts, starts])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.flat = np.concatenate([self.flat, flat])

    def ids(self, at: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.starts[at], self.lengths[at])


class WordTokenizer:
    """Token ids of whole texts, word by word.

    For tokenizers that lower-case, split at white space and drop it, and split letters from
    punctuation: there the ids of a text are those of its words one after the other, so the distinct
    words of a slice are looked up among those met before, and a word with marks in it is put together
    from its parts.  Two generations of words are kept: the younger takes what is used, and when it holds
    half of ``CACHE_WORDS`` it becomes the older one, so words in use stay.  Special-token strings count
    where the raw text has them exactly; folded words are encoded as plain text.  Words of plain letters
    go straight to the tokenizer's model, without its normaliser and splitter, if a sample shows that
    these leave them as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content.encode(): i for i, t in self.tokenizer.get_added_tokens_decoder().items() if t.special}
        self.special = re.compile(b"(" + b"|".join(map(re.escape, sorted(special, key=len, reverse=True))) + b")") \
            if special else None
        self.special_ids = {t: np.array([i], "<u4") for t, i in special.items()}
        self.cache, self.old = WordIds(), WordIds()
        n = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(n)])
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        if self._plain(SAMPLE.split()).tolist() != self._encode([SAMPLE.decode()])[0].tolist():
            self.model = None

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        self.tokenizer.encode_special_tokens = True  # as plain text: ``ids`` finds the special ones
        try:
            return [np.array(e.ids, "<u4")
                    for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        finally:
            self.tokenizer.encode_special_tokens = False

    def _plain(self, words: list[bytes]) -> np.ndarray:
        """The ids of words that are ``plain`` one after the other."""
        text = b" ".join(words)
        if self.model is None:
            return self._encode([text.decode()])[0]
        text = text.decode("latin-1")
        for byte, shown in SHOWN:
            text = text.replace(byte, shown)
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[bytes]) -> None:
        """Add words to the younger generation, in their order."""
        lengths = np.zeros(len(words), np.int64)
        order, found = [], []  # places of words, their ids

        def joined(places: list[int], encode) -> list[int]:
            """Words of letters only, many at once; those of a run whose ends do not tell them are left."""
            left = []
            for k in range(0, len(places), 4096):
                own = places[k:k + 4096]
                ids = encode([words[i] for i in own])
                ends = np.flatnonzero(self.ends[ids]) + 1  # letters only: each word ends once
                if len(ends) != len(own):
                    left += own
                    continue
                lengths[own] = np.diff(ends, prepend=0)
                order.extend(own)
                found.append(ids)
            return left

        array = pa.array(words, pa.large_binary())
        simple = plain(array)
        rest = np.flatnonzero(~simple).tolist() + joined(np.flatnonzero(simple).tolist(), self._plain)
        text = {i: words[i].decode("utf-8", "replace") for i in rest}
        letters = [i for i in rest if text[i].isalpha()]
        rest = [i for i in rest if not text[i].isalpha()]
        rest += joined(letters, lambda own: self._encode([b" ".join(own).decode("utf-8", "replace")])[0])
        parts = {i: SPLIT.findall(words[i]) for i in rest if LATIN.fullmatch(words[i])}
        parts = {i: own for i, own in parts.items() if len(own) > 1}
        rest = [i for i in rest if i not in parts]
        for i, ids in zip(rest, self._encode([text[i] for i in rest])):
            lengths[i] = len(ids)
            order.append(i)
            found.append(ids)
        if parts:
            flat = pa.array(chain.from_iterable(parts.values()), pa.large_binary()).dictionary_encode()
            at = self._known(flat.dictionary)[flat.indices.to_numpy()]
            marks = np.cumsum([0, *map(len, parts.values())])
            own = np.cumsum(np.concatenate([[0], self.cache.lengths[at]]))[marks]
            lengths[list(parts)] = np.diff(own)
            order += parts
            found.append(self.cache.ids(at))
        starts = np.zeros(len(words), np.int64)
        starts[order] = np.cumsum(lengths[order]) - lengths[order]
        self.cache.add(array, lengths,
                       gathered(np.concatenate(found), starts, lengths) if found else np.zeros(0, "<u4"))

    def _known(self, words: pa.Array) -> np.ndarray:
        """The places of distinct words in the younger generation, where those of the older one and new ones
        are added."""
        at = self.cache.find(words)
        gaps = np.flatnonzero(at < 0)
        before = self.old.find(words.take(gaps))
        used, known = before[before >= 0], gaps[before >= 0]
        if len(used):
            at[known] = len(self.cache) + np.arange(len(used))
            self.cache.add(words.take(known), self.old.lengths[used], self.old.ids(used))
        gaps = gaps[before < 0]
        if len(gaps):
            self._learn(words.take(gaps).to_pylist())
            at[gaps] = len(self.cache) - len(gaps) + np.arange(len(gaps))
        return at

    def _ids(self, raws: list[bytes]) -> list[np.ndarray]:
        """The ids of texts, special-token strings as plain text."""
        text = np.frombuffer(b" ".join([*raws, b""]).translate(FOLD), np.uint8)
        stops = stops_apart(text)
        marks = np.cumsum([0, *(len(r) + 1 for r in raws)])
        marks = marks + np.searchsorted(stops, marks)
        folded = np.insert(text, stops, 32)
        split = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(
            len(raws), pa.py_buffer(marks.astype(np.int64)), pa.py_buffer(folded)))
        words = split.values.cast(pa.large_binary()).dictionary_encode()
        at = self._known(words.dictionary)[words.indices.to_numpy()]
        ids = self.cache.ids(at)
        own = np.concatenate([[0], np.cumsum(self.cache.lengths[at])])[split.offsets.to_numpy()]
        return [ids[a:b] for a, b in zip(own, own[1:])]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Little-endian unsigned 32-bit ids of each text."""
        if len(self.cache) > CACHE_WORDS // 2:
            self.old, self.cache = self.cache, WordIds()
        raws = [t.encode("utf-8", "replace") for t in texts]
        if self.special is None or not any(map(self.special.search, raws)):
            return self._ids(raws)
        parts = [self.special.split(r) for r in raws]
        plain = iter(self._ids([p for own in parts for p in own[::2]]))
        return [np.concatenate([self.special_ids[p] if k % 2 else next(plain) for k, p in enumerate(own)])
                for own in parts]

    def rest(self) -> None:
        """Give the older generation up: a worker between tasks keeps the words in use only."""
        self.old = WordIds()


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for a file (loaded once per Python worker)."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def slices(texts: list[str], size: int = 1 << 20):
    """The texts in runs of at most ``size`` characters (or one text), to bound memory."""
    at = held = 0
    for i, t in enumerate(texts):
        if i > at and held + len(t) > size:
            yield texts[at:i]
            at, held = i, 0
        held += len(t)
    yield texts[at:]


def pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, capacity: int = 4096,
           end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]): every document's pieces of <= capacity tokens."""
    slim = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text"))
    id_type = slim.schema["id"].dataType.simpleString()
    ddl = f"id {id_type}, piece int, start long, length long, ids_crc32 long"
    end = np.array([end_id], "<u4")

    def run(batch: pa.RecordBatch) -> dict:
        tok = tokenizer(vocabulary)
        rows, piece, start, length, crc, ids = [], [], [], [], [], []
        i = 0
        for part in slices(texts_of(batch)):
            for found in tok.ids(part):
                whole = np.concatenate([found, end])
                for k, at in enumerate(range(0, len(whole), capacity)):
                    own = whole[at:at + capacity]
                    rows.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
                    if with_ids:
                        ids.append(own.astype(np.int32))
                i += 1
        out = {"id": batch.column("id").take(pa.array(rows, pa.int64())), "piece": piece,
               "start": start, "length": length, "ids_crc32": crc}
        return out | ({"ids": ids} if with_ids else {})

    return map_batches(slim, run, ddl + (", ids array<int>" if with_ids else ""),
                       done=lambda: tokenizer(vocabulary).rest(), sliced=True)


# -------------------------------------------------------------------------------------- planning

def best_configuration(sizes: list[int], worth: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The configuration (how often each size) of the largest worth that fits: a bounded knapsack."""
    best = np.zeros(capacity + 1)
    took = []  # per step: where one more of the size is better
    for g, (size, w) in enumerate(zip(sizes, worth)):
        for _ in range(capacity // size if w > 1e-12 else 0):
            more = np.full(capacity + 1, -1.0)
            more[size:] = best[:-size] + w
            better = more > best + 1e-12
            if not better.any():
                break
            took.append((g, size, better))
            best = np.where(better, more, best)
    config, room = np.zeros(len(sizes), int), capacity
    for g, size, better in reversed(took):
        if better[room]:
            config[g] += 1
            room -= size
    return config, float(best[capacity])


def configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """(configuration, sequences) covering at most ``counts``: the linear programme, rounded down.

    Column generation with the revised simplex, to the optimum; the start basis has one size per
    configuration.  A configuration that comes back while the objective stands still would go round
    for ever (a degenerate basis): there the programme is as good as it gets.
    """
    m = len(sizes)
    demand = np.array(counts, float)
    basis = np.diag([float(capacity // s) for s in sizes])
    amount = demand / np.diag(basis)
    least, idle = np.inf, set()
    while True:
        worth = np.linalg.solve(basis.T, np.ones(m))
        config, value = best_configuration(sizes, worth, capacity)
        if value <= 1 + 1e-9:
            break
        if amount.sum() < least - 1e-9:
            least = amount.sum()
            idle.clear()
        if config.tobytes() in idle:
            break
        idle.add(config.tobytes())
        step = np.linalg.solve(basis, config.astype(float))
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        amount = np.maximum(amount - ratio[out] * step, 0)
        amount[out] = ratio[out]
        basis[:, out] = config
    chosen = [(basis[:, k].astype(int), int(np.floor(amount[k] + 1e-6))) for k in range(m)]
    left = np.array(counts)
    out = []
    for config, n in chosen:
        used = config > 0
        n = min([n, *(left[used] // config[used])]) if used.any() else 0
        if n > 0:
            left = left - n * config
            out.append((config, int(n)))
    return out


def plan(histogram: dict[int, int], capacity: int = 4096, groups: int = 48, small_parts: int = 16
         ) -> tuple[list[tuple], int]:
    """Plan rows (length, lo, hi, first sequence, per sequence, offset) and the number of sequences.

    Pieces ``lo <= number < hi`` of a length go to the sequences from ``first`` on, ``per`` to each,
    the k-th of a sequence at ``offset + k * length``.
    """
    taken = dict.fromkeys(histogram, 0)  # pieces placed so far, per length
    rows, sequences = [], 0
    runs: list[tuple[int, int, int]] = []  # (free space, first sequence, sequences), sorted

    def give(length: int, n: int, first: int, per: int, offset: int) -> None:
        rows.append((length, taken[length], taken[length] + n, first, per, offset))
        taken[length] += n

    # linear grouping of the large lengths, largest first
    large = [(s, histogram[s]) for s in sorted(histogram, reverse=True)
             if s * small_parts > capacity and histogram[s] > 0]
    total = sum(n for _, n in large)
    share, queues, sizes = -(-total // groups) if total else 1, [], []
    for s, n in large:
        while n:
            if not queues or sum(k for _, k in queues[-1]) >= share:
                queues.append([])
                sizes.append(s)  # the largest of its group
            k = min(n, share - sum(k for _, k in queues[-1]))
            queues[-1].append((s, k))
            n -= k

    # few sizes: optimise the configurations, then substitute the actual lengths run by run
    counts = [sum(k for _, k in q) for q in queues]
    for config, n in configurations(sizes, counts, capacity) if queues else []:
        slots = [g for g in range(len(sizes)) for _ in range(config[g])]
        start = sequences
        sequences += n
        cuts = {0, n}
        filled = []  # per slot: (from, to, length) over the n sequences
        for g in slots:
            at, own = 0, []
            while at < n:
                s, k = queues[g][0]
                use = min(k, n - at)
                own.append((at, at + use, s))
                queues[g][0] = (s, k - use)
                if k == use:
                    queues[g].pop(0)
                at += use
                cuts.add(at)
            filled.append(own)
        marks = sorted(cuts)
        for a, b in zip(marks, marks[1:]):
            used = 0
            for own in filled:
                s = next(s for x, y, s in own if x <= a < y)
                give(s, b - a, start + a, 1, used)
                used += s
            runs.append((capacity - used, start + a, b - a))

    # best fit, longest first: what the rounding left over, and the small lengths
    runs.sort()
    for s in sorted(histogram, reverse=True):
        n = histogram[s] - taken[s]
        while n > 0:
            at = bisect_left(runs, (s, -1, -1))
            if at == len(runs):  # no room: open as many sequences as these pieces need
                per = capacity // s
                runs.append((capacity, sequences, -(-n // per)))
                sequences += -(-n // per)
            free, first, width = runs.pop(at)
            per, offset = free // s, capacity - free
            full = min(width, n // per)
            if full:
                give(s, full * per, first, per, offset)
                insort(runs, (free - per * s, first, full))
                n -= full * per
            if n and full < width:  # the last, partly filled sequence
                give(s, n, first + full, n, offset)
                insort(runs, (free - n * s, first + full, 1))
                full, n = full + 1, 0
            if full < width:
                insort(runs, (free, first + full, width - full))
    return rows, sequences


# --------------------------------------------------------------------------------------- placing

def numbered(found: DataFrame, salt_count: int) -> DataFrame:
    """Stored pieces with ``number``: 0, 1, ... within each length, counted in salted partitions.  The
    salt is that of a row's place (file and row number), so repeated rows are spread as well."""
    meta = found.metadataColumn("_metadata")
    placed = found.withColumns({"file": F.xxhash64(meta["file_path"]), "row": meta["row_index"]})
    salted = placed.withColumn("salt", F.pmod(F.xxhash64("file", "row"), F.lit(salt_count)).cast("int"))
    order = Window.partitionBy("length", "salt").orderBy("file", "row")
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    return (salted.withColumn("place", F.row_number().over(order)).join(starts, ["length", "salt"])
            .withColumn("number", F.col("first") + F.col("place") - 1)
            .drop("salt", "place", "first", "file", "row"))


def best_plan(histogram: dict[int, int], capacity: int = 4096,
              settings: tuple[tuple[int, int], ...] = SETTINGS) -> tuple[list[tuple], int]:
    """The plan of fewest sequences among the (groups, small_parts) settings."""
    return min((plan(histogram, capacity, *s) for s in settings), key=lambda p: p[1])


def pack(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 4096, end_id: int = 1,
         settings: tuple[tuple[int, int], ...] = SETTINGS, salt_count: int = 64) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    found = stored(pieces(docs, id_col, text_col, vocabulary, capacity, end_id), "pack-pieces")
    counts = found.groupBy("length").count().collect()  # at most ``capacity`` rows
    rows, _ = best_plan({r["length"]: r["count"] for r in counts}, capacity, settings)
    table = np.array(sorted(rows), np.int64).reshape(-1, 6)
    lo = table[:, 0] * (1 << 48) + table[:, 1]  # one sorted key of length and first number
    shared = docs.sparkSession.sparkContext.broadcast((lo, table))
    kinds = found.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        keys, plan_rows = shared.value
        length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
        at = plan_rows[np.searchsorted(keys, length * (1 << 48) + number, side="right") - 1]
        nth = number - at[:, 1]
        same = {c: batch.column(c) for c in ("id", "piece", "start", "length", "ids_crc32")}
        return same | {"sequence_id": pa.array(at[:, 3] + nth // at[:, 4]),
                       "offset": pa.array(at[:, 5] + nth % at[:, 4] * length)}

    out = map_batches(numbered(found, salt_count), run,
                      f"id {kinds}, piece int, start long, length long, ids_crc32 long, "
                      "sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
