"""Fill-in-the-middle: cut texts in prefix, middle and suffix, and write them in another order.

A text is valid UTF-8 bytes.  Cuts are wanted in units of tokens or code points, but a text is cut in
bytes.  :class:`Exceptions` is a sparse index between the two: it records only the multibyte characters
- the code point each stands at, and the excess bytes (its bytes less one) of all before it.  Between two
of them lies ASCII, where a code point is a byte, so a position is converted by one ``searchsorted`` and
one addition; a text without exceptions needs no index at all.

Tokens are runs of ASCII letters and all other single characters.  They are counted in blocks of bytes,
and a cut is looked up in the one block that holds it, however long the text is.

A document's draws are four numbers from the SHA-256 of a seed and its id, so a rerun, a lost executor or
another partitioning gives the same cuts.  No shuffle; each document is a row of its own.

Defined results: a null or empty text has no tokens and stays plain; bytes that are no UTF-8 count as
U+FFFD; a null id draws as the empty text; repeated rows are cut alike (ties do not exist: equal cuts give
an empty middle); an empty table gives an empty result; columns of the table other than the id and the
text are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, quoted

# fixed values: the markers of the parts
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKERS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
BLOCK = 1 << 20


class Exceptions:
    """The multibyte characters of a UTF-8 text: code-point positions and excess bytes before each."""

    def __init__(self, data: np.ndarray):
        lead = np.flatnonzero(data >= 0xC0)
        first = data[lead]
        excess = 1 + (first >= 0xE0) + (first >= 0xF0).astype(np.int64)
        self.before = np.concatenate(([0], np.cumsum(excess)))
        self.at = lead - self.before[:-1]
        self.lead = lead
        self.n_chars = len(data) - int(self.before[-1])

    def to_byte(self, char: int) -> int:
        """The byte that the code point ``char`` starts at."""
        return char + int(self.before[np.searchsorted(self.at, char)]) if len(self.at) else char

    def to_char(self, byte: int) -> int:
        """The code point that starts at ``byte``."""
        return byte - int(self.before[np.searchsorted(self.lead, byte)]) if len(self.at) else byte


def token_starts(data: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """For the bytes from lo to hi: does a token start there?"""
    part = data[max(0, lo - 1):hi]
    letter = ((part | 0x20) - np.uint8(97)) < 26
    start = (part & 0xC0) != 0x80
    start[1:] &= ~(letter[1:] & letter[:-1])
    return start[lo - max(0, lo - 1):]


class Tokens:
    """The number of tokens of a text, and the bytes they start at."""

    def __init__(self, data: np.ndarray, block: int = BLOCK):
        self.data, self.block = data, block
        counts = [np.count_nonzero(token_starts(data, i, min(i + block, len(data))))
                  for i in range(0, len(data), block)]
        self.until = np.cumsum([0, *counts])
        self.n = int(self.until[-1])

    def to_byte(self, token: int) -> int:
        if token >= self.n:
            return len(self.data)
        b = int(np.searchsorted(self.until, token, side="right")) - 1
        lo = b * self.block
        inside = token_starts(self.data, lo, min(lo + self.block, len(self.data)))
        return lo + int(np.flatnonzero(inside)[token - self.until[b]])


def parts(data: bytes, h1: int, h2: int, unit: str = "token") -> tuple[int, int, int, int, int]:
    """(units, bytes of the prefix, bytes up to the middle's end, code points of the prefix, of the
    middle): the cuts are the smaller and the larger of two draws among the n + 1 places."""
    raw = np.frombuffer(data, np.uint8)
    index = Exceptions(raw)
    if unit == "token":
        tokens = Tokens(raw)
        n, to_byte = tokens.n, tokens.to_byte
    else:
        n, to_byte = index.n_chars, index.to_byte
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = to_byte(low), to_byte(high)
    before = index.to_char(a)
    return n, a, b, before, index.to_char(b) - before


def transform(data: bytes, draws: tuple[int, int, int, int], unit: str = "token", fim_percent: int = 90,
              spm_percent: int = 20) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of the prefix and of the middle, the text in its new order)."""
    h1, h2, h3, h4 = draws
    n, a, b, prefix, middle = parts(data, h1, h2, unit)
    if not data or h3 % 100 >= fim_percent or any(m in data for m in MARKERS):
        return n, "plain", None, None, data
    p, s, m = MARKERS
    if h4 % 100 < spm_percent:
        return n, "spm", prefix, middle, b"".join((s, data[b:], p, data[:a], m, data[a:b]))
    return n, "psm", prefix, middle, b"".join((p, data[:a], s, data[b:], m, data[a:b]))


def draws(id_col: Column, seed: str) -> Column:
    """Four unsigned 32-bit numbers of a document: the first groups of the SHA-256 of seed and id."""
    text = F.concat(F.lit(seed), F.coalesce(id_col.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)])


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: str = "1:",
                   unit: str = "token", fim_percent: int = 90, spm_percent: int = 20) -> DataFrame:
    """Per document: id, ``n`` (its units), ``form`` (plain, psm or spm), ``prefix_chars`` and
    ``middle_chars`` (code points; null if plain) and the ``output`` text.

    ``unit`` is ``token`` or ``char``.  Of 100 documents about ``fim_percent`` are cut, ``spm_percent``
    of these with the suffix in front; empty texts and texts that hold a marker stay plain.
    """
    if unit not in ("token", "char"):
        raise ValueError(f"unit {unit!r}")
    key = F.col(quoted(id_col))
    text = F.make_valid_utf8(F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")))
    slim = docs.select(key.alias("id"), text.cast("binary").alias("text"), draws(key, seed).alias("h"))
    id_type = slim.schema["id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> dict:
        found = [transform(t, tuple(h), unit, fim_percent, spm_percent)
                 for t, h in zip(batch.column("text").to_pylist(), batch.column("h").to_pylist())]
        n, form, prefix, middle, output = zip(*found)
        return {"id": batch.column("id"), "n": n, "form": form, "prefix_chars": prefix,
                "middle_chars": middle, "output": pa.array(output, pa.binary())}

    ddl = f"id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return map_batches(slim, run, ddl).withColumnRenamed("id", id_col)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of, from the output and its form alone."""
    piece = F.split(output, "<[PSM]>", -1)
    a, b, c = (F.get(piece, F.lit(k)) for k in (1, 2, 3))
    return (F.when(form == "psm", F.concat(a, c, b)).when(form == "spm", F.concat(b, c, a))
            .otherwise(output))
