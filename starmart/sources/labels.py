"""Label files: blocks of ``value [$]name  code = 'label' ... ;`` (code lists).

Parsing is a Spark job, not a driver-side string loop.  Files are cut at every ``;`` by the text source,
which splits one large file over many tasks; comments may hold such marks and reach over the cuts and over
the ranges that tasks read, so whether a piece starts inside a comment is carried from piece to piece
by the task that reads a range, and from range to range of a file (:func:`read_blocks`).  Each block then yields its
``code = 'label'`` pairs by ``regexp_extract_all`` + ``explode``.  Any path Spark can read works (object
stores included).
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# tasks get this module's functions themselves: label files are read without the package on the executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Grammar of the label file (fixed patterns).
COMMENT = r"(?s)/\*.*?\*/"
BLOCK = r"(?is)\bvalue\s+\$?\w+[^;]*;"
BLOCK_NAME = r"(?i)value\s+\$?(\w+)"
BLOCK_HEAD = r"(?i)^\s*value\s+\$?\w+"
PAIR = r"('(?:[^']|'')*'|[^\s'=;]+)\s*=\s*'((?:[^']|'')*)'"

#: the four code lists the star schema uses (fixed names in the label file)
COUNTRY_FORMAT = "i94cntyl"
PORT_FORMAT = "i94prtl"
MODE_FORMAT = "i94model"
STATE_FORMAT = "i94addrl"


def parse_formats(text: DataFrame, column: str = "value") -> DataFrame:
    """``(fmt, code, label)`` rows from a DataFrame whose ``column`` holds label-file text.

    Quotes are removed from codes and labels (a doubled quote inside a label disappears, as in
    the reference output), both are trimmed, and ``fmt`` is lower-cased.  Lines with ``=`` in
    comments or outside a block are ignored.
    """
    body = F.regexp_replace(F.col(column), COMMENT, " ")
    blocks = text.select(F.explode(F.regexp_extract_all(body, F.lit(BLOCK), 0)).alias("block"))
    pairs = blocks.select(
        F.lower(F.regexp_extract("block", BLOCK_NAME, 1)).alias("fmt"),
        F.explode(F.regexp_extract_all(F.regexp_replace("block", BLOCK_HEAD, ""),
                                       F.lit(PAIR), 0)).alias("pair"),
    )
    code = F.regexp_extract("pair", PAIR, 1)
    label = F.regexp_extract("pair", PAIR, 2)
    return pairs.select(
        "fmt",
        F.trim(F.regexp_replace(code, "'", "")).alias("code"),
        F.trim(F.regexp_replace(label, "'", "")).alias("label"),
    )


def read_formats(spark: SparkSession, path: str) -> DataFrame:
    """Parse every label file under ``path``, large ones in several tasks."""
    return parse_formats(read_blocks(spark, path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The text between two ``;`` outside comments, one row ``value`` each, comments taken out.

    A comment that is never closed hides the rest of its file, and what follows the last ``;`` counts as a
    block too.  Every task goes through the ranges of files it reads from their first byte to their last,
    twice: first to see how each range ends, then, knowing how it starts, for its blocks.  The text itself is
    not shuffled; of a range only its ends and the blocks cut there by a comment are.  A task holds one batch
    and one block.
    """
    pieces = spark.read.option("lineSep", ";").text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"))
    ends = pieces.mapInArrow(_range_ends, "file string, start long, ends0 int, ends1 int, "
                                          "open0 binary, open1 binary, tail binary")
    # what a range does to "inside a comment": sets it, turns it around (as /*/ does), or leaves it
    ranges = _carry(ends.withColumns({
        "sets": F.when(F.col("ends0") == F.col("ends1"), F.col("ends0")),
        "turns": F.when((F.col("ends0") == 1) & (F.col("ends1") == 0), 1).otherwise(0)}), ["file"], "start")
    ranges = ranges.withColumn("inside", _inside(F.lit(0)))
    # few: the first range of a file never starts inside
    inside = F.broadcast(ranges.where("inside = 1").select("file", "start", "inside"))
    whole = pieces.join(inside, ["file", "start"], "left").select("value", "file", "start", "inside")
    blocks = whole.mapInArrow(_range_blocks, "value binary").unionByName(_stitched(ranges))
    return blocks.select(F.concat(F.col("value").cast("string"), F.lit(";")).alias("value"))


_COMMENT = re.compile(rb"(?s)/\*.*?\*/")
#: text taken up at a time
_PART_BYTES = 4 << 20


def _seen(text: bytes, inside: bool) -> tuple[bytes, bool]:
    """``text`` without its comments (a blank each), and whether it ends inside one."""
    if inside:
        close = text.find(b"*/")
        if close < 0:
            return b"", True
        text = text[close + 2:]
    text = _COMMENT.sub(b" ", text)
    at = text.find(b"/*")
    return (text, False) if at < 0 else (text[:at] + b" ", True)


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, bytes]]:
    """(file, start, inside at the start, text): the pieces of a range in parts, each closed by ``;``."""
    for batch in batches:
        n, value, file, start = batch.num_rows, *(batch.column(c) for c in ("value", "file", "start"))
        if not n:
            continue
        new = pc.or_(pc.not_equal(file[1:], file[:-1]), pc.not_equal(start[1:], start[:-1]))
        cuts = np.r_[0, np.flatnonzero(new.to_numpy(zero_copy_only=False)) + 1, n]
        rows = max(1, n * _PART_BYTES // max(1, value.nbytes))
        for a, b in zip(cuts, cuts[1:]):
            inside = "inside" in batch.schema.names and batch.column("inside")[a].as_py() == 1
            key = file[a].as_py(), start[a].as_py(), inside
            for at in range(a, b, rows):
                yield *key, b";".join(value[at:min(b, at + rows)].to_pylist()) + b";"


def _range_ends(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range, for one that starts outside comments (0) and one that starts inside (1): whether it ends
    inside a comment, and the block left open; ``tail``: of the latter, what ends the block begun before."""
    for (file, start), parts in groupby(_texts(batches), lambda x: x[:2]):
        ends, left, tail = [False, True], [b"", b""], None
        for *_, text in parts:
            alike = tail is not None and (ends[0], left[0]) == (ends[1], left[1])  # from here on
            for k in (0,) if alike else (0, 1):
                seen, ends[k] = _seen(text, ends[k])
                first, mark, rest = (left[k] + seen).partition(b";")
                left[k] = rest.rpartition(b";")[2] if mark else first
                if k and mark and tail is None:
                    tail = first
            if alike:
                ends[1], left[1] = ends[0], left[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array([file]), pa.array([start], pa.int64()), *(pa.array([int(e)], pa.int32()) for e in ends),
             *(pa.array([x], pa.binary()) for x in (*left, tail))],
            names=["file", "start", "ends0", "ends1", "open0", "open1", "tail"])


def _range_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blocks that begin and end in one range."""
    for (*_, begun), parts in groupby(_texts(batches), lambda x: x[:3]):
        inside, left = begun, b""  # begun: a block of an earlier range may end here
        for *_, text in parts:
            seen, inside = _seen(text, inside)
            *blocks, left = (left + seen).split(b";")
            if begun and blocks:
                del blocks[0]
                begun = False
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.binary())], names=["value"])


def _carry(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Carry a flag along the rows, each of which sets (``sets`` 0 or 1), turns (``turns`` 1) or leaves it:
    ``known``, the value set last before the row, if any, with the parity of the turns up to there."""
    w = Window.partitionBy(*by).orderBy(order)
    df = df.withColumn("turned", F.sum("turns").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    df = df.withColumn("_value", (F.col("sets") + F.col("turned")) % 2)
    return df.withColumn("known", F.last("_value", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))


def _inside(at_first: Column) -> Column:
    """The flag before a row of :func:`_carry`, given its value before the first row."""
    return (F.coalesce(F.col("known"), at_first) + F.col("turned") - F.col("turns")) % 2


def _stitched(ranges: DataFrame) -> DataFrame:
    """Blocks that a comment carries from one range into others: from the range that leaves one open, over
    those without a ``;`` outside comments, to the one that ends it."""
    def part(value: str, head: int) -> Column:
        return F.struct(F.lit(head).alias("head"), F.col(value).alias("value"))

    parts = (F.when(F.col("inside") == 0, F.when(F.col("ends0") == 1, F.array(part("open0", 1))))
             .when(F.col("tail").isNull(), F.array(part("open1", 0)))
             .when(F.col("ends1") == 1, F.array(part("tail", 0), part("open1", 1)))
             .otherwise(F.array(part("tail", 0))))
    parts = ranges.select("file", "start", F.posexplode(parts).alias("pos", "part"))
    upto = Window.partitionBy("file").orderBy("start", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = parts.withColumn("block", F.sum("part.head").over(upto))
    own = F.array_sort(F.collect_list(F.struct("start", "pos", F.col("part.value").cast("string").alias("value"))))
    return parts.groupBy("file", "block").agg(
        F.concat_ws("", F.transform(own, lambda p: p["value"])).cast("binary").alias("value")).select("value")


def code_list(formats: DataFrame, fmt: str, code: str = "code", label: str = "label"
              ) -> DataFrame:
    """The pairs of one format as ``(code, label)`` renamed."""
    return (formats.filter(F.col("fmt") == fmt.lower())
            .select(F.col("code").alias(code), F.col("label").alias(label)))


def render_block(fmt: str, code: Column, label: Column, quoted: bool) -> Column:
    """Label-file text of a one-pair block: ``value [$]fmt`` / ``code = 'label'`` / ``;``.

    Quotes inside codes and labels are doubled, as the format requires.
    """
    def esc(c: Column) -> Column:
        return F.replace(c.cast("string"), F.lit("'"), F.lit("''"))

    code_txt = F.concat(F.lit("'"), esc(code), F.lit("'")) if quoted else code.cast("string")
    head = f"  value {'$' if quoted else ''}{fmt}\r\n   "
    return F.concat(F.lit(head), code_txt, F.lit("\t=\t'"), esc(label), F.lit("'\r\n;\r\n"))


#: blocks per rendered file; each file is read back as one row, so this bounds the row size
MAX_BLOCKS_PER_FILE = 100_000


def write_formats(df: DataFrame, path: str, fmt: str, code: str, label: str,
                  quoted: bool = True, mode: str = "append",
                  max_blocks_per_file: int = MAX_BLOCKS_PER_FILE) -> None:
    """Write ``(code, label)`` rows of ``df`` as label-file text, one block per pair.

    Files are written per partition and split after ``max_blocks_per_file`` blocks, so a file
    (one ``wholetext`` row when parsed back) stays a few MB however large ``df`` is.
    """
    (df.select(render_block(fmt, F.col(code), F.col(label), quoted).alias("value"))
       .write.mode(mode).option("maxRecordsPerFile", max_blocks_per_file).text(path))
