"""Helpers shared by the operators: words, case folding, hash splits, stored tables, safe columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path

#: a word is a run of anything but ASCII white space (``bytes.split()`` splits alike)
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fold(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, UPPER.lower())


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def n_words(c: Column) -> Column:
    return F.regexp_count(text_or_empty(c), F.lit(WORD)).cast("long")


def split_remainder(id_col: Column, mod: int) -> Column:
    """crc32(id as text) mod ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


def stored(df: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the lineage there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df if partitions is None else df.coalesce(partitions)).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_of(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of equally many rows, of ``size`` bytes on average (or one row)."""
    rows = max(1, batch.num_rows * size // max(1, batch.nbytes))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_batches(df: DataFrame, fn, schema: str, done=None, sliced: bool = False) -> DataFrame:
    """``mapInArrow`` with ``fn(dict of python lists/arrays, batch) -> dict of columns``.

    ``fn`` gets one Arrow record batch and returns a ``dict`` of equally long columns in the order
    of ``schema``; empty batches are skipped.  ``done()`` is called at a task's end.  ``sliced``: ``fn``
    gets the slices of :func:`parts_of`, so a worker holds the Python objects of one slice at a time, and
    what the batches took is given back at the task's end.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in (parts_of(batch) if sliced else [batch])):
            if part.num_rows:
                out = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                     for x, f in zip((out[f.name] for f in target), target, strict=True)],
                    schema=target)
        if done:
            done()
        if sliced:
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null counts as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


SPACES = re.compile(rb"[\x20\x09-\x0D]")


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of ``data`` in lists from about ``size`` bytes each, however long the text is."""
    at = 0
    while at < len(data):
        end = SPACES.search(data, at + size)
        end = end.start() if end else len(data)
        yield data[at:end].split()
        at = end


def with_locator(docs: DataFrame, *cols: Column) -> DataFrame:
    """(row, locator, cols): each row of ``docs`` as one struct, and its place: file and row number.

    Rows that do not come straight from Parquet files are stored first.  The struct keeps columns
    of any name apart from the operators' own.
    """
    def pick(df: DataFrame) -> DataFrame:
        meta = df.metadataColumn("_metadata")
        place = F.concat_ws("#", meta["file_path"],
                            F.lpad(meta["row_index"].cast("string"), 12, "0"))
        return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"),
                         place.alias("locator"), *cols)
    try:
        return pick(docs)
    except AnalysisException:
        return pick(stored(docs, "located-rows"))


def uniform_hash(seed: str, c: Column) -> Column:
    """A number in [0, 1) from XXH64 of the seed and the value: the same in every run."""
    bits = F.xxhash64(F.lit(seed), c).bitwiseAND(F.lit((1 << 53) - 1).cast("long"))
    return bits.cast("double") / float(1 << 53)


def measured_bytes(df: DataFrame) -> int:
    """The bytes of a (stored) frame's values: 8 for a number, the length and 16 for a text."""
    def width(c: Column, kind) -> Column:
        if hasattr(kind, "fields"):
            return sum((width(c[f.name], f.dataType) for f in kind.fields), F.lit(8))
        if kind.typeName() in ("string", "binary"):
            return F.coalesce(F.octet_length(c), F.lit(0)) + 16
        return F.lit(8)

    row = sum((width(F.col(quoted(f.name)), f.dataType) for f in df.schema.fields), F.lit(0))
    return df.agg(F.coalesce(F.sum(row.cast("long")), F.lit(0))).first()[0]


def small_side(df: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """``df`` to be broadcast if its measured size is within ``limit`` bytes; else as it is, and
    the join shuffles."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df


def bounded_sample(rows: DataFrame, seed: str, max_bytes: int) -> DataFrame:
    """Of drawn (kind, id, text) rows one per kind and id, and of these, in the order of a hash of the id,
    as many as fit ``max_bytes`` of text per kind.

    However often an id is repeated and however long its texts are, the sample is bounded.  Of several
    rows of an id the shortest text counts (of equally long ones the one with the smallest hash); null
    texts are empty, null ids are one id.  Sizes and hashes are looked at first, map-side combined, so
    only the texts of the sample are shuffled.
    """
    rows = rows.select("kind", "id", text_or_empty(F.col("text")).alias("text"))
    mark = F.struct(F.octet_length("text").cast("long").alias("size"), F.xxhash64("text").alias("hash"))
    firsts = rows.groupBy("kind", "id").agg(F.min(mark).alias("mark"))
    order = Window.partitionBy("kind").orderBy(uniform_hash(seed, F.col("id")), "id")
    taken = firsts.withColumn("used", F.sum(F.col("mark.size") + 64).over(order)).where(F.col("used") <= max_bytes)
    taken = taken.select(F.col("kind").alias("k"), F.col("id").alias("i"), "mark")
    same = F.col("kind").eqNullSafe(F.col("k")) & F.col("id").eqNullSafe(F.col("i")) & (mark == F.col("mark"))
    return rows.join(small_side(taken), same).groupBy("kind", "id").agg(F.min("text").alias("text"))
