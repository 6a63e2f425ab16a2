"""Exact de-duplication by a stateful stream.

Texts are equal when identical after lower-casing A-Z.  A Structured Streaming aggregation without
a watermark keeps, in RocksDB on the executors' disks (checkpointed to the shared folder, never
expired), one entry per SHA-256 digest: the number of rows, and the largest stable identifier with
its content locator (source file and row number).  On hits - digests seen more than once - the full
bytes are compared; rows of a digest that is shared by different texts are grouped anew by the
text itself, so a colliding digest never drops a row.  Only DataFrame functions are used.

Defined results: a null text counts as empty.  Of equal texts the row with the largest id stays
(null ids are smallest); among repeated rows of that id, the one with the largest locator, so
exactly one row of a group stays.  Extra columns, of whatever name, are carried along untouched.
Texts of any length are compared whole; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path
from .common import fold, quoted, small_side, stored, text_or_empty, with_locator

#: state on local disk, checkpointed to the shared folder, within a bounded share of native memory
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "96",
    # no space reserved ahead in the files of every partition's store
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, locator, id, norm, sha) of every document."""
    return with_locator(docs, F.col(quoted(id_col)).alias("id"),
                        fold(text_or_empty(F.col(quoted(text_col)))).alias("norm")
                        ).withColumn("sha", F.unhex(F.sha2("norm", 256)))


def digest_state(spark: SparkSession, source: str, schema: StructType,
                 max_bytes_per_trigger: int) -> DataFrame:
    """Run the stateful stream over the key files in ``source`` (digest, id, locator).

    Returns one row per digest: digest, n, keep (struct of id and locator).  Each micro-batch takes
    at most ``max_bytes_per_trigger`` of key files; its changed entries are written to a folder
    named by the batch, so a batch that is run again overwrites its own output.
    """
    out, state = scratch_path(spark, "dedup-entries"), scratch_path(spark, "dedup-state")
    _make_folder(spark, out)  # an empty source makes no batch
    session = spark.newSession()
    for key, value in STATE_CONF.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    entries = (session.readStream.schema(schema)
               .option("maxBytesPerTrigger", max_bytes_per_trigger).parquet(source)
               .groupBy("digest")
               .agg(F.count(F.lit(1)).alias("n"),
                    F.max(F.struct("id", "locator")).alias("keep")))

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    query = (entries.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", state).trigger(availableNow=True).start())
    query.awaitTermination()
    # an entry only grows from batch to batch, so its last version is its largest
    return (spark.read.schema(entries.schema).parquet(out)
            .groupBy("digest").agg(F.max("n").alias("n"), F.max("keep").alias("keep")))


def _make_folder(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(target)


def _decided(docs: DataFrame, id_col: str, text_col: str, digest_bytes: int,
             max_bytes_per_trigger: int, with_row: bool) -> DataFrame:
    """(row if wanted, id, sha, keep_id, group_size, kept) for every row of ``docs``."""
    spark = docs.sparkSession
    digest = F.substring("sha", 1, digest_bytes)
    rows = located(docs, id_col, text_col).withColumn("digest", digest)
    keys = rows.select("digest", "id", "locator", "sha")
    source = scratch_path(spark, "dedup-keys")
    keys.write.parquet(source)
    hits = stored(digest_state(spark, source, keys.schema, max_bytes_per_trigger).where("n > 1"),
                  "dedup-hits")

    # full bytes on hits: the smallest and the largest text of a digest must be the same
    texts = rows.join(small_side(hits.select("digest")), "digest", "left_semi")
    clash = stored(texts.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("b"))
                   .where("a <> b").select("digest"), "dedup-clash")
    known = rows if with_row else spark.read.schema(keys.schema).parquet(source)
    cols = [*(["row"] if with_row else []), "id", "locator", "sha", "n", "keep"]
    out = known.join(small_side(hits) if with_row else hits, "digest", "left")
    if not clash.isEmpty():  # different texts under one digest: these are grouped by the text
        mixed = rows.join(clash, "digest", "left_semi")
        by_text = mixed.groupBy("digest", "norm").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "locator")).alias("keep"))
        out = (out.join(clash, "digest", "left_anti").select(*cols)
               .unionByName(mixed.join(by_text, ["digest", "norm"]).select(*cols)))
    keep = F.coalesce("keep", F.struct("id", "locator"))
    return out.select(*cols[:-4], "sha", keep["id"].alias("keep_id"),
                      F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                      (keep["locator"] == F.col("locator")).alias("kept"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest_bytes: int = 32, max_bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 (of the folded text).

    ``digest_bytes``: how many bytes of the SHA-256 the state keeps as its key.
    """
    out = _decided(docs, id_col, text_col, digest_bytes, max_bytes_per_trigger, False)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size", "kept",
                      F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      digest_bytes: int = 32, max_bytes_per_trigger: int = 64 << 30) -> DataFrame:
    """``docs`` without exact copies: the columns of ``docs``, one row per text."""
    out = _decided(docs, id_col, text_col, digest_bytes, max_bytes_per_trigger, True)
    return out.where("kept").select("row.*")
