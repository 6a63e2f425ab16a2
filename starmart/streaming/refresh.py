"""Monthly refresh as a Structured Streaming job.

New monthly drops land as Parquet files under a landing folder.  A file-source stream with an
available-now trigger picks up every file not yet seen (the checkpoint remembers which) and
each micro-batch replaces exactly the months it contains in the partitioned target table
(dynamic partition overwrite).  Re-running a batch after a failure writes the same months
again, so the sink is idempotent; months not in a batch are never touched.  A drop must hold
the complete data of the months it carries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.parquet import write_table


def refresh_stream(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                   checkpoint: str, partition_by: Sequence[str]):
    """Start the refresh query (available-now) and return the ``StreamingQuery``.

    No per-trigger file limit is set on purpose: all files landed since the last run form one
    micro-batch, so the files of one month are never split across two batches (the second
    batch's overwrite would otherwise drop the first batch's rows of that month).
    """
    stream = spark.readStream.schema(schema).parquet(landing)
    parts = list(partition_by)

    def replace_months(batch: DataFrame, epoch_id: int) -> None:
        write_table(batch, target, partition_by=parts, dynamic=True)

    return (stream.writeStream
            .foreachBatch(replace_months)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def refresh_from_landing(spark: SparkSession, landing: str, schema: T.StructType, target: str,
                         checkpoint: str, partition_by: Sequence[str],
                         timeout_s: int | None = None) -> None:
    """Run one refresh to completion (all landed files processed), however long it takes.

    With ``timeout_s`` a refresh that is not done by then is stopped and raises; the months of
    its unfinished batch are written again by the next run.
    """
    q = refresh_stream(spark, landing, schema, target, checkpoint, partition_by)
    q.awaitTermination(timeout_s)
    if q.isActive:
        q.stop()
        raise TimeoutError("refresh did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(f"refresh failed: {q.exception()}")
