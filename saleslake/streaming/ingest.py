"""Incremental file pick-up (T1, T2) with Structured Streaming.

T1: a file-source stream over the landing folder with ``availableNow``: each
run processes exactly the files not seen before (the checkpoint records
them), then stops.  The Parquet file sink is exactly-once through its own
metadata log, so re-running never duplicates rows.

T2: ``foreachBatch`` writing every micro-batch to its own
``run=<id>/batch=<id>`` folder with overwrite.  A batch that is replayed after
a failure (same checkpoint, same id) replaces its own output, so the load is
idempotent; a second stream into the same target has a checkpoint and so a run
of its own.  The label is ``<table>_<batch id>`` instead of a wall-clock stamp.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.operators import table as TB
from saleslake.session import hadoop_fs


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def csv_stream(spark: SparkSession, landing: str, columns: list[str], max_files_per_trigger: int | None = None,
               multi_line: bool = False) -> DataFrame:
    """All-string CSV stream over a landing folder (header row, quotes; line breaks in quotes with ``multi_line``).

    A file whose header differs from ``columns`` fails the batch.
    """
    r = (spark.readStream.schema(string_schema(columns)).option("header", True).option("multiLine", multi_line)
         .option("enforceSchema", False).option("escape", '"'))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.csv(landing)


def ingest_available(stream: DataFrame, target: str, checkpoint: str) -> int:
    """Process every file not yet seen, append to ``target`` (Parquet), stop.

    Returns the number of micro-batches run.
    """
    before = _committed(stream.sparkSession, checkpoint)
    q = (stream.writeStream.format("parquet").option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start(target))
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return _committed(stream.sparkSession, checkpoint) - before


def _committed(spark: SparkSession, checkpoint: str) -> int:
    """Batches that a checkpoint has committed (``recentProgress`` forgets after a hundred).

    The names are numbered, so the highest counts even when old ones are cleaned up.
    """
    fs, folder = hadoop_fs(spark, f"{checkpoint.rstrip('/')}/commits")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    return max((int(n) for n in names if n.isdigit()), default=-1) + 1


def batch_label(table: str, batch_id: int) -> str:
    """Deterministic load label."""
    return f"{table}_{batch_id}"


def idempotent_batch_writer(target: str, table: str, run: str):
    """The ``foreachBatch`` function; overwrite of the batch's own folder.

    ``run`` names the stream (one for each checkpoint), so streams that share
    a target never write to each other's folders.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        (df.withColumn("load_label", F.lit(batch_label(table, batch_id)))
           .write.mode("overwrite").parquet(f"{target.rstrip('/')}/run={run}/batch={batch_id}"))

    return write


def ingest_batches(stream: DataFrame, target: str, checkpoint: str, table: str) -> int:
    """Run ``foreachBatch`` with the idempotent writer until the landing folder is drained."""
    run = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    before = _committed(stream.sparkSession, checkpoint)
    q = (stream.writeStream.foreachBatch(idempotent_batch_writer(target, table, run))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return _committed(stream.sparkSession, checkpoint) - before


def ingest_table(stream: DataFrame, root: str, checkpoint: str, load=None) -> int:
    """T2 into a published table: each micro-batch is one load and one version, published once.

    The load's transaction is (the checkpoint's run, the batch); it is stored
    in the version itself, so a batch that is replayed, after a failure at any
    point, publishes nothing again.  ``load(rows, txn)`` is the load mode
    (an append if not given).
    """
    run = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    load = load or (lambda rows, txn: TB.append(rows, root, txn=txn))
    before = _committed(stream.sparkSession, checkpoint)
    q = (stream.writeStream.foreachBatch(lambda rows, batch: load(rows, (run, batch)))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return _committed(stream.sparkSession, checkpoint) - before
