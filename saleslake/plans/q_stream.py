"""Queries: streaming file ingest (T1) and idempotent micro-batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.operators import table as TB
from saleslake.plans import standins as S
from saleslake.plans.registry import query
from saleslake.session import hadoop_fs, scratch_path
from saleslake.streaming import ingest as ST

_COLS = ["event_id", "user_id", "event_type", "value", "props"]
_ORACLE = "SELECT event_id, user_id, event_type, value, props FROM events"


def _land(df, landing: str) -> None:
    """Drop a set of all-string CSV files into the landing folder."""
    (df.select(*[F.col(c).cast("string").alias(c) for c in _COLS])
       .write.mode("append").option("header", True).option("escape", '"').csv(landing))


def _typed(df):
    return df.select(
        F.col("event_id").cast("bigint").alias("event_id"), F.col("user_id").cast("bigint").alias("user_id"),
        "event_type", F.col("value").cast("double").alias("value"), "props",
    )


def _arrivals(spark, sf):
    ev = S.read(spark, sf, "events")
    early = F.col("event_id") % 3 != 0
    return ev.where(early), ev.where(~early)


@query("stream_file_ingest", _ORACLE)
def q_stream_file_ingest(spark, sf):
    """Two arrivals, three runs (one with nothing new): every event exactly once."""
    first, second = _arrivals(spark, sf)
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "ingested", "ckpt"))
    _land(first.repartition(4), landing)
    ST.ingest_available(ST.csv_stream(spark, landing, _COLS), target, ckpt)
    ST.ingest_available(ST.csv_stream(spark, landing, _COLS), target, ckpt)      # nothing new
    _land(second.repartition(3), landing)
    ST.ingest_available(ST.csv_stream(spark, landing, _COLS), target, ckpt)
    return _typed(spark.read.parquet(target))


@query("stream_idempotent_batches", _ORACLE)
def q_stream_idempotent_batches(spark, sf):
    """One file per micro-batch, foreachBatch with overwrite per batch id."""
    first, second = _arrivals(spark, sf)
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "batches", "ckpt"))
    _land(first.repartition(3), landing)
    ST.ingest_batches(ST.csv_stream(spark, landing, _COLS, max_files_per_trigger=1), target, ckpt, "events")
    _land(second.repartition(2), landing)
    ST.ingest_batches(ST.csv_stream(spark, landing, _COLS, max_files_per_trigger=1), target, ckpt, "events")
    return _typed(spark.read.parquet(target).drop("run", "batch", "load_label"))


@query("stream_table_batches", f"SELECT * FROM ({_ORACLE}) WHERE NOT (event_type = 'view' AND event_id % 3 <> 0) OR event_type IS NULL")
def q_stream_table_batches(spark, sf):
    """T2 into a published table: appended batch by batch, then a replay of all of them, and a stream that replaces a partition."""
    first, second = _arrivals(spark, sf)
    landing, late, root = (scratch_path(spark, n) for n in ("landing", "late", "events"))
    ckpt = scratch_path(spark, "ckpt")
    _land(first.repartition(3), landing)
    TB.create(_typed(first.limit(0)), root, "event_type")
    rows = lambda path: _typed(ST.csv_stream(spark, path, _COLS, max_files_per_trigger=1))
    ST.ingest_table(rows(landing), root, ckpt)
    hadoop_fs(spark, f"{ckpt}/commits")[0].delete(hadoop_fs(spark, f"{ckpt}/commits")[1], True)  # the stream forgets what it has done
    ST.ingest_table(rows(landing), root, ckpt)
    _land(second.coalesce(1), late)
    # of what is there, the partition 'view' is replaced by the late rows
    ST.ingest_table(rows(late), root, scratch_path(spark, "ckpt"), lambda new, txn: TB.replace(spark, root, new, None, ["view"], txn=txn))
    return TB.read_table(spark, root)
