"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query of (spark, sf_dir) and, where there is one, its DuckDB SQL."""

    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage, survives lost executors."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_uid(df: DataFrame, *keep: str) -> DataFrame:
    """``uid`` (unique per row) and the columns named; write the result before using it twice."""
    return df.select(F.monotonically_increasing_id().alias("uid"), *keep)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``fn`` to each Arrow batch; it returns one batch or an iterator of batches."""

    def run(batches):
        for batch in batches:
            out = fn(batch)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return df.mapInArrow(run, schema)
