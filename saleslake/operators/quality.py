"""Announced-but-missing reference features, built as plain Spark jobs.

N1 merge (upsert/delete by key, newest change wins), N2 reconciliation
(counts, duplicates, missing keys), N3/N4 enrichment with dimensions,
N5 a rollup report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.operators import table as TB

DELETE_OP = "D"


def latest_changes(changes: DataFrame, key: str, seq: str) -> DataFrame:
    """Newest change per key: ``max(struct(seq, ...))`` - a partial (map-side)
    aggregation, so a key with millions of changes never lands in one task
    as a window partition would; ties on ``seq`` break on the other fields."""
    others = [c for c in changes.columns if c not in (key, seq)]
    packed = F.max(F.struct(F.col(seq).alias("_seq"), *[F.col(c) for c in others])).alias("_c")
    return changes.groupBy(key).agg(packed).select(
        key, *[F.col(f"_c.{c}").alias(c) for c in others], F.col("_c._seq").alias(seq))


def merge_upsert(target: DataFrame, changes: DataFrame, key: str, seq: str = "seq", op: str = "op") -> DataFrame:
    """Apply inserts, updates and deletes (``op == 'D'``) to ``target`` by key."""
    latest = latest_changes(changes, key, seq)
    cols = [c for c in target.columns if c != key]
    t = target.select(key, F.struct(*cols).alias("_t"))
    c = latest.select(key, F.col(op).alias("_op"), F.struct(*cols).alias("_n"))
    j = t.join(c, key, "full_outer")
    j = j.where(F.col("_op").isNull() | (F.col("_op") != F.lit(DELETE_OP)))
    return j.select(key, *[F.when(F.col("_op").isNotNull(), F.col(f"_n.{x}")).otherwise(F.col(f"_t.{x}")).alias(x) for x in cols])


def recon_counts(source: DataFrame, target: DataFrame, group_cols: list[str]) -> DataFrame:
    """Rows per group in source and target, side by side.

    One aggregation over both sides, so a NULL group is one group like any other.
    """
    both = source.select(*group_cols, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(
        target.select(*group_cols, F.lit(0).alias("_s"), F.lit(1).alias("_t")))
    j = both.groupBy(*group_cols).agg(F.sum("_s").alias("source_rows"), F.sum("_t").alias("target_rows"))
    status = (F.when(F.col("source_rows") == 0, "missing_in_source")
              .when(F.col("target_rows") == 0, "missing_in_target")
              .when(F.col("source_rows") == F.col("target_rows"), "match").otherwise("mismatch"))
    return j.select(*group_cols, "source_rows", "target_rows",
                    (F.col("source_rows") - F.col("target_rows")).alias("diff"), status.alias("status"))


def recon_duplicates(df: DataFrame, key_cols: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def recon_missing_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                       left_name: str = "left", right_name: str = "right") -> DataFrame:
    """Referential integrity both ways (two anti joins on de-duplicated keys; NULL is no key)."""
    lk = left.select(F.col(left_key).alias("key")).where("key IS NOT NULL").distinct()
    rk = right.select(F.col(right_key).alias("key")).where("key IS NOT NULL").distinct()
    a = lk.join(rk, "key", "left_anti").select("key", F.lit(f"missing_in_{right_name}").alias("side"))
    b = rk.join(lk, "key", "left_anti").select("key", F.lit(f"missing_in_{left_name}").alias("side"))
    return a.unionByName(b)


def enrich(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, cols: list[str]) -> DataFrame:
    """Left join of facts with dimension attributes.

    Of several master rows with one key the smallest (by ``cols`` in order,
    NULL first) gives the attributes, so a duplicate neither multiplies facts nor makes the
    result depend on the run; ``recon_duplicates`` reports them.  The join
    strategy is left to the measured sizes (autoBroadcastJoinThreshold, AQE).
    """
    d = dim.groupBy(F.col(dim_key).alias("_k")).agg(F.min(F.struct(*cols)).alias("_d"))
    d = d.select("_k", *[F.col(f"_d.{c}").alias(c) for c in cols])
    return fact.join(d, fact[fact_key] == d["_k"], "left").drop("_k")


def rollup_report(df: DataFrame, dims: list[str], value_col: str) -> DataFrame:
    """Totals by ``rollup(dims)`` with the grouping level."""
    return df.rollup(*dims).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.sum(value_col), 2).alias("total_value"),
        F.grouping_id(*dims).cast("int").alias("level"),
    )


def merge_partitions(spark, root: str, changes: DataFrame, key: str, partition_col: str,
                     seq: str = "seq", op: str = "op", txn: tuple | None = None) -> list:
    """N1 on a published table: rewrite only the partitions that hold a changed key.

    The current partitions of the changed keys are found by a semi join that
    reads only the key and the partition column; their rows are merged with
    the newest changes and published in one step, on the version they were
    read from.  A changed row whose new partition holds no changed key is
    simply added there.  Returns the changed partitions as text.
    """
    base = TB.manifest(spark, root)
    target = TB.read_table(spark, root, version=base.version)
    latest = latest_changes(changes, key, seq)
    holds = target.select(key, partition_col).join(latest.select(key), key, "left_semi")
    touched = [r[0] for r in holds.select(partition_col).distinct().collect()]  # at most one row per partition
    keys = [TB.partition_key(target.schema, partition_col, t) for t in touched]
    part = TB.read_table(spark, root, keys, base.version) if keys else target.limit(0)
    merged = merge_upsert(part, latest, key, seq, op)
    return TB.replace(spark, root, merged, None, touched, txn=txn, base=base)
