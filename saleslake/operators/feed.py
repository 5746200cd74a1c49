"""What changed between versions of a published table (N1, N8), and a view that follows it.

Both read only the data folders in which two manifests differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.operators import table as TB

INSERT, DELETE, PRE, POST = "insert", "delete", "update_preimage", "update_postimage"
SOURCE = "source"  # transaction of a view: the version of the table that it shows
MONEY = T.DecimalType(28, 6)  # exact, so that sums can be taken back


# --- N1, N8: change feed ------------------------------------------------------------


def differing(spark: SparkSession, root: str, old: TB.Manifest | None, new: TB.Manifest) -> tuple[DataFrame, DataFrame]:
    """(rows of folders that only ``old`` has, rows of folders that only ``new`` has), with the columns of ``new``."""
    before, after = old.folders() if old else set(), new.folders()
    return tuple(TB.read_folders(spark, root, sorted(some), new) for some in (before - after, after - before))


def net_changes(removed: DataFrame, added: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``_n``: copies more (or, below zero, less) than before.

    Rows that a load merely wrote again cancel out.  Copies are added up before the shuffle.
    """
    cols = [F.col(f"`{c}`") for c in added.columns]
    both = added.select(*cols, F.lit(1).alias("_n")).unionByName(removed.select(*cols, F.lit(-1).alias("_n")))
    return both.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")


def version_changes(spark: SparkSession, root: str, version: int, key: str | None = None) -> DataFrame:
    """The changes that one version made: its columns, ``_version``, ``_change``, ``_copies``.

    Without ``key`` every change is an insert or a delete.  With it, a key
    that lost rows and got rows was updated: pre-image and post-image.  A NULL
    key identifies nothing, so such rows are inserted and deleted.
    """
    new = TB.manifest(spark, root, version)
    old = TB.manifest(spark, root, version - 1) if version > 1 else None
    cols = [F.col(f"`{c}`") for c in new.schema.names]
    net = net_changes(*differing(spark, root, old, new))
    plain = F.when(F.col("_n") > 0, INSERT).otherwise(DELETE)
    if key is not None:
        name = F.col(f"`{key}`")
        both = net.where(name.isNotNull()).groupBy(name.alias("_key")).agg(F.max("_n").alias("_most"), F.min("_n").alias("_least"))
        both = both.where("_most > 0 AND _least < 0").select("_key", F.lit(True).alias("_updated"))
        net = net.join(both, name == F.col("_key"), "left")
        plain = F.when(F.col("_updated"), F.when(F.col("_n") > 0, POST).otherwise(PRE)).otherwise(plain)
    return net.select(*cols, F.lit(version).cast("long").alias("_version"), plain.alias("_change"), F.abs("_n").cast("long").alias("_copies"))


def table_changes(spark: SparkSession, root: str, start: int, end: int | None = None, key: str | None = None) -> DataFrame:
    """The changes of all versions after ``start`` up to ``end`` (the latest), with the columns of ``end``.

    Columns that older versions lack are NULL there.
    """
    last = TB.manifest(spark, root, end)
    extra = T.StructType([T.StructField("_version", T.LongType()), T.StructField("_change", T.StringType()), T.StructField("_copies", T.LongType())])
    schema = T.StructType([*last.schema.fields, *extra.fields])
    out = spark.createDataFrame([], schema)
    for v in (v for v in TB.versions(spark, root) if start < v <= last.version):
        out = out.unionByName(_as_of(version_changes(spark, root, v, key), TB.manifest(spark, root, v), last, extra))
    return out


def _as_of(changes: DataFrame, m: TB.Manifest, last: TB.Manifest, extra: T.StructType) -> DataFrame:
    """Rows with the columns of ``m`` under the names and types that ``last`` has for them (by their numbers)."""
    own = dict(zip(m.ids, m.schema.names))
    cols = [(F.col(f"`{own[i]}`") if i in own else F.lit(None)).cast(f.dataType).alias(f.name) for i, f in zip(last.ids, last.schema.fields)]
    return changes.select(*cols, *extra.names)


# --- N5: materialised view -----------------------------------------------------------


def states(rows: DataFrame, dims: list[str], value: str, sign: int = 1) -> DataFrame:
    """Partial aggregates by ``dims`` that can be added up and taken back."""
    amount = F.col(f"`{value}`").cast(MONEY)
    return rows.groupBy(*dims).agg(
        F.sum(F.lit(sign)).cast("long").alias("n_rows"), (F.count(amount) * sign).alias("n_values"),
        F.coalesce(F.sum(amount * sign), F.lit(0)).cast(T.DecimalType(38, 6)).alias("total"))


def refresh_view(spark: SparkSession, root: str, view: str, dims: list[str], value: str,
                 prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> int:
    """Bring the view at ``view`` to the latest version of the table at ``root``; returns that version.

    The view holds counts and exact totals by ``dims``, partitioned by the
    first of them.  A refresh reads the folders that were added and removed
    since the version shown, adds the former, takes back the latter, and
    rewrites the partitions of the view that this touches.  The version shown
    is published with the rows, so a refresh that dies or runs twice does no
    harm.  ``prepare`` makes the dimensions row by row (an enrichment by a
    dimension table; when that table itself changes, make a new view).
    """
    now = TB.manifest(spark, root)
    txn = (SOURCE, now.version)
    if not TB.versions(spark, view):
        TB.create(states(prepare(TB.read_table(spark, root, version=now.version)), dims, value), view, dims[0], txn=txn)
        return now.version
    shown = TB.manifest(spark, view)
    if shown.txns[SOURCE] >= now.version:
        return shown.txns[SOURCE]
    removed, added = differing(spark, root, TB.manifest(spark, root, shown.txns[SOURCE]), now)
    delta = states(prepare(added), dims, value).unionByName(states(prepare(removed), dims, value, -1))
    touched = [r[0] for r in delta.select(dims[0]).distinct().collect()]  # at most one row per partition of the view
    keys = [TB.partition_key(shown.schema, dims[0], t) for t in touched]
    held = TB.read_table(spark, view, keys, shown.version)
    total = held.unionByName(delta).groupBy(*dims).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values"), F.sum("total").cast(T.DecimalType(38, 6)).alias("total"))
    TB.replace(spark, view, total.where("n_rows <> 0"), None, touched, txn=txn, base=shown)
    return now.version


def view_rollup(spark: SparkSession, view: str, dims: list[str]) -> DataFrame:
    """The rollup report (N5) from the view: it reads groups, not facts."""
    return TB.read_table(spark, view).rollup(*dims).agg(
        F.sum("n_rows").alias("n_rows"), F.when(F.sum("n_values") > 0, F.sum("total").cast("double")).alias("total_value"),
        F.grouping_id(*dims).cast("int").alias("level"))
