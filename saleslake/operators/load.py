"""Sinks and load modes.

Two physical layouts, both plain Parquet:

* **Versioned snapshot** (dimensions, RLS): every full refresh writes a new
  ``v=<n>`` folder; Spark's commit writes ``_SUCCESS`` last, and readers take
  the highest committed version (K5, K11, K13).
* **Partitioned fact** (``operators.table``): a partial replace writes the new
  rows and the survivors of the partitions it touches, then publishes one
  manifest, so a load is atomic and touches only its sales groups (K6-K9).

Validation (type gate, tolerance) always runs before anything is written;
the reference deleted first and validated afterwards (trap 17).
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.operators import table as TB
from saleslake.operators.profile import _plan
from saleslake.operators.project import rename_to_spec
from saleslake.operators.clean import DATE_FORMATS, choose_date_formats, decimal_of, double_of, int_of, stripped, to_date
from saleslake.operators.table import LoadError  # noqa: F401  (raised here and by the table)
from saleslake.session import hadoop_fs, scratch_path
from saleslake.spec import TableSpec, load_order, spark_type

# --- fixed values -------------------------------------------------------------
MAX_FILTER_RATIO = (1, 10)      # a load unit fails when > 10 % of its rows are filtered
EXCLUDED_RECORD_TYPE = "DD"     # secondary-fact replace keeps these rows
# Detail-fact loads naming both 107 and 112 also replace these sales groups.
DETAIL_TRIGGER_GROUPS = ("107", "112")
DETAIL_EXTRA_GROUPS = (
    "101", "203", "204", "202", "205", "302", "303", "304", "408", "409", "402", "403", "407",
    "451", "452", "453", "454", "455", "456", "457", "501", "502", "503", "504", "505", "506",
    "508", "509", "601", "602", "604", "956", "957", "961", "949", "951", "958", "959", "960",
)
ROW_GROUP_BYTES = 128 * 1024 * 1024
# ------------------------------------------------------------------------------

_VERSION_RE = re.compile(r"^v=(\d+)$")


# --- K1/K2/K3: plain sinks ------------------------------------------------------


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=(),
                  max_records_per_file: int | None = None, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """K1/K2: one lazy plan, one write; Spark's partitions replace manual chunking.

    A partitioned write is clustered by its partition columns first
    (REBALANCE: AQE sizes the tasks and splits a hot partition), so each
    table partition gets a few large files instead of one file per task.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    # static: an overwrite replaces the whole path whatever the session says
    w = df.write.mode(mode).option("parquet.block.size", row_group_bytes).option("partitionOverwriteMode", "static")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = "\u0001", header: bool = False,
                    spec: TableSpec | None = None) -> None:
    """K3: delimited export (SOH by default), no header, table column order."""
    if spec is not None:
        df = df.select(*[c for c in spec.names if c in df.columns])
    (df.write.mode("overwrite").option("sep", sep).option("header", header).option("nullValue", "")
       .option("escape", '"').csv(path))


# --- versioned snapshots (K5, K11, K13) -------------------------------------------


def _versions(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    fs, p = hadoop_fs(spark, root)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        m = _VERSION_RE.match(st.getPath().getName())
        if m and st.isDirectory():
            done = fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS"))
            out.append((int(m.group(1)), done))
    return sorted(out)


def current_version(spark: SparkSession, root: str) -> int | None:
    done = [v for v, ok in _versions(spark, root) if ok]
    return done[-1] if done else None


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The latest committed version of a snapshot table."""
    v = current_version(spark, root)
    if v is None:
        raise LoadError(f"no committed version under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/v={v:06d}")


def publish_version(df: DataFrame, root: str, keep: int | None = None, partition_by=()) -> int:
    """K5: full refresh = write a new version, visible once committed.

    With ``keep`` older committed versions beyond it are removed afterwards
    (only when no reader can still hold them); by default all stay.
    """
    spark = df.sparkSession
    versions = _versions(spark, root)
    nxt = (versions[-1][0] + 1) if versions else 1
    write_parquet(df, f"{root.rstrip('/')}/v={nxt:06d}", mode="errorifexists", partition_by=partition_by)
    done = [v for v, ok in _versions(spark, root) if ok]
    fs, _ = hadoop_fs(spark, root)
    jvm = spark.sparkContext._jvm
    for v in done[:-keep] if keep else []:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/v={v:06d}"), True)
    return nxt


def create_table(spark: SparkSession, spec: TableSpec, root: str) -> int:
    """An empty first version with the spec's schema (comments in metadata)."""
    empty = spark.createDataFrame([], spec.schema())
    return publish_version(empty, root)


def drop_table(spark: SparkSession, root: str) -> bool:
    """DROP TABLE IF EXISTS for a path table."""
    fs, p = hadoop_fs(spark, root)
    return bool(fs.delete(p, True)) if fs.exists(p) else False


VIEWS = "_views"
VIEW_COLUMNS = "place int, name string, sql string"


def create_all(spark: SparkSession, specs: dict[str, TableSpec], root: str, views: dict[str, str] | None = None,
               rows: dict[str, DataFrame] | None = None) -> DataFrame:
    """Every table in load order, its first rows, then the views; one status row each.

    ``rows``: what a table holds from the start.  ``views``: SQL over the
    tables (and views before); they are stored beside the tables and
    registered in the session (``open_all`` does so in any other).  A table
    that exists is left as it is; one that fails does not stop the others.
    """
    out = []

    def attempt(kind: str, name: str, step) -> bool:
        try:
            out.append((kind, name, step(), None))
            return True
        except Exception as e:  # reported as this one's status
            out.append((kind, name, "failed", str(e).splitlines()[0][:500]))
            return False

    def table(spec: TableSpec) -> str:
        path = f"{root.rstrip('/')}/{spec.name}"
        status = "exists"
        if current_version(spark, path) is None:
            create_table(spark, spec, path)
            if rows and spec.name in rows:
                publish_version(TB.aligned(rows[spec.name], spec.schema()), path)
            status = "created"
        read_current(spark, path).createOrReplaceTempView(spec.name)
        return status

    def view(name: str, sql: str) -> str:
        spark.sql(sql).createOrReplaceTempView(name)
        return "created"

    for spec in load_order(specs):
        attempt("table", spec.name, lambda spec=spec: table(spec))
    good = [(name, sql) for name, sql in (views or {}).items() if attempt("view", name, lambda name=name, sql=sql: view(name, sql))]
    if good:
        held = {r["name"]: r["sql"] for r in stored_views(spark, root)} | dict(good)
        stored = spark.createDataFrame([(i, *v) for i, v in enumerate(held.items())], VIEW_COLUMNS)
        publish_version(stored.coalesce(1), f"{root.rstrip('/')}/{VIEWS}")
    return spark.createDataFrame(out, "kind string, name string, status string, error string")


def stored_views(spark: SparkSession, root: str) -> list:
    """The views stored beside the tables, in the order in which they build on each other."""
    path = f"{root.rstrip('/')}/{VIEWS}"
    return read_current(spark, path).orderBy("place").collect() if current_version(spark, path) is not None else []


def open_all(spark: SparkSession, specs: dict[str, TableSpec], root: str) -> list[str]:
    """Register the tables of ``specs`` and the views stored with them in this session; their names."""
    names = []
    for spec in load_order(specs):
        path = f"{root.rstrip('/')}/{spec.name}"
        if current_version(spark, path) is not None:
            read_current(spark, path).createOrReplaceTempView(spec.name)
            names.append(spec.name)
    for r in stored_views(spark, root):
        spark.sql(r["sql"]).createOrReplaceTempView(r["name"])
        names.append(r["name"])
    return names


# --- partitioned facts (K6-K9) ---------------------------------------------------


def create_fact(df: DataFrame, root: str, group_col: str = "sales_group_code", type_col: str = "record_type") -> int:
    """A fact table by sales group whose ``DD`` rows are kept apart, so K6 and K7 swap folders."""
    return TB.create(df, root, group_col, split=(type_col, EXCLUDED_RECORD_TYPE))


def append(df: DataFrame, root: str, txn: tuple | None = None) -> list:
    """K9: append without delete."""
    return TB.append(df, root, txn)


def _kept_apart(spark: SparkSession, root: str, type_col: str) -> bool:
    m = TB.manifest(spark, root)
    return m.split_column() == type_col and m.split[1] == EXCLUDED_RECORD_TYPE


def expand_groups(groups: list[str]) -> list[str]:
    """K8: a details file naming both trigger groups also replaces the extra groups."""
    out = list(groups)
    if all(g in out for g in DETAIL_TRIGGER_GROUPS):
        out += [g for g in DETAIL_EXTRA_GROUPS if g not in out]
    return out


def replace_groups_not_dd(spark: SparkSession, root: str, new: DataFrame, groups: list[str],
                          group_col: str = "sales_group_code", type_col: str = "record_type", txn: tuple | None = None) -> list:
    """K6: delete the file's groups except ``DD`` rows, then add the new rows.

    Rows without a group belong to no file's groups and stay; rows without a
    record type stay too (``record_type <> 'DD'`` is not true for them).
    Where the table keeps ``DD`` rows apart, nothing is read.
    """
    if _kept_apart(spark, root, type_col):
        return TB.replace(spark, root, new, None, [g for g in groups if g], kinds=(TB.OTHER,), txn=txn)
    cond = F.col(group_col).isin(*_group_lits(spark, root, group_col, groups)) & (F.col(type_col) != F.lit(EXCLUDED_RECORD_TYPE))
    return TB.replace(spark, root, new, cond, list(groups), txn=txn)


def replace_dd(spark: SparkSession, root: str, new: DataFrame, type_col: str = "record_type", txn: tuple | None = None) -> list:
    """K7: delete every ``DD`` row (all groups, those without a group too), then add the new rows.

    Where the table keeps them apart, nothing is read and no other row is rewritten.
    """
    if _kept_apart(spark, root, type_col):
        return TB.replace(spark, root, new, None, None, kinds=(TB.HAS,), txn=txn)
    return TB.replace(spark, root, new, F.col(type_col) == F.lit(EXCLUDED_RECORD_TYPE), txn=txn)


def replace_groups_expanded(spark: SparkSession, root: str, new: DataFrame, groups: list[str], txn: tuple | None = None) -> list:
    """K8: drop the (expanded) groups whole, then add the new rows."""
    return TB.replace(spark, root, new, None, expand_groups(groups), txn=txn)


def _group_lits(spark: SparkSession, root: str, group_col: str, groups: list[str]) -> list[Column]:
    """Group names (text from a file name) as literals of the column's type, like SQL ``IN ('1')``."""
    dtype = TB.manifest(spark, root).schema[group_col].dataType
    return [F.lit(g).cast(dtype) for g in groups]


# --- K4: tolerant load -------------------------------------------------------------


def typed_with_errors(raw: DataFrame, spec: TableSpec, keep: tuple[str, ...] = (), formats: dict[str, str] | None = None) -> DataFrame:
    """Convert every declared column; add ``_bad`` = any conversion failed.

    ``keep`` names extra columns carried through unchanged (e.g. the load unit).
    ``formats``: the date pattern of each date column (C3's choice).
    """
    carried = [F.col(f"`{k}`") for k in keep if k not in spec.names]
    raw = rename_to_spec(raw, spec)
    plan = _plan(raw, spec)
    # three projections: texts stripped once, values converted once, flags from plain columns
    source = lambda i: F.col(f"`{plan[i][1]}`")
    texts = {f"_s{i}": source(i) for i, (_, _, _, kind) in enumerate(plan) if kind in ("int", "decimal", "double")}
    raw = stripped(raw, texts, [*carried, *[source(i).alias(f"_r{i}") for i in range(len(plan)) if f"_s{i}" not in texts]])
    cols, given, bad = [], [], []
    for i, (c, _, d, kind) in enumerate(plan):
        r = F.col(f"_s{i}" if f"_s{i}" in texts else f"_r{i}")
        if kind == "int":
            v = int_of(r, large=c.family == "LARGEINT")
        elif kind == "decimal":
            v = decimal_of(r, spark_type(c.type))
        elif kind == "double":
            v = double_of(r)
        elif kind == "date":
            v = to_date(r, (formats or {}).get(c.name, DATE_FORMATS[0][1]), c.family == "DATETIME")
        else:
            v = r
        # try_cast: a value that does not fit the declared type is a failed row
        cols.append((v.try_cast(spark_type(c.type)) if kind else v).alias(f"_v{i}"))
        if kind:
            given.append(r.isNotNull().alias(f"_g{i}"))
            bad.append(F.col(f"_g{i}") & F.col(f"_v{i}").isNull())
        if not c.nullable:
            bad.append(F.col(f"_v{i}").isNull())
    flag = F.lit(False)
    for b in bad:
        flag = flag | b
    raw = raw.select(*cols, *given, *carried)
    return raw.select(*[F.col(f"_v{i}").alias(c.name) for i, (c, _, _, _) in enumerate(plan)], *carried, flag.alias("_bad"))


def chosen_formats(raw: DataFrame, spec: TableSpec) -> dict[str, str]:
    """C3 for a load: the first date pattern within the limit, by column (the first listed if none is)."""
    raw = rename_to_spec(raw, spec)
    dates = [(c.name, actual) for c, actual, _, kind in _plan(raw, spec) if kind == "date"]
    picked = choose_date_formats(raw, [a for _, a in dates]) if dates else {}
    return {name: picked[a][1] for name, a in dates if picked[a]}


@dataclass
class LoadResult:
    status: DataFrame       # one row per load unit
    loaded: DataFrame       # rows to write
    rejected: DataFrame     # all other rows, with ``reason``


def tolerant_load(raw: DataFrame, spec: TableSpec, unit_col: str, max_ratio=MAX_FILTER_RATIO) -> LoadResult:
    """K4: filter failing rows; a unit with more than 10 % filtered rows loads nothing.

    ``unit_col`` names the load unit (a file, a chunk, a sales group); rows
    without one form a unit of their own.  Every row is in ``loaded`` or in
    ``rejected`` (reason ``bad_value``, or ``unit_failed`` for a good row of
    a failed unit).  The converted rows are staged once as a table in the
    shared folder, which all three results read.
    """
    spark = raw.sparkSession
    staged = typed_with_errors(raw, spec, keep=(unit_col,), formats=chosen_formats(raw, spec))
    path = scratch_path(spark, "tolerant")
    staged.write.parquet(path)
    typed = spark.read.schema(staged.schema).parquet(path)
    a, b = max_ratio
    status = typed.groupBy(unit_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("_bad")).alias("filtered"),
    )
    ok = F.col("filtered") * b <= F.col("total") * a
    status = status.select(
        unit_col, "total",
        F.when(ok, F.col("total") - F.col("filtered")).otherwise(F.lit(0)).cast("long").alias("loaded"),
        "filtered",
        (F.col("filtered").cast("double") * 100.0 / F.col("total").cast("double")).alias("filtered_pct"),
        F.when(ok, F.lit("Success")).otherwise(F.lit("Failed")).alias("status"),
    )
    # stored, so that Spark knows its size: a few units are sent to the tasks, and rows of one unit need not meet in one task
    units = scratch_path(spark, "tolerant-status")
    status.write.parquet(units)
    status = spark.read.schema(status.schema).parquet(units)
    passing = status.where(F.col("status") == "Success").select(F.col(unit_col).alias("_unit"), F.lit(True).alias("_ok"))
    judged = typed.join(passing, F.col(unit_col).eqNullSafe(F.col("_unit")), "left").drop("_unit")
    good = ~F.col("_bad") & F.col("_ok").isNotNull()
    reason = F.when(F.col("_bad"), "bad_value").otherwise("unit_failed")
    loaded = judged.where(good).drop("_bad", "_ok")
    rejected = judged.where(~good).withColumn("reason", reason).drop("_bad", "_ok")
    return LoadResult(status, loaded, rejected)


def summarize(status: DataFrame) -> DataFrame:
    """Fold of unit results by status."""
    return status.groupBy("status").agg(
        F.count(F.lit(1)).alias("units"),
        F.sum("total").alias("rows_total"),
        F.sum("loaded").alias("rows_loaded"),
        F.sum("filtered").alias("rows_filtered"),
    )
