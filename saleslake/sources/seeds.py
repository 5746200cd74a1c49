"""Seed files (S8, S9, K10, K12): small reference CSVs loaded by full refresh.

A seed is an all-string CSV; blank cells (empty or whitespace only) become
NULL, headers are resolved against the table spec (normalised names, so a
PascalCase header finds its snake_case column), values are cast to the
declared types, NOT NULL columns are checked, and the table is published as
a new version (nothing is visible until the write commits).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.functions.scalar import strip
from saleslake.operators.clean import DATE_FORMATS, to_date, to_decimal, to_double, to_int
from saleslake.operators.load import LoadError, current_version, publish_version, read_current
from saleslake.operators.project import rename_to_spec, select_table_order
from saleslake.sources.files import read_csv_all_string
from saleslake.spec import INT_FAMILIES, TableSpec, spark_type


@dataclass(frozen=True)
class Seed:
    """One registry entry."""
    table: str
    csv_file: str
    enabled: bool = True
    truncate_before_load: bool = True
    description: str = ""


def enabled_seeds(registry: dict[str, Seed]) -> dict[str, Seed]:
    return {k: v for k, v in registry.items() if v.enabled}


def blank_to_null_all(df: DataFrame) -> DataFrame:
    """A cell that is empty or whitespace only becomes NULL; others are kept as read."""
    return df.select(*[F.when(strip(F.col(f"`{c}`")) != F.lit(""), F.col(f"`{c}`")).alias(c) for c in df.columns])


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    return blank_to_null_all(read_csv_all_string(spark, path, multi_line=True))


def typed_seed(df: DataFrame, spec: TableSpec) -> DataFrame:
    """P3 + casts: resolve headers through the spec, convert, keep table order.

    A cell that does not convert stops the load (one aggregation counts them).
    """
    df = rename_to_spec(df, spec)
    cols = []
    for c in spec.columns:
        if c.name not in df.columns:
            continue
        v = F.col(c.name)
        if c.family in INT_FAMILIES:
            v = to_int(v).try_cast(spark_type(c.type))
        elif c.family == "DECIMAL":
            v = to_decimal(v, spark_type(c.type))
        elif c.family in ("FLOAT", "DOUBLE"):
            v = to_double(v).try_cast(spark_type(c.type))
        elif c.family in ("DATE", "DATETIME"):
            v = F.coalesce(*[to_date(v, p, c.family == "DATETIME") for _, p in DATE_FORMATS])
        cols.append(v.alias(c.name))
    failed = [F.count_if(F.col(c.name).isNotNull() & v.isNull()).alias(c.name) for c, v in zip([c for c in spec.columns if c.name in df.columns], cols)]
    lost = {k: n for k, n in (df.agg(*failed).first().asDict() if failed else {}).items() if n}
    if lost:
        raise LoadError(f"values of {spec.name} that do not convert: {lost}")
    return select_table_order(df.select(*cols), spec, fill_missing=True)


def check_not_null(df: DataFrame, spec: TableSpec) -> None:
    """NOT NULL gate: one aggregation; raise before anything is written."""
    req = [c.name for c in spec.columns if not c.nullable]
    if not req:
        return
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in req]).first()
    bad = {c: row[c] for c in req if row[c]}
    if bad:
        raise LoadError(f"NOT NULL violated in {spec.name}: {bad}")


def load_seed(spark: SparkSession, path: str, spec: TableSpec, root: str) -> int:
    """Read, type, check, publish a new version; returns the version."""
    df = typed_seed(read_seed(spark, path), spec)
    check_not_null(df, spec)
    return publish_version(df, root)


def load_seeds(spark: SparkSession, registry: dict[str, Seed], specs: dict[str, TableSpec], folder: str, target: str) -> DataFrame:
    """Every seed of the registry into ``<target>/<table>``; one status row each.

    A seed that is switched off is skipped, one that fails is reported and
    does not stop the others.  Without ``truncate_before_load`` the new rows
    are added to the current version's.
    """
    rows = []
    for seed in registry.values():
        if not seed.enabled:
            rows.append((seed.table, "Skipped", None, None))
            continue
        root = f"{target.rstrip('/')}/{seed.table}"
        try:
            df = typed_seed(read_seed(spark, f"{folder.rstrip('/')}/{seed.csv_file}"), specs[seed.table])
            check_not_null(df, specs[seed.table])
            if not seed.truncate_before_load and current_version(spark, root) is not None:
                df = read_current(spark, root).unionByName(df)
            publish_version(df, root)
            rows.append((seed.table, "Success", read_current(spark, root).count(), None))
        except Exception as e:  # reported as this seed's status
            rows.append((seed.table, "Failed", None, str(e).splitlines()[0][:500]))
    return spark.createDataFrame(rows, "table string, status string, n_rows long, error string")
