"""Reading a table from a catalog, a path or JDBC, and its column catalogue.

Connection options (URL, user, password) always come from the caller; none
are written in the code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name_or_path: str, fmt: str | None = None, options: dict | None = None) -> DataFrame:
    """A catalog table (``db.table``), a path (``fmt`` = parquet/csv/...), or ``fmt="jdbc"``.

    Predicates applied afterwards are pushed to the source by Catalyst
    (Parquet row groups, JDBC WHERE clauses).
    """
    if fmt is None:
        return spark.table(name_or_path)
    reader = spark.read.format(fmt)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    if fmt == "jdbc":
        return reader.option("dbtable", name_or_path).load()
    return reader.load(name_or_path)


def table_columns(df: DataFrame) -> list[tuple[str, str]]:
    """``(name, type)`` in table order (the ``DESC table`` of a frame)."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
