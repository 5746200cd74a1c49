"""Schema evolution (A14, K14): change frame, ALTER text, widened spec.

The change list comes from the one-pass profile; applying it returns a *new*
``TableSpec`` (source files are never edited) and the data is rewritten with
the wider casts by the normal clean path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.spec import TableSpec


def schema_changes(prof: DataFrame, table: str) -> DataFrame:
    """``(table, column, old type, new type, reason, ALTER text)`` per proposal."""
    base = F.upper(F.split_part(F.col("declared"), F.lit("("), F.lit(1)))
    reason = (
        F.when(F.col("varchar_overflow"),
               F.format_string("data holds %d characters; widened with a 20%% buffer", F.col("max_len")))
        .when(F.col("numeric_overflow"),
              F.concat(F.lit("values outside "), base, F.lit(": min="), F.col("min_val"), F.lit(", max="), F.col("max_val")))
        .when(F.col("has_time"), F.lit("values carry a time of day"))
        .otherwise(F.lit("data is double precision"))
    )
    return prof.where(F.col("proposed").isNotNull()).select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.col("declared").alias("old_type"),
        F.col("proposed").alias("new_type"),
        reason.alias("reason"),
        F.format_string("ALTER TABLE %s MODIFY COLUMN %s %s", F.lit(table), F.col("column_name"), F.col("proposed")).alias("alter_sql"),
    )


def evolve_spec(spec: TableSpec, changes: list[tuple[str, str]]) -> TableSpec:
    """A new spec with the proposed types; the old one is left as it was."""
    return spec.with_types(dict(changes))


def apply_changes(spec: TableSpec, change_frame: DataFrame) -> TableSpec:
    """Collect the (small, one row per changed column) change frame and evolve the spec."""
    rows = change_frame.select("column_name", "new_type").collect()
    return evolve_spec(spec, [(r[0], r[1]) for r in rows])
