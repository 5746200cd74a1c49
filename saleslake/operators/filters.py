"""Filters and predicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
SECONDARY_DATE_FLOOR = 20230331    # invoicedate must be strictly after it
DETAILS_DATE_FLOOR = 20230331      # postingdate must be strictly after it
# ------------------------------------------------------------------------------


def date_floor(df: DataFrame, col: str, floor: int = SECONDARY_DATE_FLOOR) -> DataFrame:
    """cast the yyyymmdd column to int and keep values strictly after ``floor``.

    NULLs drop out; a value that is not an integer raises (ANSI cast), as
    the reference's strict cast does.  Storing the date as an int lets the
    predicate reach the Parquet scan on later reads.
    """
    return df.withColumn(col, F.col(col).cast("int")).filter(F.col(col) > F.lit(floor))


def contains_not_null(text_col: str, marker: str, not_null_col: str) -> Column:
    """``text LIKE '%marker%' AND other IS NOT NULL`` without LIKE wildcards."""
    return F.col(text_col).contains(marker) & F.col(not_null_col).isNotNull()


def null_safe_not(cond: Column) -> Column:
    """Survivors of a DELETE WHERE cond: rows where cond is false *or NULL*."""
    return ~F.coalesce(cond, F.lit(False))


def non_empty(df: DataFrame) -> bool:
    """skip empty inputs (one cheap job that stops at the first row)."""
    return not df.isEmpty()
