"""Array expressions for hierarchy paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_empty(values: list[Column]) -> Column:
    """The values in order, NULL and ``""`` dropped (whitespace-only kept)."""
    return F.filter(F.array(*values), lambda x: x.isNotNull() & (x != F.lit("")))


def drop_adjacent_repeats(arr: Column) -> Column:
    """Drop blank entries and entries equal to the element just before them.

    The comparison is with the *input* list (before removal), so ``A,A,A``
    gives ``A`` and ``A,B,A`` is kept whole.  Written as one left fold that
    carries the previous input element, so ``arr`` is evaluated once per row
    (a lambda that indexes back into ``arr`` would re-evaluate it per element).
    """
    init = F.struct(
        F.lit(None).cast("string").alias("prev"),
        F.array().cast("array<string>").alias("acc"),
    )

    def step(state: Column, x: Column) -> Column:
        keep = (x != F.lit("")) & (state["prev"].isNull() | (state["prev"] != x))
        acc = F.when(keep, F.concat(state["acc"], F.array(x))).otherwise(state["acc"])
        return F.struct(x.alias("prev"), acc.alias("acc"))

    return F.aggregate(arr, init, step, lambda s: s["acc"])


def join_path(arr: Column, sep: str = ".") -> Column:
    """Join ids with ``.``."""
    return F.array_join(arr, sep)
