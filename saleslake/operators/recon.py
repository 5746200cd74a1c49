"""Contents of two tables compared through trees of digests.

Keys are dealt to ranges of a hash; the digest of a range is order-free and
counts copies: rows, and sums of the halves of two row hashes.  Digests of all
ranges are made in one pass over each side, added up before the shuffle, so a
level moves one row for each range and task.  Only ranges whose digests differ
are looked at again, in ``FAN_OUT`` finer ranges each, level by level; at the
last level the rows of the ranges that still differ are compared key by key.
Where nothing differs, no key is moved at all.

The ranges that differ are a table in the shared folder of at most
``FAN_OUT`` ** level rows; Spark sends it to the tasks or not by its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.session import scratch_path

FAN_OUT = 256
LEVELS = 2
ROWS_A_TASK = 250_000  # rows of differing ranges that a task adds up by key
ORIGINS = 64           # parts in which the rows of a frequent key are added up first
_LOW = (1 << 32) - 1


def row_digest(cols: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row; NULL differs from every value and from NULL in another column."""
    parts = [p for c in cols for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)


def _halves(hashes: tuple[Column, Column]) -> list[Column]:
    """Sums that cannot overflow before 2^31 rows a range: 32 bits of a hash each."""
    return [h for x in hashes for h in (x.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(x, 32))]


def digested(df: DataFrame, key_cols: list[str], cols: list[str]) -> DataFrame:
    """The keys (as they are), ``_range`` (of the finest level), and ``_d0`` .. ``_d3`` of each row."""
    parts = [p for c in key_cols for p in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    place = F.pmod(F.xxhash64(F.lit(3), *parts), F.lit(FAN_OUT**LEVELS))
    return df.select(*[F.col(f"`{c}`") for c in key_cols], place.alias("_range"), *[d.alias(f"_d{i}") for i, d in enumerate(_halves(row_digest(cols)))])


def _sums() -> list[Column]:
    return [F.sum(F.lit(1)).alias("n"), *[F.sum(f"_d{i}").alias(f"d{i}") for i in range(4)]]


def differing_ranges(left: DataFrame, right: DataFrame, level: int, parents: DataFrame | None) -> DataFrame:
    """``_r``: ranges of ``level`` (within ``parents``, ranges of the level above) whose digests differ; ``_rows``: rows of both sides."""
    width = FAN_OUT ** (LEVELS - level)
    sides = []
    for side, df in enumerate((left, right)):
        rows = df if parents is None else within(df, parents, level - 1)
        own = rows.groupBy(F.floor(F.col("_range") / width).alias("_r")).agg(*_sums())
        sides.append(own.withColumn("_side", F.lit(side)))
    both = sides[0].unionByName(sides[1]).groupBy("_r").agg(
        F.count(F.lit(1)).alias("sides"), F.sum("n").alias("_rows"), *[(F.max(c) != F.min(c)).alias(f"x_{c}") for c in ("n", "d0", "d1", "d2", "d3")])
    other = F.col("sides") < 2
    for c in ("n", "d0", "d1", "d2", "d3"):
        other = other | F.col(f"x_{c}")
    return both.where(other).select("_r", "_rows")


def within(df: DataFrame, ranges: DataFrame, level: int) -> DataFrame:
    """Rows of ``df`` in ``ranges`` (of ``level``)."""
    width = FAN_OUT ** (LEVELS - level)
    return df.join(ranges, F.floor(df["_range"] / width) == ranges["_r"], "left_semi")


def recon_contents(source: DataFrame, target: DataFrame, key_cols: list[str], cols: list[str] | None = None) -> DataFrame:
    """Every key whose rows differ: the keys, source_rows, target_rows, status.

    ``missing_in_target`` and ``missing_in_source``: only one side has the
    key; ``repeated``: both have it, one more often; ``changed``: as often,
    with other contents (compared as multisets, whatever the order).  ``cols``:
    what is compared (all columns that both sides have).  A NULL key is a key
    like any other.
    """
    spark = source.sparkSession
    cols = cols or [c for c in source.columns if c in target.columns]
    sides = [digested(df, key_cols, cols) for df in (source, target)]
    ranges = None
    for level in range(1, LEVELS + 1):
        found = differing_ranges(*sides, level, ranges)
        path = scratch_path(spark, f"recon-{level}")
        found.write.parquet(path)
        ranges = spark.read.schema(found.schema).parquet(path)
    keys = [F.col(f"`{c}`") for c in key_cols]
    # rows of the differing ranges only; what a side has too much of a digest is the difference of its sums
    sign = lambda i: 1 - 2 * i
    rows = [within(df, ranges, LEVELS).select(*keys, F.lit(1 - i).alias("_n0"), F.lit(i).alias("_n1"), *[(F.col(f"_d{j}") * sign(i)).alias(f"_d{j}") for j in range(4)])
            for i, df in enumerate(sides)]
    both, sums = rows[0].unionByName(rows[1]), ["_n0", "_n1", *[f"_d{j}" for j in range(4)]]
    total = ranges.agg(F.sum("_rows")).first()[0] or 0
    tasks = -(-total // ROWS_A_TASK)
    add = [F.sum(c).alias(c) for c in sums]
    if tasks > 1:
        # so many tasks that the keys of one fit its memory, whatever the session's number; first by key and
        # origin, so that the rows of a frequent key (or of none) don't meet before they are added up
        both = both.withColumn("_origin", F.pmod(F.spark_partition_id(), F.lit(ORIGINS))).repartition(tasks, *keys, "_origin").groupBy(*keys, "_origin").agg(*add)
        both = both.drop("_origin").repartition(tasks, *keys)
    both = both.groupBy(*keys).agg(*add)
    same = F.lit(True)
    for c in sums[2:]:
        same = same & (F.col(c) == 0)
    same = same & (F.col("_n0") == F.col("_n1"))
    status = (F.when(F.col("_n0") == 0, "missing_in_source").when(F.col("_n1") == 0, "missing_in_target")
              .when(F.col("_n0") != F.col("_n1"), "repeated").otherwise("changed"))
    return both.where(~same).select(*keys, F.col("_n0").alias("source_rows"), F.col("_n1").alias("target_rows"), status.alias("status"))
