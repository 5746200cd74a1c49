"""Total order (O1): rows numbered by a distributed sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslake.session import scratch_path

_PART_BITS = 33  # monotonically_increasing_id: the row's place in its partition is in the low bits


def numbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """``df`` with its place (from 1) in the order of ``by``, NULL first.

    The rows are dealt to ranges and sorted once, and written with the range
    and the place within it, so that sizes and places come from the same
    ranges.  Each range is shifted by the sizes of those before (one row per
    range), so no task sees the whole table.  Rows that tie in ``by`` keep the
    order of the input; a hot key is split between ranges by that order.
    """
    spark = df.sparkSession
    dealt = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*[F.col(f"`{c}`") for c in by], "_tie").sortWithinPartitions(*[F.col(f"`{c}`") for c in by], "_tie")
    dealt = dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    path = scratch_path(spark, "ordered")
    dealt.write.parquet(path)
    ranges = spark.read.schema(dealt.schema).parquet(path).withColumn("_part", F.shiftright("_at", _PART_BITS))
    sizes = ranges.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << _PART_BITS) - 1)) + 1
    # as many rows as there are ranges, whatever the size of the table
    return ranges.join(F.broadcast(starts), "_part").withColumn(name, place).drop("_part", "_at", "_start")
