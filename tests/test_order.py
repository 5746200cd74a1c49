"""O1: places are a permutation of 1..n in the order asked for, whatever the keys, ties and payload."""

import random

from saleslake.operators.order import numbered


def test_places_with_payload_ties_and_a_hot_key(spark):
    rng = random.Random(3)
    rows = [(None if i % 50 == 0 else 7 if i % 3 == 0 else rng.randrange(40), i, "x" * (i % 90)) for i in range(6_000)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "211")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(rows, "k int, id long, payload string").repartition(5)
        got = numbered(df, ["k"], "place").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    got.sort(key=lambda r: r.place)
    assert [r.place for r in got] == list(range(1, len(rows) + 1))
    keys = [(r.k is not None, r.k or 0) for r in got]
    assert keys == sorted(keys)
    assert sorted((r.id, r.k, r.payload) for r in got if r.k) == sorted((i, k, p) for k, i, p in rows if k)
    assert sorted(r.id for r in got) == list(range(len(rows)))


def test_empty_table(spark):
    assert numbered(spark.createDataFrame([], "k int, v string"), ["k"], "place").collect() == []
