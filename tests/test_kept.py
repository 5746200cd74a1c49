"""Profiles kept by data folder."""

import pytest
from pyspark.sql import functions as F

from saleslake.operators import kept as KP
from saleslake.operators import profile as P
from saleslake.operators import table as TB
from saleslake.spec import TableSpec, parse_columns

SPEC = TableSpec("t", parse_columns("k:BIGINT, g:VARCHAR(3), n:TINYINT, amount:DOUBLE, price:DECIMAL(10,2), day:DATE, at:DATE, note:VARCHAR(2)"))
SCHEMA = "k long, g string, n string, amount string, price string, day string, at timestamp_ntz, note string"


def rows(spark, *cells):
    kinds = [c.split() for c in SCHEMA.split(", ")]
    return spark.createDataFrame([[None if c is None else str(c) for c in r] for r in cells], ", ".join(f"{n} string" for n, _ in kinds)).select(
        *[F.col(n).cast(t).alias(n) for n, t in kinds])


A = [(1, "a+b %", "7", "1.5", "2.25", "2024-01-02", "2024-01-02 00:00:00", "x"), (2, None, " 300 ", "n/a", "", "03/04/2024", None, None)]
B = [(3, "a+b %", "bad", None, "9", "2024-05-06", "2024-01-02 03:00:00", "long note"), (4, "c", "-5", "1e3", "x", None, None, "")]


def same(spark, root, at, spec=SPEC, version=None):
    want = P.profile(TB.read_table(spark, root, version=version), spec).orderBy("column_name").collect()
    got = KP.kept_profile(spark, root, at, spec, version).orderBy("column_name").collect()
    assert got == want
    return want


def measured(spark, at):
    return sorted((r["folder"], r["column_id"]) for r in TB.read_table(spark, at).collect())


def test_follows_loads(spark, tmp_root):
    root, at = f"{tmp_root}/t", f"{tmp_root}/p"
    TB.create(rows(spark, *A), root, "g")
    KP.refresh_profile(spark, root, at, SPEC)
    same(spark, root, at)
    first = measured(spark, at)
    assert len(first) == 2 * len(SPEC.columns)
    TB.append(rows(spark, *B), root)
    with pytest.raises(TB.LoadError, match="refresh"):
        KP.kept_profile(spark, root, at, SPEC)
    same(spark, root, at, version=1)  # an older version still has all its measures
    KP.refresh_profile(spark, root, at, SPEC)
    after = measured(spark, at)
    assert len(after) == 4 * len(SPEC.columns) and set(first) < set(after)
    got = {r["column_name"]: r for r in same(spark, root, at)}
    assert got["n"]["failed"] == 1 and got["at"]["has_time"] and got["note"]["max_len"] == 9
    TB.replace(spark, root, rows(spark, B[0]), None, ["a+b %"])
    KP.refresh_profile(spark, root, at, SPEC)
    assert {r["column_name"]: r for r in same(spark, root, at)}["n"]["n"] == 3
    again = TB.versions(spark, at)
    KP.refresh_profile(spark, root, at, SPEC)
    assert TB.versions(spark, at) == again  # nothing to do


def test_reads_new_folders_only(spark, tmp_root):
    root, at = f"{tmp_root}/t", f"{tmp_root}/p"
    TB.create(rows(spark, *A), root, "g")
    KP.refresh_profile(spark, root, at, SPEC)
    old = TB.manifest(spark, root).folders()
    TB.append(rows(spark, *B), root)
    # what was measured before is gone from the disk: only a reader would miss it
    for folder in old:
        import shutil

        shutil.rmtree(f"{root}/{folder}")
    KP.refresh_profile(spark, root, at, SPEC)
    assert {r["column_name"]: r["n"] for r in KP.kept_profile(spark, root, at, SPEC).collect()} == {c.name: 4 for c in SPEC.columns}


def test_columns_change(spark, tmp_root):
    root, at = f"{tmp_root}/t", f"{tmp_root}/p"
    TB.create(rows(spark, *A), root, "g")
    KP.refresh_profile(spark, root, at, SPEC)
    before = measured(spark, at)
    TB.evolve(spark, root, ("rename", "note", "remark"), ("drop", "amount"), ("add", "amount", "string"))
    spec = TableSpec("t", tuple(c if c.name != "note" else parse_columns("remark:VARCHAR(2)")[0] for c in SPEC.columns))
    KP.refresh_profile(spark, root, at, spec)
    got = {r["column_name"]: r for r in same(spark, root, at, spec)}
    assert got["amount"]["nulls"] == 2 and got["remark"]["max_len"] == 1
    assert len(measured(spark, at)) == len(before) + 2  # the new column only
    wide = spec.with_types({"n": "DOUBLE"})
    KP.refresh_profile(spark, root, at, wide)
    assert len(measured(spark, at)) == len(before) + 4
    same(spark, root, at, wide)
    same(spark, root, at, spec)


def test_refreshed_twice_at_once(spark, tmp_root):
    root, at = f"{tmp_root}/t", f"{tmp_root}/p"
    TB.create(rows(spark, *A), root, "g")
    KP.refresh_profile(spark, root, at, SPEC)
    TB.append(TB.read_table(spark, at), at)  # as if a second refresh had written the same measures
    same(spark, root, at)


def test_empty_table(spark, tmp_root):
    root, at = f"{tmp_root}/t", f"{tmp_root}/p"
    TB.create(rows(spark, *A).where(F.lit(False)), root, "g")
    KP.refresh_profile(spark, root, at, SPEC)
    assert all(r["n"] == 0 for r in same(spark, root, at))


def test_wide_table(spark, tmp_root):
    spec = TableSpec("w", parse_columns(", ".join(f"c{i}:SMALLINT" for i in range(60))))
    root, at = f"{tmp_root}/t", f"{tmp_root}/p"
    df = spark.range(20).select(*[(F.col("id") * i * 100).cast("int").alias(f"c{i}") for i in range(60)], (F.col("id") % 3).cast("string").alias("g"))
    TB.create(df, root, "g")
    KP.refresh_profile(spark, root, at, spec)
    assert sum(r["numeric_overflow"] for r in same(spark, root, at, spec)) == 42
