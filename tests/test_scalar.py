from pyspark.sql import functions as F

from saleslake.functions import scalar as X
from saleslake.functions.arrays import drop_adjacent_repeats


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_email_path_id(spark):
    got = _one(spark, X.email_path_id, [
        " John.Doe@Corp.example ", "x@y", "xQatRy", "a-b c@d.e", "José@x.y", None, "", "  ", "a+b@c.d",
    ])
    assert got == ["john_dot_doe_at_corp_dot_example", "x_at_y", "xqatry", "a_b_c_at_d_dot_e",
                   "josé_at_x_dot_y", "", "", "", "ab_at_c_dot_d"]


def test_strip_is_unicode_aware(spark):
    got = _one(spark, X.strip, ["  12 \t", "　x "])
    assert got == ["12", "x"]
    assert _one(spark, X.blank_to_null, [" ", "", " a "]) == [None, None, "a"]


def test_type_text_helpers(spark):
    assert _one(spark, X.varchar_limit, ["VARCHAR(118)", "varchar(5)", "INT"]) == [118, 5, None]
    assert _one(spark, X.base_type, ["decimal(10,2)", " smallint "]) == ["DECIMAL", "SMALLINT"]


def test_human_units(spark):
    counts = _one(spark, X.human_count, [999, 1000, 1250, 99_949, 100_000, 9_999_999, 12_345_678], "long")
    assert counts == ["999", "1.0K", "1.3K", "99.9K", "1.0 lakh", "100.0 lakh", "1.23 crore"]
    sizes = _one(spark, X.human_bytes, [512, 1536, 5 * 1024 * 1024, 3 * 1024 ** 3], "long")
    assert sizes == ["512 B", "1.50 KB", "5.00 MB", "3.00 GB"]


def test_drop_adjacent_repeats(spark):
    rows = [(["a", "a", "a"],), (["a", "b", "a"],), (["a", "", "a"],), (["", "x"],), ([],)]
    df = spark.createDataFrame(rows, "v array<string>")
    got = [r[0] for r in df.select(drop_adjacent_repeats(F.col("v"))).collect()]
    assert got == [["a"], ["a", "b", "a"], ["a", "a"], ["x"], []]
