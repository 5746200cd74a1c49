import re

import pytest
from pyspark.sql import functions as F

from saleslake.functions.scalar import WS_CHARS
from saleslake.operators import clean as C
from saleslake.operators import profile as P
from saleslake.plans import standins as S
from saleslake.spec import TableSpec, parse_columns


def test_numeric_strings(spark):
    vals = ["12", " 12 ", "12.5", "", "  ", "abc", "+7", "1e3", "99999999999", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    ints = [r[0] for r in df.select(C.to_int(F.col("v"))).collect()]
    assert ints == [12, 12, None, None, None, None, 7, None, 99999999999, None]
    dbl = [r[0] for r in df.select(C.to_double(F.col("v"))).collect()]
    assert dbl == [12.0, 12.0, 12.5, None, None, None, 7.0, 1000.0, 99999999999.0, None]


def _rate_frame(spark, bad):
    rows = [("x",) if i < bad else (str(i),) for i in range(100)]
    return spark.createDataFrame(rows, "v string")


def test_failure_limit_10_passes_11_raises(spark):
    spec = TableSpec("t", parse_columns("v:INT"))
    typed, prof = P.clean_table(_rate_frame(spark, 10), spec)
    r = prof.collect()[0]
    assert (r["failed"], r["over_limit"]) == (10, False)
    assert typed.where(F.col("v").isNull()).count() == 10
    with pytest.raises(C.ConversionError):
        P.clean_table(_rate_frame(spark, 11), spec)


def test_blank_counts_as_failure(spark):
    rows = [("",)] * 11 + [("5",)] * 89
    spec = TableSpec("t", parse_columns("v:BIGINT"))
    with pytest.raises(C.ConversionError):
        P.clean_table(spark.createDataFrame(rows, "v string"), spec)


def test_date_first_format_within_limit(spark):
    # 05/01/2024 fits both d/m and m/d: the list order gives d/m.
    rows = [("05/01/2024",), ("31/12/2023",), ("12/31/2023",)] + [("01/02/2024",)] * 27
    df = spark.createDataFrame(rows, "v string")
    assert C.choose_date_formats(df, ["v"])["v"][0] == "%d/%m/%Y"
    iso = spark.createDataFrame([("2024-01-05",), ("2024-01-05 10:11:12",), ("",), (None,)] + [("2024-02-01",)] * 20, "v string")
    assert C.choose_date_formats(iso, ["v"])["v"][0] == "%Y-%m-%d"
    junk = spark.createDataFrame([("soon",)] * 5 + [("20240105",)] * 5, "v string")
    assert C.choose_date_formats(junk, ["v"])["v"] is None
    spec = TableSpec("t", parse_columns("v:DATE"))
    with pytest.raises(C.ConversionError):
        P.clean_table(junk, spec)


def test_soft_convert_keeps_strings(spark):
    df = spark.createDataFrame([("1", "1.5", "2024-01-01"), ("x", "2", "soon")], "a string, b string, c string")
    plan = {r["column_name"]: r["outcome"] for r in C.soft_convert_plan(df, ["a"], ["b"], ["c"]).collect()}
    assert plan == {"a": "kept_string", "b": "converted", "c": "kept_string"}


def test_wide_strings_and_cap(spark):
    rows = [("a" * 10, "é" * 11, "x" * 4200)]
    spec = TableSpec("t", parse_columns("a:VARCHAR(10), b:VARCHAR(10), c:VARCHAR(100)"))
    prof = {r["column_name"]: r for r in P.profile(spark.createDataFrame(rows, "a string, b string, c string"), spec).collect()}
    assert prof["a"]["varchar_overflow"] is False and prof["a"]["proposed"] is None
    assert prof["b"]["max_len"] == 11            # characters, not bytes
    assert prof["b"]["recommended"] == 13 and prof["b"]["proposed"] == "VARCHAR(13)"
    assert prof["c"]["recommended"] == 5000 and prof["c"]["exceeds_cap"] is False
    big = spark.createDataFrame([("y" * 5200,)], "c string")
    r = P.profile(big, TableSpec("t", parse_columns("c:VARCHAR(100)"))).collect()[0]
    assert r["recommended"] == 5000 and r["exceeds_cap"] is True


def test_int_ranges_and_upgrades(spark):
    from decimal import Decimal

    df = spark.createDataFrame(
        [(-129, 128, 32768, 2147483648, Decimal("92233720368547758070"))],
        "t long, t2 long, s long, i long, b decimal(38,0)",
    )
    spec = TableSpec("t", parse_columns("t:TINYINT, t2:TINYINT, s:SMALLINT, i:INT, b:BIGINT"))
    prof = {r["column_name"]: r["proposed"] for r in P.profile(df, spec).collect()}
    assert prof == {"t": "SMALLINT", "t2": "SMALLINT", "s": "INT", "i": "BIGINT", "b": "LARGEINT"}


def test_bigint_judged_by_its_own_range(spark):
    df = spark.createDataFrame([(3_000_000_000,)], "v long")
    r = P.profile(df, TableSpec("t", parse_columns("v:BIGINT"))).collect()[0]
    assert r["numeric_overflow"] is False


def test_date_with_time_and_float(spark):
    import datetime as dt

    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0), dt.datetime(2024, 1, 1), 1.5)],
                               "a timestamp_ntz, b timestamp_ntz, f double")
    spec = TableSpec("t", parse_columns("a:DATE, b:DATE, f:FLOAT"))
    prof = {r["column_name"]: (r["has_time"], r["proposed"]) for r in P.profile(df, spec).collect()}
    assert prof == {"a": (True, "DATETIME"), "b": (False, None), "f": (None, "DOUBLE")}


def test_clean_table_widen_policy(spark):
    df = spark.createDataFrame([("70000",), ("1",)], "v string")
    spec = TableSpec("t", parse_columns("v:SMALLINT"))
    with pytest.raises(C.ConversionError):
        P.clean_table(df, spec, policy="raise")
    typed, _ = P.clean_table(df, spec, policy="widen")
    assert dict(typed.dtypes)["v"] == "int"
    assert sorted(r[0] for r in typed.collect()) == [1, 70000]


@pytest.mark.parametrize("width", [1, 24, 25, 26, 41, 203])
def test_profile_is_the_same_at_every_width(spark, width):
    """Groups of columns do not show in the result, with rows and without."""
    cells = ("12", "n/a", "-129", "2024-01-05", "abcdef")
    types = ("TINYINT", "INT", "DOUBLE", "DATE", "VARCHAR(3)")
    spec = TableSpec("t", parse_columns(", ".join(f"c{i}:{types[i % 5]}" for i in range(width))))
    schema = ", ".join(f"c{i} string" for i in range(width))
    rows = [tuple(cells[(i + k) % 5] for i in range(width)) for k in range(3)]
    out = {r["column_name"]: r for r in P.profile(spark.createDataFrame(rows, schema), spec).collect()}
    assert list(out) == spec.names
    for i, c in enumerate(spec.columns):
        alone = P.profile(spark.createDataFrame([(r[i],) for r in rows], f"{c.name} string"), TableSpec("t", (c,))).first() if i < 5 else None
        assert out[c.name] == (alone or out[f"c{i % 5}"]) or i >= 5
    none = spark.createDataFrame([], schema)
    assert [(r["column_name"], r["n"], r["failed"]) for r in P.profile(none, spec).collect()] == [(n, 0, 0) for n in spec.names]
    typed, prof = P.clean_table(none, spec)
    assert typed.columns == spec.names and prof.count() == width and typed.count() == 0


def test_type_mismatch_and_policies(spark):
    spec = TableSpec("t", parse_columns("a:INT, b:DECIMAL(38,10), c:DATE"))
    rows = [(str(i), f"{i}2345678901234567890.0123456789", f"{i + 1}/1/2024") for i in range(19)] + [("x", "0.5", "1/2/2024")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    found = {(r["column_name"], r["issue"]) for r in P.issues(P.profile(df, spec)).collect()}
    assert ("a", "type_mismatch") in found and ("b", "type_mismatch") not in found
    for policy in ("quarantine", "typo"):
        with pytest.raises(ValueError):
            P.clean_table(df, spec, policy=policy)
    good, bad, _ = P.clean_quarantine(df, spec)
    assert good.count() == 19 and [tuple(r) for r in bad.select("a", "failed_columns").collect()] == [("x", ["a"])]
    row = good.where("a = 7").first()
    assert str(row["b"]) == "72345678901234567890.0123456789" and str(row["c"]) == "2024-01-08"


def test_quarantine_converts_once(spark):
    """Neither side converts again to tell its rows; columns of any name, order and type come back."""
    spec = TableSpec("t", parse_columns("a:INT, b:DOUBLE!, c:VARCHAR(3)"))
    rows = [("1", " 2.5\u3000", "x", 7), ("1", "?", "x", 7), (None, "3", None, None), ("\x015", "1", "y", 1), ("", None, "z", 2)]
    df = spark.createDataFrame(rows, "a string, b string, c string, `extra, (d)` int").withColumn("none", F.lit(None))
    df = df.unionByName(df.where("c = 'x' and b like '%5%'"))
    for _ in range(3):  # failures below the limit don't matter here: quarantine takes any share
        df = df.unionByName(df)
    good, bad, _ = P.clean_quarantine(df, spec)
    assert sorted(map(tuple, good.distinct().collect()), key=str) == [(1, 2.5, "x"), (None, 3.0, None)] and good.count() == 24
    got = {tuple(r)[:-1]: r["failed_columns"] for r in bad.collect()}
    assert got == {("1", "?", "x", 7, None): ["b"], ("\x015", "1", "y", 1, None): ["a"], ("", None, "z", 2, None): ["a", "b"]} and bad.count() == 24
    for side in (good, bad):
        assert "RLIKE" not in side._jdf.queryExecution().optimizedPlan().toString()


def test_no_date_format_fits(spark):
    """Then there is no format, and every value that is not NULL has failed."""
    df = spark.createDataFrame([("2024-01-05",), ("abcdef",), ("12",), (None,)], "d string")
    prof = P.profile(df, TableSpec("t", parse_columns("d:DATE"))).first()
    assert (prof["failed"], prof["date_format"], prof["over_limit"]) == (3, None, True)
    rate = C.failure_rates(df, date_cols=["d"]).first()
    assert (rate["failed"], rate["date_format"], rate["over_limit"]) == (3, None, True)
    soft = C.soft_convert_plan(df, date_cols=["d"]).first()
    assert (soft["failed"], soft["date_format"], soft["outcome"]) == (None, None, "kept_string")


def test_texts_without_anything_to_strip_are_passed_on(spark):
    """The strip is asked for only where a text holds more than visible ASCII; what is stripped does not change."""
    texts = ["12", " 12", "12\n", "\u300012\u2028", "1 2", "", " ", None, "\x0112", "é", "~!"]
    df = C.stripped(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), {"s": F.col("t")}, [F.col("i")])
    assert [r["s"] for r in df.orderBy("i").collect()] == ["12", "12", "12", "12", "1 2", "", "", None, "\x0112", "é", "~!"]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") < plan.index("trim(")


def test_profile_of_odd_numbers_is_that_of_stripped_texts(spark):
    """Failures and extremes against Python's strip and patterns, whether or not a text is taken as it stands."""
    texts = ["12", " 7", "-12\n", "　15 ", "+3\x85", "1 2", "", " ", None, "\x0112", "12\x00", "\x7f9", "é", "~!", "12.5", "1.", ".5", "-.5e-3", ".", "+", "1e5",
             "1E+999999999999", "1e", "0x1p3", "1d", "NaN", "inf", "1_000", "٣", "99999999999999999999", "-9223372036854775808", "9223372036854775808", "12\n\n", "12\n3", "1.5\r\n", "\t2.5e3\x1c"]
    df = spark.createDataFrame([(t, t, t) for t in texts], "i string, d string, l string")
    got = {r["column_name"]: r for r in P.profile(df, TableSpec("t", parse_columns("i:INT, d:DOUBLE, l:LARGEINT"))).collect()}
    stripped = [t.strip(WS_CHARS) for t in texts if t is not None]
    whole = [int(s) for s in stripped if re.fullmatch(r"[+-]?[0-9]+", s)]
    for name, values in (("i", [v for v in whole if -(2**63) <= v < 2**63]), ("l", whole)):
        r = got[name]
        assert (r["n"], r["nulls"], r["failed"], r["min_val"], r["max_val"]) == (len(texts), 1, len(stripped) - len(values), str(min(values)), str(max(values)))
    numbers = [s for s in stripped if re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", s)]
    assert got["d"]["failed"] == len(stripped) - len(numbers)
    assert got["d"]["failed"] == df.where(F.col("d").isNotNull() & C.to_double(F.col("d")).isNull()).count()


def test_code_of_a_full_group_can_be_compiled(spark, tmp_root, capfd):
    """HotSpot interprets methods beyond 8000 bytes; a group of as many mixed text columns as there may be stays below."""
    exprs = S.wide_exprs()[: P.PROFILE_GROUP]
    spark.range(100).selectExpr("id AS l_orderkey", "CAST(id % 7 AS INT) AS l_linenumber", "id * 1.5D AS l_extendedprice").write.parquet(f"{tmp_root}/lines")
    rows = spark.read.parquet(f"{tmp_root}/lines").selectExpr(*[f"{e} AS {n}" for n, _, e in exprs])
    spec = TableSpec("t", parse_columns(", ".join(f"{n}:{t}" for n, t, _ in exprs)))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else the plan has no code before it runs
    try:
        P.measured(rows, P._plan(rows, spec)).explain(mode="codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capfd.readouterr().out)]
    assert sizes and max(sizes) <= 8000, sizes
