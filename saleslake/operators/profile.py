"""Column profile (A2-A8) and the whole-table clean.

``profile(df, spec)`` is one aggregation for each 25 columns, stacked into one
row per declared column: rows, NULLs, conversion failures, chosen date
format, max text length, min/max of integers, whether DATE data carries a
time.  Overflow flags and proposed wider types are column expressions over
that frame, so the profile stays a lazy DataFrame; ``clean_table`` collects
it (one row per column, bounded by the spec) to decide the projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.operators.clean import (
    DATE_FORMATS, ConversionError, decimal_of, double_of, first_fitting, int_like, int_of, is_double, stripped, to_date,
)
from saleslake.operators.project import data_family, rename_to_spec
from saleslake.session import scratch_path
from saleslake.spec import (
    ALLOWED_UPGRADES, INT_FAMILIES, INT_RANGES, VARCHAR_CAP, VARCHAR_WIDEN_FACTOR, TableSpec, spark_type,
)

_NUMERIC = INT_FAMILIES + ("FLOAT", "DOUBLE", "DECIMAL")
_DEC = "decimal(38,0)"


def _fits(mn: Column, mx: Column, fam: str) -> Column:
    lo, hi = INT_RANGES[fam]
    if lo is None:
        return F.lit(True)
    return (mn >= F.lit(lo).cast(_DEC)) & (mx <= F.lit(hi).cast(_DEC))


def _int_upgrade(mn: Column, mx: Column, fam: str) -> Column:
    """A5: first allowed wider integer type that holds [min, max]."""
    expr = F.lit(None).cast("string")
    for t in reversed([t for t in ALLOWED_UPGRADES.get(fam, ()) if t in INT_RANGES]):
        expr = F.when(_fits(mn, mx, t), F.lit(t)).otherwise(expr)
    return expr


def _plan(df: DataFrame, spec: TableSpec) -> list:
    """Per present column: (column, declared, data family, conversion kind)."""
    types = {f.name.lower(): (f.name, f.dataType) for f in df.schema.fields}
    out = []
    for c in spec.columns:
        hit = types.get(c.name.lower())
        if hit is None:
            continue
        actual, dt = hit
        d = data_family(dt)
        t = c.family
        kind = None
        if d == "VARCHAR" and t in INT_FAMILIES:
            kind = "int"
        elif d == "VARCHAR" and t == "DECIMAL":
            kind = "decimal"
        elif d == "VARCHAR" and t in ("FLOAT", "DOUBLE"):
            kind = "double"
        elif d == "VARCHAR" and t in ("DATE", "DATETIME"):
            kind = "date"
        out.append((c, actual, d, kind))
    return out


# Columns profiled by one aggregate.  HotSpot compiles no method beyond 8000 bytes of code, so what a value needs is kept
# small: 25 text columns of mixed kinds make methods of up to 6,500 (tested).
PROFILE_GROUP = 25


def profile(df: DataFrame, spec: TableSpec) -> DataFrame:
    """A2-A8; one row per declared column present in ``df``, for tables of any width and size.

    One aggregate with buffers for thousands of columns would outgrow
    generated code, so columns are profiled in groups of ``PROFILE_GROUP``,
    each by one aggregation that reads only its own columns (on Parquet the
    groups together read every column once).  An aggregate without keys has a
    row for an empty table, too.
    """
    plan = _plan(df, spec)
    groups = [plan[i : i + PROFILE_GROUP] for i in range(0, len(plan), PROFILE_GROUP)] or [[]]
    stacked = [_profile_group(df, g) for g in groups]
    out = stacked[0]
    for s in stacked[1:]:
        out = out.unionByName(s)
    return _finish(out)


_STATS = ("column_name string, declared string, data_type string, nulls long, failed long, date_format string, max_len int, "
          "declared_limit int, min_val string, max_val string, numeric_overflow boolean, has_time boolean, type_upgrade string")


def _profile_group(df: DataFrame, plan: list) -> DataFrame:
    """A2-A8 of some columns in one aggregation."""
    if not plan:
        return df.sparkSession.createDataFrame([], f"n long, {_STATS}")
    return judged(measured(df, plan), plan)


def measured(df: DataFrame, plan: list, keys: list[str] | None = None) -> DataFrame:
    """What the profile needs of some columns, by ``keys``: rows and, per column, NULLs, failures, extremes.

    The columns are ``n`` and, for the i-th of the plan, ``z{i}``, ``f{i}_{k}``
    (failures, of each date format), ``mn{i}``, ``mx{i}``, ``ml{i}`` and ``ht{i}``
    where they apply; all of them can be added up or merged by min and max.

    A first projection strips the texts of exact numbers, a second computes
    each conversion (``_v{i}``, ``_ok{i}``, ``_bad{i}_{k}``, ``_len{i}``); the
    aggregate then only counts, mins and maxes plain columns, so nothing is
    evaluated twice.
    """
    keys = keys or []
    own = [F.col(f"`{k}`") for k in keys]
    pre = list(own)
    aggs = [F.count(F.lit(1)).alias("n")]
    source = lambda i: F.col(f"`{plan[i][1]}`")
    large = lambda i: plan[i][0].family == "LARGEINT"
    numbers = {f"_s{i}": source(i) for i, (_, _, _, kind) in enumerate(plan) if kind == "decimal" or kind == "int" and large(i)}
    df = stripped(df, numbers, [*own, *[source(i).alias(f"_r{i}") for i in range(len(plan)) if f"_s{i}" not in numbers]])
    for i, (c, _, d, kind) in enumerate(plan):
        # a stripped text is NULL where the text is
        raw = F.col(f"_s{i}" if f"_s{i}" in numbers else f"_r{i}")
        t = c.family
        pre.append(raw.isNull().alias(f"_null{i}"))
        aggs.append(F.count_if(F.col(f"_null{i}")).alias(f"z{i}"))
        v = F.col(f"_v{i}")
        if kind == "int":
            pre.append((int_of(raw, large=True) if large(i) else int_like(raw)).alias(f"_v{i}"))
            aggs += [F.count_if(~F.col(f"_null{i}") & v.isNull()).alias(f"f{i}_0"),
                     F.min(v).cast(_DEC).alias(f"mn{i}"), F.max(v).cast(_DEC).alias(f"mx{i}")]
        elif kind == "double":
            pre.append(is_double(raw).alias(f"_ok{i}"))
            aggs.append(F.count_if(~F.col(f"_ok{i}")).alias(f"f{i}_0"))
        elif kind == "decimal":
            pre.append(decimal_of(raw, spark_type(c.type)).alias(f"_v{i}"))
            aggs.append(F.count_if(~F.col(f"_null{i}") & v.isNull()).alias(f"f{i}_0"))
        elif kind == "date":
            with_time = t == "DATETIME"
            for k, (_, p) in enumerate(DATE_FORMATS):
                pre.append(to_date(raw, p, with_time).isNull().alias(f"_bad{i}_{k}"))
                aggs.append(F.count_if(~F.col(f"_null{i}") & F.col(f"_bad{i}_{k}")).alias(f"f{i}_{k}"))
        elif t in INT_FAMILIES and d in INT_FAMILIES + ("DECIMAL",):
            pre.append(raw.alias(f"_v{i}"))
            aggs += [F.min(v).cast(_DEC).alias(f"mn{i}"), F.max(v).cast(_DEC).alias(f"mx{i}")]
        if t == "VARCHAR":
            pre.append(F.length(raw.cast("string")).alias(f"_len{i}"))
            aggs.append(F.max(F.col(f"_len{i}")).alias(f"ml{i}"))
        if t == "DATE" and d == "DATETIME":
            pre.append((raw != F.date_trunc("day", raw)).alias(f"_time{i}"))
            aggs.append(F.bool_or(F.col(f"_time{i}")).alias(f"ht{i}"))
    rows = df.select(*pre)
    return rows.groupBy(*own).agg(*aggs) if keys else rows.agg(*aggs)


def measures(plan: list, i: int) -> dict[str, str]:
    """The columns that ``measured`` has for the i-th of the plan, and how they merge."""
    c, _, d, kind = plan[i]
    t = c.family
    fails = {"int": 1, "double": 1, "decimal": 1, "date": len(DATE_FORMATS)}.get(kind, 0)
    out = {f"z{i}": "sum", **{f"f{i}_{k}": "sum" for k in range(fails)}}
    if kind == "int" or kind is None and t in INT_FAMILIES and d in INT_FAMILIES + ("DECIMAL",):
        out |= {f"mn{i}": "min", f"mx{i}": "max"}
    if t == "VARCHAR":
        out[f"ml{i}"] = "max"
    if t == "DATE" and d == "DATETIME":
        out[f"ht{i}"] = "bool_or"
    return out


def judged(one: DataFrame, plan: list) -> DataFrame:
    """One row per column of the plan from the one row of ``measured``."""
    structs = []
    for i, (c, _, d, kind) in enumerate(plan):
        t, have = c.family, measures(plan, i)
        get = lambda name, kind: F.col(name) if name in have else F.lit(None).cast(kind)  # noqa: B023, E731
        mn, mx, max_len = get(f"mn{i}", _DEC), get(f"mx{i}", _DEC), get(f"ml{i}", "int")
        fail, fmt, has_time = F.lit(0).cast("long"), F.lit(None).cast("string"), F.lit(None).cast("boolean")
        if kind == "date":
            fails = [F.col(f"f{i}_{k}") for k in range(len(DATE_FORMATS))]
            fmt = first_fitting([F.lit(lbl) for lbl, _ in DATE_FORMATS], fails, F.col("n"))
            fail = F.coalesce(first_fitting(fails, fails, F.col("n")), F.col("n") - F.col(f"z{i}"))
        elif kind is not None:
            fail = F.col(f"f{i}_0")
        if f"ht{i}" in have:
            has_time = F.coalesce(F.col(f"ht{i}"), F.lit(False))
        if t in INT_FAMILIES:
            num_ovf = F.coalesce(~_fits(mn, mx, t), F.lit(False))
            upgrade = F.when(num_ovf, _int_upgrade(mn, mx, t))
        else:
            num_ovf = F.lit(False)
            upgrade = F.lit(None).cast("string")
        if t == "FLOAT" and (d == "DOUBLE" or kind == "double"):
            # cleaned strings become doubles, so a FLOAT column asks for DOUBLE
            upgrade = F.lit("DOUBLE")
        if t == "DATE" and d == "DATETIME":
            upgrade = F.when(has_time, F.lit("DATETIME"))
        structs.append(F.struct(
            F.lit(c.name).alias("column_name"), F.lit(c.type).alias("declared"), F.lit(d).alias("data_type"),
            F.col(f"z{i}").alias("nulls"), fail.cast("long").alias("failed"), fmt.alias("date_format"),
            max_len.alias("max_len"), F.lit(c.limit).cast("int").alias("declared_limit"),
            mn.cast("string").alias("min_val"), mx.cast("string").alias("max_val"),
            num_ovf.alias("numeric_overflow"), has_time.alias("has_time"), upgrade.alias("type_upgrade"),
        ))
    return one.select("n", F.inline(F.array(*structs)))


def _finish(stacked: DataFrame) -> DataFrame:
    """Overflow flags, recommendations and the proposed type from the per-column stats."""
    a, b = VARCHAR_WIDEN_FACTOR
    rec_raw = F.floor(F.col("max_len") * a / b).cast("int")
    vovf = F.coalesce(F.col("max_len") > F.col("declared_limit"), F.lit(False))
    return stacked.select(
        "column_name", "declared", "data_type", "n", "nulls", "failed", "date_format",
        (F.col("failed") * 10 > F.col("n")).alias("over_limit"),
        "max_len", "declared_limit", vovf.alias("varchar_overflow"),
        F.when(vovf, F.least(rec_raw, F.lit(VARCHAR_CAP))).alias("recommended"),
        F.when(vovf, F.col("max_len") > F.lit(VARCHAR_CAP)).alias("exceeds_cap"),
        "min_val", "max_val", "numeric_overflow", "has_time",
        F.when(vovf, F.concat(F.lit("VARCHAR("), F.least(rec_raw, F.lit(VARCHAR_CAP)).cast("string"), F.lit(")")))
        .otherwise(F.col("type_upgrade")).alias("proposed"),
    )


def issues(prof: DataFrame) -> DataFrame:
    """The profile as a list of issues ``(column, issue, detail)``.

    ``type_mismatch``: text that is no number in a column declared numeric.
    """
    detail_v = F.concat(F.lit("max "), F.col("max_len").cast("string"), F.lit(" > "), F.col("declared_limit").cast("string"))
    detail_n = F.concat(F.lit("["), F.col("min_val"), F.lit(", "), F.col("max_val"), F.lit("] outside "), F.col("declared"))
    detail_f = F.concat(F.col("failed").cast("string"), F.lit(" of "), F.col("n").cast("string"))
    num_decl = F.upper(F.split_part(F.col("declared"), F.lit("("), F.lit(1)))
    mismatch = (F.col("data_type") == "VARCHAR") & num_decl.isin(*_NUMERIC, "INTEGER") & (F.col("failed") > 0)
    items = F.array(
        F.struct(F.lit("varchar_overflow").alias("issue"), F.when(F.col("varchar_overflow"), detail_v).alias("detail")),
        F.struct(F.lit("numeric_overflow").alias("issue"), F.when(F.col("numeric_overflow"), detail_n).alias("detail")),
        F.struct(F.lit("conversion_failures").alias("issue"), F.when(F.col("over_limit"), detail_f).alias("detail")),
        F.struct(F.lit("no_date_format").alias("issue"),
                 F.when((F.col("data_type") == "VARCHAR") & num_decl.isin("DATE", "DATETIME") & F.col("date_format").isNull(),
                        F.lit("no format within limit")).alias("detail")),
        F.struct(F.lit("type_mismatch").alias("issue"), F.when(mismatch, F.col("declared")).alias("detail")),
        F.struct(F.lit("type_upgrade").alias("issue"),
                 F.when(F.col("proposed").isNotNull(), F.concat(F.col("declared"), F.lit(" -> "), F.col("proposed"))).alias("detail")),
    )
    return prof.select("column_name", F.inline(items)).where(F.col("detail").isNotNull())


POLICIES = ("raise", "widen", "quarantine")


def _decided(df: DataFrame, spec: TableSpec, policy: str):
    """(renamed frame with stripped texts, profile, errors, [(column, incoming, converted)]) of a clean under ``policy``."""
    if policy not in POLICIES:
        raise ValueError(f"policy is one of {POLICIES}, not {policy!r}")
    df = rename_to_spec(df, spec)
    prof_lazy = profile(df, spec)
    rows = prof_lazy.collect()          # one row per declared column
    prof = df.sparkSession.createDataFrame(rows, prof_lazy.schema)
    by_col = {r["column_name"]: r for r in rows}
    errors = []
    for r in rows:
        if r["over_limit"] and policy != "quarantine":
            errors.append(f"{r['column_name']}: {r['failed']} of {r['n']} values failed conversion")
        if r["data_type"] == "VARCHAR" and spec.column(r["column_name"]).family in ("DATE", "DATETIME") and r["date_format"] is None:
            errors.append(f"{r['column_name']}: no date format fits")
        if r["numeric_overflow"] and policy == "raise":
            errors.append(f"{r['column_name']}: values [{r['min_val']}, {r['max_val']}] overflow {r['declared']}")
    plan = _plan(df, spec)
    texts = {f"_s{i}": F.col(f"`{actual}`") for i, (_, actual, _, kind) in enumerate(plan) if kind in ("int", "double", "decimal")}
    df = stripped(df, texts, [F.col(f"`{c}`") for c in df.columns])
    cols = []
    for i, (c, actual, d, kind) in enumerate(plan):
        raw, s = F.col(f"`{actual}`"), F.col(f"_s{i}")
        r = by_col[c.name]
        target = spark_type(c.type)
        if r["numeric_overflow"] and policy == "widen" and r["proposed"]:
            target = spark_type(r["proposed"])
        if kind == "int":
            e = int_of(s, large=isinstance(target, T.DecimalType))
        elif kind == "decimal":
            e = decimal_of(s, target)
        elif kind == "double":
            e = double_of(s)
        elif kind == "date" and r["date_format"] is not None:
            e = to_date(raw, dict(DATE_FORMATS)[r["date_format"]], c.family == "DATETIME")
        else:
            e = raw
        cols.append((c, raw, (e.try_cast(target) if policy == "quarantine" else e.cast(target)).alias(c.name)))
    return df, prof, errors, cols


def clean_table(df: DataFrame, spec: TableSpec, policy: str = "raise") -> tuple[DataFrame, DataFrame]:
    """C5 + C6: rename, convert every string column to its declared type.

    ``policy``: ``raise`` (conversion over the limit, missing date format or
    numeric overflow raise; VARCHAR overflow is only reported), or ``widen``
    (numeric overflow casts to the proposed wider type instead).  For
    ``quarantine`` see ``clean_quarantine``.
    Returns ``(typed frame in table order, profile frame)``.
    """
    if policy == "quarantine":
        raise ValueError("clean_quarantine returns the rejected rows as well")
    df, prof, errors, cols = _decided(df, spec, policy)
    if errors:
        raise ConversionError("; ".join(errors))
    return df.select(*[e for _, _, e in cols]), prof


def clean_quarantine(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame, DataFrame]:
    """C6 quarantine: rows with a value that does not convert or fit go aside.

    Returns ``(typed good rows, incoming bad rows with ``failed_columns``,
    profile)``; every row is in one of the first two, which read a table
    staged in the shared folder.  A column without a usable date format still
    raises: no row of it could pass.
    """
    incoming = [F.col(f"`{c}`") for c in rename_to_spec(df, spec).columns]
    df, prof, errors, cols = _decided(df, spec, "quarantine")
    if errors:
        raise ConversionError("; ".join(errors))
    # converted once, then judged
    df = df.select(*incoming, *[e.alias(f"_v{i}") for i, (_, _, e) in enumerate(cols)])
    lost = [F.when(raw.isNotNull() & F.col(f"_v{i}").isNull(), F.lit(c.name)) for i, (c, raw, _) in enumerate(cols)]
    lost += [F.when(F.col(f"_v{i}").isNull() & raw.isNull(), F.lit(c.name)) for i, (c, raw, _) in enumerate(cols) if not c.nullable]
    marked = df.withColumn("failed_columns", F.filter(F.array(*lost), lambda x: x.isNotNull()))
    # staged, for a filter on the verdict would move below the conversions and repeat them, for each side:
    # the converted values of good rows, the incoming ones of bad rows
    bad = F.size("failed_columns") > 0
    fields = marked.schema.fields
    rejected = {f"r{i}": f for i, f in enumerate(fields[: len(incoming)])}
    typed = {f"v{i}": T.StructField(c.name, fields[len(incoming) + i].dataType) for i, (c, _, _) in enumerate(cols)}
    kept = lambda f: not isinstance(f.dataType, T.NullType)
    staged = marked.select(
        *[F.when(bad, c).alias(n) for (n, f), c in zip(rejected.items(), incoming) if kept(f)],
        *[F.when(~bad, F.col(f"_{n}")).alias(n) for n, f in typed.items() if kept(f)], F.when(bad, F.col("failed_columns")).alias("failed"))
    path = scratch_path(df.sparkSession, "quarantine")
    staged.write.parquet(path)
    back = df.sparkSession.read.schema(staged.schema).parquet(path)
    out = lambda of: [(F.col(n) if kept(f) else F.lit(None)).alias(f.name) for n, f in of.items()]
    good = back.where(F.col("failed").isNull()).select(*out(typed))
    return good, back.where(F.col("failed").isNotNull()).select(*out(rejected), F.col("failed").alias("failed_columns")), prof
