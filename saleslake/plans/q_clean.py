"""Queries: cleaning (C1-C5, A7) and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.operators import clean as C
from saleslake.operators import kept as KP
from saleslake.operators import profile as P
from saleslake.operators import table as TB
from saleslake.operators.project import rename_to_spec
from saleslake.plans import specs as SP
from saleslake.plans import standins as S
from saleslake.plans.oracle_parts import (
    DUCK_DATE_FORMATS, d_blank_null, d_choice, d_failed, d_to_date, d_to_double, d_to_int,
)
from saleslake.plans.registry import query
from saleslake.session import scratch_path

_R = f"r AS ({S.RAW_LINES_SQL})"


@query(
    "clean_int",
    f"WITH {_R} SELECT invoicekey AS k, quantity AS raw, {d_to_int('quantity')} AS quantity FROM r",
)
def q_clean_int(spark, sf):
    r = S.raw_lines(spark, sf)
    return r.select(F.col("invoicekey").alias("k"), F.col("quantity").alias("raw"), C.to_int(F.col("quantity")).alias("quantity"))


@query(
    "clean_double",
    f"WITH {_R} SELECT invoicekey AS k, value AS raw, {d_to_double('value')} AS value FROM r",
)
def q_clean_double(spark, sf):
    r = S.raw_lines(spark, sf)
    return r.select(F.col("invoicekey").alias("k"), F.col("value").alias("raw"), C.to_double(F.col("value")).alias("value"))


def _d_date_choice(col: str) -> str:
    fails = [d_failed(col, f"try_strptime({col}, '{f}')") for f in DUCK_DATE_FORMATS]
    return f"(SELECT {d_choice(fails, 'count(*)')} AS k FROM r)"


def _d_date_pick(col: str, kcol: str) -> str:
    whens = " ".join(f"WHEN {i + 1} THEN {d_to_date(col, f)}" for i, f in enumerate(DUCK_DATE_FORMATS))
    return f"(CASE {kcol} {whens} END)"


_D_FMT_NAME = "(CASE c.k " + " ".join(f"WHEN {i + 1} THEN '{f}'" for i, f in enumerate(DUCK_DATE_FORMATS)) + " END)"


@query(
    "clean_date_first_format",
    f"""WITH {_R}, c AS {_d_date_choice('shipdate')}
SELECT invoicekey AS k, shipdate AS raw, {_D_FMT_NAME} AS date_format,
       CAST({_d_date_pick('shipdate', 'c.k')} AS VARCHAR) AS ship_date
FROM r, c""",
)
def q_clean_date_first_format(spark, sf):
    r = S.raw_lines(spark, sf)
    chosen = C.choose_date_formats(r, ["shipdate"])["shipdate"]
    if chosen is None:
        raise C.ConversionError("shipdate: no date format fits")
    label, pattern = chosen
    return r.select(
        F.col("invoicekey").alias("k"), F.col("shipdate").alias("raw"), F.lit(label).alias("date_format"),
        C.to_date(F.col("shipdate"), pattern).cast("string").alias("ship_date"),
    )


_INT_COLS = ("quantity", "salesgroupcode", "bigqty")
_DBL_COLS = ("value", "discount")
_DATE_COLS = ("shipdate", "invoicedate")


def _d_rate_rows() -> str:
    parts = []
    for c in _INT_COLS:
        parts.append(f"SELECT '{c}' AS column_name, 'INTEGER' AS target, n, z_{c} AS nulls, f_{c} AS failed, "
                     f"CAST(NULL AS VARCHAR) AS date_format FROM s")
    for c in _DBL_COLS:
        parts.append(f"SELECT '{c}', 'DOUBLE', n, z_{c}, f_{c}, CAST(NULL AS VARCHAR) FROM s")
    for c in _DATE_COLS:
        fails = [f"f_{c}_{k}" for k in range(len(DUCK_DATE_FORMATS))]
        k = d_choice(fails)
        fmt = "(CASE " + k + " " + " ".join(f"WHEN {i + 1} THEN '{f}'" for i, f in enumerate(DUCK_DATE_FORMATS)) + " END)"
        pick = "(CASE " + k + " " + " ".join(f"WHEN {i + 1} THEN {f}" for i, f in enumerate(fails)) + f" ELSE n - z_{c} END)"
        parts.append(f"SELECT '{c}', 'DATE', n, z_{c}, {pick}, {fmt} FROM s")
    return "\nUNION ALL\n".join(parts)


def _d_rate_aggs() -> str:
    a = ["count(*) AS n"]
    for c in _INT_COLS:
        a += [f"count(*) FILTER (WHERE {c} IS NULL) AS z_{c}", f"{d_failed(c, d_to_int(c))} AS f_{c}"]
    for c in _DBL_COLS:
        a += [f"count(*) FILTER (WHERE {c} IS NULL) AS z_{c}", f"{d_failed(c, d_to_double(c))} AS f_{c}"]
    for c in _DATE_COLS:
        a.append(f"count(*) FILTER (WHERE {c} IS NULL) AS z_{c}")
        for k, f in enumerate(DUCK_DATE_FORMATS):
            a.append(f"{d_failed(c, f'try_strptime({c}, {chr(39)}{f}{chr(39)})')} AS f_{c}_{k}")
    return ",\n  ".join(a)


@query(
    "clean_failure_rate",
    f"""WITH {_R}, s AS (SELECT {_d_rate_aggs()} FROM r),
rows AS ({_d_rate_rows()})
SELECT column_name, target, n, nulls, failed, date_format,
       CAST(failed AS DOUBLE) * 100.0 / CAST(n AS DOUBLE) AS failed_pct, failed * 10 > n AS over_limit
FROM rows""",
)
def q_clean_failure_rate(spark, sf):
    return C.failure_rates(S.raw_lines(spark, sf), _INT_COLS, _DBL_COLS, _DATE_COLS)


_SOFT_INT = ("quantity", "linenumber")
_SOFT_DBL = ("value", "discount")
_SOFT_DATE = ("shipdate", "invoicedate")


def _d_soft() -> str:
    a = ["count(*) AS n"]
    rows = []
    for c in _SOFT_INT:
        a.append(f"{d_failed(c, d_to_int(c))} AS i_{c}")
        rows.append(f"SELECT '{c}' AS column_name, 'INTEGER' AS target, i_{c} AS failed, "
                    f"CASE WHEN i_{c} = 0 THEN 'converted' ELSE 'kept_string' END AS outcome, "
                    f"CAST(NULL AS VARCHAR) AS date_format FROM s")
    for c in _SOFT_DBL:
        a.append(f"{d_failed(c, d_to_double(c))} AS d_{c}")
        rows.append(f"SELECT '{c}', 'DOUBLE', d_{c}, CASE WHEN d_{c} = 0 THEN 'converted' ELSE 'kept_string' END, "
                    f"CAST(NULL AS VARCHAR) FROM s")
    for c in _SOFT_DATE:
        fails = []
        for k, f in enumerate(DUCK_DATE_FORMATS[:4]):
            a.append(f"{d_failed(c, f'try_strptime({c}, {chr(39)}{f}{chr(39)})')} AS t_{c}_{k}")
            fails.append(f"t_{c}_{k}")
        k = d_choice(fails)
        fmt = "(CASE " + k + " " + " ".join(f"WHEN {i + 1} THEN '{f}'" for i, f in enumerate(DUCK_DATE_FORMATS[:4])) + " END)"
        pick = "(CASE " + k + " " + " ".join(f"WHEN {i + 1} THEN {f}" for i, f in enumerate(fails)) + " END)"
        rows.append(f"SELECT '{c}', 'DATE', {pick}, CASE WHEN {k} IS NOT NULL THEN 'converted' ELSE 'kept_string' END, {fmt} FROM s")
    return f"WITH {_R}, s AS (SELECT {', '.join(a)} FROM r)\n" + "\nUNION ALL\n".join(rows)


@query("clean_soft_convert", _d_soft())
def q_clean_soft_convert(spark, sf):
    return C.soft_convert_plan(S.raw_lines(spark, sf), _SOFT_INT, _SOFT_DBL, _SOFT_DATE)


# --- profiles: DuckDB forms of the per-column statistics -----------------------

_RANGES = {"TINYINT": (-128, 127), "SMALLINT": (-32768, 32767), "INT": (-2147483648, 2147483647),
           "BIGINT": (-9223372036854775808, 9223372036854775807)}
_UPG = {"TINYINT": ["SMALLINT", "INT", "BIGINT", "LARGEINT"], "SMALLINT": ["INT", "BIGINT", "LARGEINT"],
        "INT": ["BIGINT", "LARGEINT"], "BIGINT": ["LARGEINT"]}


def _d_fits(mn: str, mx: str, fam: str) -> str:
    if fam == "LARGEINT":
        return "TRUE"
    lo, hi = _RANGES[fam]
    return f"({mn} >= CAST('{lo}' AS HUGEINT) AND {mx} <= CAST('{hi}' AS HUGEINT))"


def _d_upgrade(mn: str, mx: str, fam: str) -> str:
    whens = " ".join(f"WHEN {_d_fits(mn, mx, t)} THEN '{t}'" for t in _UPG[fam])
    return f"(CASE WHEN NOT coalesce({_d_fits(mn, mx, fam)}, FALSE) THEN (CASE {whens} END) END)"


def _d_int_stats(src: str, col: str, fam: str, conv: str | None) -> str:
    v = f"CAST({conv or col} AS HUGEINT)"
    mn, mx = f"min({v})", f"max({v})"
    return (f"SELECT '{col}' AS column_name, '{fam}' AS declared, CAST({mn} AS VARCHAR) AS min_val, "
            f"CAST({mx} AS VARCHAR) AS max_val, coalesce(NOT {_d_fits(mn, mx, fam)}, FALSE) AS numeric_overflow, "
            f"{_d_upgrade(mn, mx, fam)} AS proposed FROM {src}")


def _d_varchar(src: str, col: str, limit: int) -> str:
    ml = f"CAST(max(length({col})) AS INTEGER)"
    ovf = f"coalesce({ml} > {limit}, FALSE)"
    rec = f"least(({ml} * 6) // 5, 5000)"
    return (f"SELECT '{col}' AS column_name, {limit} AS declared_limit, {ml} AS max_len, {ovf} AS varchar_overflow, "
            f"CAST(CASE WHEN {ovf} THEN {rec} END AS INTEGER) AS recommended, "
            f"CASE WHEN {ovf} THEN {ml} > 5000 END AS exceeds_cap FROM {src}")


_DOC_VARCHARS = [("text", 2000), ("lang", 2), ("source", 8)]


@query("profile_varchar_overflow", "\nUNION ALL\n".join(_d_varchar("documents", c, n) for c, n in _DOC_VARCHARS))
def q_profile_varchar_overflow(spark, sf):
    prof = P.profile(S.read(spark, sf, "documents"), SP.DOCUMENTS)
    return prof.where(F.col("declared").startswith("VARCHAR")).select(
        "column_name", "declared_limit", "max_len", "varchar_overflow", "recommended", "exceeds_cap"
    )


_LINE_INT_DECL = [(c.name, c.type) for c in SP.LINE_INTS.columns]


@query(
    "profile_numeric_overflow",
    f"WITH li AS ({S.LINE_INTS_SQL})\n" + "\nUNION ALL\n".join(_d_int_stats("li", c, t, None) for c, t in _LINE_INT_DECL),
)
def q_profile_numeric_overflow(spark, sf):
    prof = P.profile(S.line_ints(spark, sf), SP.LINE_INTS)
    return prof.select("column_name", "declared", "min_val", "max_val", "numeric_overflow", "proposed")


def _d_fact_lines_upgrades() -> str:
    src = "r"
    rows = []
    for c in SP.FACT_LINES.columns:
        raw = c.incoming()
        fam = c.family
        if fam in _RANGES:
            conv = d_to_int(raw)
            v = f"CAST({conv} AS HUGEINT)"
            rows.append(f"SELECT '{c.name}' AS column_name, '{c.type}' AS declared, "
                        f"{_d_upgrade(f'min({v})', f'max({v})', fam)} AS proposed FROM {src}")
        elif fam == "VARCHAR":
            ml = f"max(length({raw}))"
            rows.append(f"SELECT '{c.name}', '{c.type}', CASE WHEN {ml} > {c.limit} THEN "
                        f"'VARCHAR(' || CAST(least(({ml} * 6) // 5, 5000) AS VARCHAR) || ')' END FROM {src}")
        elif fam == "FLOAT":
            rows.append(f"SELECT '{c.name}', '{c.type}', 'DOUBLE'")
        else:
            rows.append(f"SELECT '{c.name}', '{c.type}', CAST(NULL AS VARCHAR)")
    return f"WITH {_R}\n" + "\nUNION ALL\n".join(rows)


@query("profile_type_upgrade", _d_fact_lines_upgrades())
def q_profile_type_upgrade(spark, sf):
    df = rename_to_spec(S.raw_lines(spark, sf), SP.FACT_LINES)
    return P.profile(df, SP.FACT_LINES).select("column_name", "declared", "proposed")


_D_EVENTS = f"""WITH e AS ({S.EVENTS_SQL}),
s AS (SELECT bool_or(ts <> date_trunc('day', ts)) AS ht_ts, bool_or(day_ts <> date_trunc('day', day_ts)) AS ht_day,
             CAST(max(length(event_type)) AS INTEGER) AS ml,
             min(user_id) AS mn_u, max(user_id) AS mx_u FROM e)
SELECT 'event_id' AS column_name, 'BIGINT' AS declared, 'BIGINT' AS data_type, CAST(NULL AS BOOLEAN) AS has_time,
       CAST(NULL AS VARCHAR) AS proposed FROM s
UNION ALL SELECT 'ts', 'DATE', 'DATETIME', coalesce(ht_ts, FALSE), CASE WHEN coalesce(ht_ts, FALSE) THEN 'DATETIME' END FROM s
UNION ALL SELECT 'day_ts', 'DATE', 'DATETIME', coalesce(ht_day, FALSE), CASE WHEN coalesce(ht_day, FALSE) THEN 'DATETIME' END FROM s
UNION ALL SELECT 'user_id', 'INT', 'BIGINT', NULL, {_d_upgrade('CAST(mn_u AS HUGEINT)', 'CAST(mx_u AS HUGEINT)', 'INT')} FROM s
UNION ALL SELECT 'event_type', 'VARCHAR(20)', 'VARCHAR', NULL,
       CASE WHEN ml > 20 THEN 'VARCHAR(' || CAST(least((ml * 6) // 5, 5000) AS VARCHAR) || ')' END FROM s
UNION ALL SELECT 'value', 'FLOAT', 'DOUBLE', NULL, 'DOUBLE' FROM s"""


@query("profile_date_has_time", _D_EVENTS)
def q_profile_date_has_time(spark, sf):
    prof = P.profile(S.events(spark, sf), SP.EVENTS)
    return prof.select("column_name", "declared", "data_type", "has_time", "proposed")


def _d_issues() -> str:
    rows = []
    for c in SP.FACT_LINES.columns:
        raw = c.incoming()
        fam = c.family
        if fam in _RANGES:
            v = f"CAST({d_to_int(raw)} AS HUGEINT)"
            mn, mx = f"min({v})", f"max({v})"
            up = _d_upgrade(mn, mx, fam)
            rows.append(f"SELECT '{c.name}' AS column_name, 'numeric_overflow' AS issue, CASE WHEN NOT {_d_fits(mn, mx, fam)} "
                        f"THEN '[' || CAST({mn} AS VARCHAR) || ', ' || CAST({mx} AS VARCHAR) || '] outside {c.type}' END AS detail FROM r")
            rows.append(f"SELECT '{c.name}', 'type_upgrade', CASE WHEN {up} IS NOT NULL THEN '{c.type} -> ' || {up} END FROM r")
            rows.append(f"SELECT '{c.name}', 'conversion_failures', CASE WHEN {d_failed(raw, d_to_int(raw))} * 10 > count(*) "
                        f"THEN CAST({d_failed(raw, d_to_int(raw))} AS VARCHAR) || ' of ' || CAST(count(*) AS VARCHAR) END FROM r")
            rows.append(f"SELECT '{c.name}', 'type_mismatch', CASE WHEN {d_failed(raw, d_to_int(raw))} > 0 THEN '{c.type}' END FROM r")
        elif fam == "VARCHAR":
            ml = f"max(length({raw}))"
            rows.append(f"SELECT '{c.name}', 'varchar_overflow', CASE WHEN {ml} > {c.limit} THEN 'max ' || CAST({ml} AS VARCHAR) "
                        f"|| ' > {c.limit}' END FROM r")
            rows.append(f"SELECT '{c.name}', 'type_upgrade', CASE WHEN {ml} > {c.limit} THEN '{c.type} -> VARCHAR(' || "
                        f"CAST(least(({ml} * 6) // 5, 5000) AS VARCHAR) || ')' END FROM r")
        elif fam in ("FLOAT", "DOUBLE"):
            f = d_failed(raw, d_to_double(raw))
            rows.append(f"SELECT '{c.name}', 'conversion_failures', CASE WHEN {f} * 10 > count(*) "
                        f"THEN CAST({f} AS VARCHAR) || ' of ' || CAST(count(*) AS VARCHAR) END FROM r")
            rows.append(f"SELECT '{c.name}', 'type_mismatch', CASE WHEN {f} > 0 THEN '{c.type}' END FROM r")
            if fam == "FLOAT":
                rows.append(f"SELECT '{c.name}', 'type_upgrade', '{c.type} -> DOUBLE'")
        elif fam == "DATE":
            fails = [d_failed(raw, f"try_strptime({raw}, '{f}')") for f in DUCK_DATE_FORMATS]
            rows.append(f"SELECT '{c.name}', 'no_date_format', CASE WHEN {d_choice(fails, 'count(*)')} IS NULL "
                        f"THEN 'no format within limit' END FROM r")
    return f"WITH {_R}, x AS (" + "\nUNION ALL\n".join(rows) + ")\nSELECT * FROM x WHERE detail IS NOT NULL"


@query("profile_issues", _d_issues())
def q_profile_issues(spark, sf):
    df = rename_to_spec(S.raw_lines(spark, sf), SP.FACT_LINES)
    return P.issues(P.profile(df, SP.FACT_LINES))


def _d_clean_table() -> str:
    k = _d_date_pick("shipdate", "c.k")
    return f"""WITH {_R}, c AS {_d_date_choice('shipdate')}
SELECT CAST({d_to_int('invoicekey')} AS BIGINT) AS invoice_key,
       CAST({d_to_int('invoicedate')} AS INTEGER) AS invoice_date,
       CAST({d_to_int('salesgroupcode')} AS SMALLINT) AS sales_group_code,
       recordtype AS record_type,
       {d_to_int('quantity')} AS quantity,
       {d_to_double('value')} AS value,
       CAST({d_to_double('discount')} AS FLOAT) AS discount,
       {k} AS ship_date,
       CAST({d_to_int('linenumber')} AS TINYINT) AS line_number,
       linestatus AS line_status,
       {d_to_int('bigqty')} AS big_qty
FROM r, c"""


@query("clean_table", _d_clean_table())
def q_clean_table(spark, sf):
    typed, _ = P.clean_table(S.raw_lines(spark, sf), SP.FACT_LINES, policy="widen")
    return typed


def _d_wide() -> str:
    rows = []
    for name, kind, _ in S.wide_exprs():
        if kind in _RANGES:
            v = f"CAST({d_to_int(name)} AS HUGEINT)"
            rows.append(f"SELECT '{name}' AS column_name, '{kind}' AS declared, {d_failed(name, d_to_int(name))} AS failed, "
                        f"CAST(NULL AS INTEGER) AS max_len, CAST(min({v}) AS VARCHAR) AS min_val, "
                        f"CAST(max({v}) AS VARCHAR) AS max_val, {_d_upgrade(f'min({v})', f'max({v})', kind)} AS proposed FROM w")
        elif kind == "DOUBLE":
            rows.append(f"SELECT '{name}', '{kind}', {d_failed(name, d_to_double(name))}, CAST(NULL AS INTEGER), "
                        f"CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM w")
        else:
            ml = f"CAST(max(length({name})) AS INTEGER)"
            rows.append(f"SELECT '{name}', '{kind}', CAST(0 AS BIGINT), {ml}, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), "
                        f"CASE WHEN {ml} > 12 THEN 'VARCHAR(' || CAST(least(({ml} * 6) // 5, 5000) AS VARCHAR) || ')' END FROM w")
    return f"WITH w AS ({S.WIDE_SQL})\n" + "\nUNION ALL\n".join(rows)


def _d_empty() -> str:
    rows = []
    for c in SP.FACT_LINES.columns:
        raw = c.incoming()
        failed = d_failed(raw, d_to_int(raw)) if c.family in _RANGES else d_failed(raw, d_to_double(raw)) if c.family in ("FLOAT", "DOUBLE") else (
            d_failed(raw, f"try_strptime({raw}, '%Y-%m-%d')") if c.family == "DATE" else "CAST(0 AS BIGINT)")
        rows.append(f"SELECT '{c.name}' AS column_name, rows_of, count(*) FILTER (WHERE here) AS n, ({failed.replace('(WHERE', '(WHERE here AND')}) AS failed FROM x GROUP BY rows_of")
    return (f"WITH r AS ({S.RAW_LINES_SQL}), x AS (SELECT *, 'all' AS rows_of, TRUE AS here FROM r UNION ALL SELECT *, 'none', quantity = 'never' FROM r)\n"
            + "\nUNION ALL\n".join(rows))


@query("profile_empty_table", _d_empty())
def q_profile_empty_table(spark, sf):
    """a file without rows that pass has a profile row for every column and cleans, like the whole one."""
    out = None
    for name, rows in (("all", S.raw_lines(spark, sf)), ("none", S.raw_lines(spark, sf).where("quantity = 'never'"))):
        typed, prof = P.clean_table(rows, SP.FACT_LINES, policy="widen")
        if typed.columns != SP.FACT_LINES.names:
            raise AssertionError("columns lost")
        some = prof.select("column_name", F.lit(name).alias("rows_of"), "n", "failed")
        out = some if out is None else out.unionByName(some)
    return out


_DEC_TEXT = "CAST(p_partkey AS STRING) || '2345678901234567.' || lpad(CAST(p_partkey % 10000 AS STRING), 10, '1')"


@query(
    "clean_decimal",
    f"SELECT p_partkey, CAST(CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE {_DEC_TEXT} END AS DECIMAL(38,10)) AS amount FROM part",
)
def q_clean_decimal(spark, sf):
    """C2 for exact types: all 38 digits of the text arrive."""
    text = S.read(spark, sf, "part").selectExpr("CAST(p_partkey AS STRING) AS partkey", f"CASE WHEN p_partkey % 11 = 0 THEN 'n/a' ELSE {_DEC_TEXT} END AS amount")
    typed, _ = P.clean_table(text, SP.DECIMALS)
    return typed.select(F.col("part_key").alias("p_partkey"), "amount")


def _d_quarantine() -> str:
    lost = []
    for c in SP.FACT_LINES.columns:
        raw, fam = c.incoming(), c.family
        name = {"BIGINT": "BIGINT", "INT": "INTEGER", "SMALLINT": "SMALLINT", "TINYINT": "TINYINT"}.get(fam)
        if name:
            conv = f"TRY_CAST({d_to_int(raw)} AS {name})"
        elif fam in ("DOUBLE", "FLOAT"):
            conv = f"TRY_CAST({d_to_double(raw)} AS {fam})"
        elif fam == "DATE":
            conv = f"try_strptime({raw}, '%Y-%m-%d')"
        else:
            continue
        lost.append(f"CASE WHEN {raw} IS NOT NULL AND {conv} IS NULL THEN '{c.name}' END")
    return (f"WITH {_R} SELECT invoicekey AS k, array_to_string(list_filter([{', '.join(lost)}], lambda x: x IS NOT NULL), ',') "
            "AS failed_columns FROM r")


@query("clean_quarantine", _d_quarantine())
def q_clean_quarantine(spark, sf):
    """Every row is converted or set aside with the columns that failed."""
    good, bad, _ = P.clean_quarantine(S.raw_lines(spark, sf), SP.FACT_LINES)
    return good.select(F.col("invoice_key").cast("string").alias("k"), F.lit("").alias("failed_columns")).unionByName(
        bad.select(F.col("invoice_key").alias("k"), F.array_join("failed_columns", ",").alias("failed_columns")))


@query("clean_soft_applied", f"""WITH {_R}, f AS (SELECT {d_failed('quantity', d_to_int('quantity'))} AS q, {d_failed('linenumber', d_to_int('linenumber'))} AS l,
  {d_failed('value', d_to_double('value'))} AS v, {d_failed('discount', d_to_double('discount'))} AS d FROM r)
SELECT invoicekey, CASE WHEN q > 0 THEN quantity ELSE CAST({d_to_int('quantity')} AS VARCHAR) END AS quantity,
       {d_to_int('linenumber')} AS linenumber, CASE WHEN v > 0 THEN value ELSE CAST({d_to_double('value')} AS VARCHAR) END AS value,
       {d_to_double('discount')} AS discount, CAST(try_strptime(shipdate, '%Y-%m-%d') AS DATE) AS shipdate FROM r, f""")
def q_clean_soft_applied(spark, sf):
    """C4 applied: columns that convert without loss are converted, the others stay text."""
    cols = ["invoicekey", "quantity", "linenumber", "value", "discount", "shipdate"]
    return C.soft_convert(S.raw_lines(spark, sf).select(*cols), ("quantity", "linenumber"), ("value", "discount"), ("shipdate",))


@query("profile_wide_table", _d_wide())
def q_profile_wide_table(spark, sf):
    """A2-A8 over a 200-column all-string table in one aggregation pass."""
    prof = P.profile(S.wide(spark, sf), SP.wide_spec())
    return prof.select("column_name", "declared", "failed", "max_len", "min_val", "max_val", "proposed")


# --- A2-A8, A10: a profile kept beside a table ------------------------------------------

_KEPT_FINAL = (f"SELECT * FROM ({S.fact_sql(S.SECONDARY_GROUP)}) WHERE NOT (ship_ymd < {S.CUTOFF_YMD} "
               "AND (sales_group_code IN (1, 2, 3) OR sales_group_code IS NULL))")


def _d_kept() -> str:
    out = []
    for c in SP.FACT_NARROW.columns:
        n = f"SELECT '{c.name}' AS column_name, count(*) AS n, count(*) - count({c.name}) AS nulls, "
        if c.family in _RANGES:
            lo, hi = f"min({c.name})", f"max({c.name})"
            n += (f"CAST(NULL AS INTEGER) AS max_len, CAST({lo} AS VARCHAR) AS min_val, CAST({hi} AS VARCHAR) AS max_val, "
                  f"{_d_upgrade(f'CAST({lo} AS HUGEINT)', f'CAST({hi} AS HUGEINT)', c.family)} AS proposed")
        elif c.family == "VARCHAR":
            ml = f"CAST(max(length({c.name})) AS INTEGER)"
            n += f"{ml} AS max_len, NULL AS min_val, NULL AS max_val, CASE WHEN {ml} > {c.limit} THEN 'VARCHAR(' || CAST(({ml} * 6) // 5 AS VARCHAR) || ')' END AS proposed"
        else:
            n += "CAST(NULL AS INTEGER) AS max_len, NULL AS min_val, NULL AS max_val, 'DOUBLE' AS proposed"
        out.append(n + " FROM f")
    return f"WITH f AS ({_KEPT_FINAL})\n" + "\nUNION ALL\n".join(out)


@query("profile_kept", _d_kept())
def q_profile_kept(spark, sf):
    """After a first load, an append and a replacement the kept profile is that of all rows; each refresh reads new folders only."""
    f = S.facts(spark, sf)
    root, at = scratch_path(spark, "kept_table"), scratch_path(spark, "kept_profile")
    g, late = F.col("sales_group_code"), F.col("ship_ymd") >= S.CUTOFF_YMD
    TB.create(f.where(~late), root, "sales_group_code")
    KP.refresh_profile(spark, root, at, SP.FACT_NARROW)
    TB.append(f.where(late & ~g.isin(1, 2, 3)), root)
    KP.refresh_profile(spark, root, at, SP.FACT_NARROW)
    TB.replace(spark, root, f.where(late & (g.isin(1, 2, 3) | g.isNull())), None, [1, 2, 3, None])
    KP.refresh_profile(spark, root, at, SP.FACT_NARROW)
    return KP.kept_profile(spark, root, at, SP.FACT_NARROW).select("column_name", "n", "nulls", "max_len", "min_val", "max_val", "proposed")
