"""Stand-ins: the reference's tables built from the driver's tables.

The reference ships no data, so every query reads the driver's TPC-H-like
tables and derives the reference's shapes from them (see FIXTURES.md §A).
Dirty values come from deterministic ``key % k`` expressions.  Each stand-in
is written once as portable SQL expression text, so the Spark side
(``selectExpr``) and the DuckDB oracle build exactly the same input rows;
the operator under test is then written independently on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _select_sql(exprs: list[tuple[str, str]]) -> str:
    return ",\n  ".join(f"{e} AS {n}" for n, e in exprs)


# --- dim_hierarchy: customer x nation x region --------------------------------

_ASM = "'asm+' || CAST(c_custkey % 13 AS STRING) || '@corp.example'"
_HEAD = "'Head.' || lower(r_name) || '@Corp.example'"


def _gone(k: int, expr: str) -> str:
    """Every 37th customer keeps only sh_2 (its path is then too short)."""
    return f"CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE {expr} END"


HIERARCHY_EXPRS: list[tuple[str, str]] = [
    ("hier_key", "c_custkey"),
    ("cluster_code", "r_name"),
    ("division_code", "n_regionkey"),
    ("sales_group", "n_nationkey"),
    ("wss_territory_code",
     "CASE WHEN c_custkey % 29 = 0 THEN '' ELSE 'WSS' || CAST(c_custkey % 97 AS STRING) END"),
    ("txn_type",
     "CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 10 = 3 THEN 'Distributor' "
     "ELSE 'Sales Hierarchy - ' || c_mktsegment END"),
    ("sh_2_email",
     f"CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 17 = 1 THEN '' ELSE {_HEAD} END"),
    ("sh_3_email", _gone(37,
     f"CASE WHEN c_custkey % 9 = 2 THEN upper({_HEAD}) WHEN c_custkey % 9 = 4 THEN NULL "
     "ELSE ' nsm-' || lower(n_name) || '@corp.example ' END")),
    ("sh_4_email", _gone(37,
     "CASE WHEN c_custkey % 19 = 0 THEN 'x@y' WHEN c_custkey % 19 = 1 THEN 'xQatRy' "
     "WHEN c_custkey % 7 = 5 THEN '   ' "
     "ELSE 'zm ' || CAST(c_nationkey % 3 AS STRING) || '@corp.example' END")),
    ("sh_5_email", _gone(37, f"CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE {_ASM} END")),
    ("sh_6_email", _gone(37,
     f"CASE WHEN c_custkey % 6 = 1 THEN {_ASM} "
     "WHEN c_custkey % 6 = 2 THEN 'José.' || CAST(c_custkey % 5 AS STRING) || '@corp.example' "
     "ELSE 'tsi_' || CAST(c_custkey % 41 AS STRING) || '@corp.example' END")),
    ("sh_7_email", _gone(37,
     f"CASE WHEN c_custkey % 8 = 3 THEN {_ASM} WHEN c_custkey % 8 = 5 THEN NULL "
     "ELSE 'rep.' || CAST(c_custkey AS STRING) || '@corp.example' END")),
]

HIERARCHY_SQL = (
    "SELECT\n  " + _select_sql(HIERARCHY_EXPRS) + "\nFROM customer\n"
    "JOIN nation ON c_nationkey = n_nationkey\nJOIN region ON n_regionkey = r_regionkey"
)


def hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    base = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return base.selectExpr(*[f"{e} AS {name}" for name, e in HIERARCHY_EXPRS])


# Users who look up their codes: every distinct raw e-mail of levels 4 and 5.
USERS_SQL = (
    f"SELECT DISTINCT email FROM (SELECT sh_4_email AS email FROM ({HIERARCHY_SQL}) "
    f"UNION ALL SELECT sh_5_email AS email FROM ({HIERARCHY_SQL})) WHERE email IS NOT NULL"
)


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = hierarchy(spark, sf_dir)
    e4 = h.selectExpr("sh_4_email AS email")
    e5 = h.selectExpr("sh_5_email AS email")
    return e4.unionByName(e5).where("email IS NOT NULL").distinct()


# --- dirty all-string invoice lines: lineitem as an incoming CSV --------------
# Headers are the incoming (lower-case, no underscore) names of FACT_LINES.

_YMD = "CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER)"

RAW_LINES_EXPRS: list[tuple[str, str]] = [
    ("invoicekey", "CAST(l_orderkey * 10 + l_linenumber AS STRING)"),
    ("invoicedate", f"CASE WHEN l_orderkey % 53 = 0 THEN NULL ELSE CAST({_YMD} AS STRING) END"),
    ("salesgroupcode",
     "CASE WHEN l_orderkey % 43 = 0 THEN NULL WHEN l_orderkey % 31 = 0 THEN ' ' || CAST(l_suppkey % 100 AS STRING) || ' ' "
     "ELSE CAST(l_suppkey % 100 AS STRING) END"),
    ("recordtype",
     "CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_orderkey % 101 = 0 THEN 'DDX' "
     "WHEN l_returnflag = 'R' THEN 'DD' ELSE l_returnflag || l_linestatus END"),
    ("quantity",
     "CASE l_orderkey % 97 WHEN 0 THEN '12.5' WHEN 1 THEN 'abc' WHEN 2 THEN '+7' WHEN 3 THEN '' "
     "WHEN 4 THEN '1e3' WHEN 5 THEN ' 12 ' WHEN 6 THEN '99999999999' "
     "ELSE CAST(CAST(l_quantity AS BIGINT) AS STRING) END"),
    ("value",
     "CASE WHEN l_orderkey % 89 = 0 THEN 'x1' WHEN l_suppkey % 10 = 7 AND l_orderkey % 4 = 1 THEN 'n/a' "
     "ELSE CAST(l_extendedprice AS STRING) END"),
    ("discount", "CAST(l_discount AS STRING)"),
    ("shipdate", "CASE WHEN l_orderkey % 83 = 0 THEN 'soon' ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END"),
    ("linenumber", "CAST(l_linenumber AS STRING)"),
    ("linestatus", "l_linestatus"),
    ("bigqty", "CAST(CAST(l_quantity AS BIGINT) * 100000000 AS STRING)"),
    ("Desc", "l_returnflag"),
]

RAW_LINES_SQL = "SELECT\n  " + _select_sql([(f'"{n}"', e) for n, e in RAW_LINES_EXPRS]) + "\nFROM lineitem"


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incoming all-string file (the generating expressions run after the
    scan is spread, one task per core)."""
    li = read(spark, sf_dir, "lineitem")
    return li.selectExpr(*[f"{e} AS `{n}`" for n, e in RAW_LINES_EXPRS])


# --- integer ranges: lineitem keys against narrow declared types --------------

LINE_INTS_EXPRS: list[tuple[str, str]] = [
    ("l_orderkey", "l_orderkey"),
    ("l_partkey", "l_partkey"),
    ("l_suppkey", "l_suppkey"),
    ("l_linenumber", "l_linenumber"),
    ("v_int", "l_orderkey * 100000"),
    ("v_big", "CAST(l_orderkey AS DECIMAL(38,0)) * CAST(1000000000000000 AS DECIMAL(38,0))"),
    ("v_neg", "l_linenumber - 130"),
]
LINE_INTS_SQL = "SELECT\n  " + _select_sql(LINE_INTS_EXPRS) + "\nFROM lineitem"


def line_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in LINE_INTS_EXPRS])


# --- events with a day-truncated copy of the timestamp -------------------------

EVENTS_EXPRS: list[tuple[str, str]] = [
    ("event_id", "event_id"),
    ("ts", "ts"),
    ("day_ts", "date_trunc('day', ts)"),
    ("user_id", "user_id"),
    ("event_type", "event_type"),
    ("value", "value"),
]
EVENTS_SQL = "SELECT\n  " + _select_sql(EVENTS_EXPRS) + "\nFROM events"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").selectExpr(*[f"{e} AS {n}" for n, e in EVENTS_EXPRS])


# --- typed facts: lineitem as fact_invoice_secondary / fact_invoice_details ----

_SHIP_YMD = "CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INTEGER)"
CUTOFF_YMD = 19960101   # rows shipped before it form the existing table; the rest are "new files"


def fact_exprs(group_expr: str) -> list[tuple[str, str]]:
    return [
        ("invoice_key", "l_orderkey * 10 + l_linenumber"),
        ("sales_group_code", f"CAST({group_expr} AS SMALLINT)"),
        ("record_type",
         "CASE WHEN l_orderkey % 13 = 0 THEN NULL WHEN l_returnflag = 'R' THEN 'DD' "
         "ELSE l_returnflag || l_linestatus END"),
        ("value", "l_extendedprice"),
        ("ship_ymd", _SHIP_YMD),
    ]


# every 41st order has no sales group
SECONDARY_GROUP = "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE l_suppkey % 100 END"
DETAILS_GROUP = "CASE WHEN l_orderkey % 41 = 0 THEN NULL ELSE 100 * (1 + l_suppkey % 9) + l_suppkey % 13 END"


def fact_sql(group_expr: str) -> str:
    return "SELECT\n  " + _select_sql(fact_exprs(group_expr)) + "\nFROM lineitem"


def facts(spark: SparkSession, sf_dir: str, group_expr: str = SECONDARY_GROUP) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {n}" for n, e in fact_exprs(group_expr)])


# --- customer master as an incoming file with drifted headers -------------------

RAW_CUSTOMER_EXPRS: list[tuple[str, str]] = [
    ("Customer Name", "c_name"),
    ("customercode", "c_custkey"),
    ("nation code", "c_nationkey"),
    ("acct bal", "c_acctbal"),
    ("MarketSegment", "c_mktsegment"),
    ("customer group", "'CG-' || CAST(c_custkey % 7 AS STRING)"),
    ("customergroup", "CAST(c_custkey % 5 AS STRING)"),
    ("Div", "CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'D' || CAST(c_nationkey AS STRING) END"),
    ("Select", "c_mktsegment || '/' || CAST(c_nationkey AS STRING)"),
]
RAW_CUSTOMER_SQL = "SELECT\n  " + _select_sql([(f'"{n}"', e) for n, e in RAW_CUSTOMER_EXPRS]) + "\nFROM customer"


def raw_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(*[f"{e} AS `{n}`" for n, e in RAW_CUSTOMER_EXPRS])


# --- sales-group seed file: nation x region -------------------------------------

SEED_EXPRS: list[tuple[str, str]] = [
    ("SalesGroup", "CAST(100 + n_nationkey AS STRING)"),
    ("Division", "r_name"),
    ("Vertical",
     "CASE WHEN n_nationkey % 6 = 1 THEN 'FV – ' || n_name "
     "WHEN n_nationkey % 6 = 2 THEN n_name || chr(39) || 's line' ELSE n_name END"),
    ("Remarks",
     "CASE WHEN n_nationkey % 4 = 0 THEN '' WHEN n_nationkey % 4 = 1 THEN '   ' ELSE 'ok ' || n_name END"),
]
SEED_SQL = ("SELECT\n  " + _select_sql(SEED_EXPRS)
            + "\nFROM nation JOIN region ON n_regionkey = r_regionkey")


def seed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).selectExpr(*[f"{e} AS {k}" for k, e in SEED_EXPRS])


# --- file names as data: one incoming file per order -----------------------------

FILE_NAME_EXPR = (
    "CASE o_orderkey % 7 "
    "WHEN 0 THEN 'FactInvoiceSecondary_' || CAST(o_custkey % 100 AS STRING) || '_' || CAST(o_orderkey % 9 AS STRING) || '_2024.csv.gz' "
    "WHEN 1 THEN 'FactInvoiceDetails_107_112_' || CAST(o_orderkey AS STRING) || '.csv' "
    "WHEN 2 THEN 'FactInvoiceDetails_' || CAST(o_custkey % 100 AS STRING) || '.csv' "
    "WHEN 3 THEN 'DimMaterialMapping_' || CAST(o_orderkey AS STRING) || '.csv' "
    "WHEN 4 THEN 'DimMaterial_' || CAST(o_orderkey AS STRING) || '.csv' "
    "WHEN 5 THEN 'dimdealer_' || CAST(o_orderkey AS STRING) || '.csv' "
    "ELSE 'SalesTargetPlan_' || o_orderpriority || '.csv' END"
)
FILE_NAMES_SQL = f"SELECT o_orderkey, {FILE_NAME_EXPR} AS name FROM orders"


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{FILE_NAME_EXPR} AS name")


# --- a wide all-string table (the width of the widest fact, ~200 columns) -------

WIDE_COLUMNS = 200
_WIDE_KINDS = ("SMALLINT", "INT", "BIGINT", "DOUBLE", "VARCHAR(12)")


def wide_exprs() -> list[tuple[str, str, str]]:
    """``(name, declared type, SQL expression)``: column i cycles through five kinds."""
    out = []
    for i in range(WIDE_COLUMNS):
        kind = _WIDE_KINDS[i % len(_WIDE_KINDS)]
        m = 10 ** (i % 6 + 2)
        if kind == "DOUBLE":
            e = f"CAST(l_extendedprice * {i % 9 + 1} AS STRING)"
        elif kind.startswith("VARCHAR"):
            e = f"repeat('x', CAST((l_orderkey + {i}) % {i % 15 + 2} AS INT))"
        else:
            e = f"CAST((l_orderkey * {i + 1} + l_linenumber) % {m} AS STRING)"
        e = f"CASE WHEN (l_orderkey + {i}) % 53 = 0 THEN 'n/a' ELSE {e} END"
        out.append((f"w{i:03d}", kind, e))
    return out


WIDE_SQL = "SELECT\n  " + _select_sql([(n, e) for n, _, e in wide_exprs()]) + "\nFROM lineitem"


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "lineitem").selectExpr(*[f"{e} AS {n}" for n, _, e in wide_exprs()])
