"""Queries: filters, projections, order/limit/union/count, seeds, routing, listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.functions import naming as N
from saleslake.functions.scalar import human_count
from saleslake.operators import filters as FL
from saleslake.operators import load as L
from saleslake.operators.order import numbered
from saleslake.operators.project import rename_to_spec, select_table_order
from saleslake.plans import specs as SP
from saleslake.plans import standins as S
from saleslake.plans.oracle_parts import d_strip, d_to_int
from saleslake.plans.registry import query
from saleslake.session import hadoop_fs, scratch_path
from saleslake.sources import files as SRC
from saleslake.sources import seeds as SEED
from saleslake.spec import DIM_SALES_GROUP

# --- F1/F2 date floors ------------------------------------------------------------

_FLOOR = 19960331   # a floor inside the driver data (the reference default is 20230331)

_RAW_COLS = [n for n, _ in S.RAW_LINES_EXPRS]


def _q(cols):
    return ", ".join(f'"{c}"' for c in cols)


@query(
    "filter_date_floor_secondary",
    f"""WITH r AS ({S.RAW_LINES_SQL})
SELECT {_q([c for c in _RAW_COLS if c != 'invoicedate'])}, CAST(invoicedate AS INTEGER) AS invoicedate
FROM r WHERE CAST(invoicedate AS INTEGER) > {_FLOOR}""",
)
def q_filter_date_floor_secondary(spark, sf):
    return FL.date_floor(S.raw_lines(spark, sf), "invoicedate", _FLOOR)


_POSTING = "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)"


@query(
    "filter_date_floor_details",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS ordernumber, CAST({_POSTING} AS INTEGER) AS postingdate,
       CAST(o_totalprice AS VARCHAR) AS netvalue
FROM orders WHERE CAST(CAST({_POSTING} AS VARCHAR) AS INTEGER) > {_FLOOR}""",
)
def q_filter_date_floor_details(spark, sf):
    raw = S.read(spark, sf, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS ordernumber",
        f"CAST({_POSTING} AS STRING) AS postingdate",
        "CAST(o_totalprice AS STRING) AS netvalue",
    )
    return FL.date_floor(raw, "postingdate", _FLOOR)


# --- P1/P5/P7 projections ----------------------------------------------------------

_D_RENAMED = f"""WITH r AS ({S.RAW_CUSTOMER_SQL})
SELECT "Customer Name" AS customer_name, customercode AS customer_code, "nation code" AS nation_code,
       "acct bal" AS account_balance, MarketSegment AS market_segment, "customer group" AS cm_customer_group,
       customergroup AS customer_group, Div AS div_col_rf, "Select" AS Select_raw
FROM r"""


@query("proj_rename_mapping", _D_RENAMED)
def q_proj_rename_mapping(spark, sf):
    return rename_to_spec(S.raw_customer(spark, sf), SP.DIM_CUSTOMER)


@query(
    "proj_table_order",
    f"""WITH x AS ({_D_RENAMED})
SELECT customer_code, customer_name, nation_code, account_balance, market_segment, customer_group,
       cm_customer_group, div_col_rf, CAST(NULL AS VARCHAR) AS phone FROM x""",
)
def q_proj_table_order(spark, sf):
    renamed = rename_to_spec(S.raw_customer(spark, sf), SP.DIM_CUSTOMER)
    return select_table_order(renamed, SP.DIM_CUSTOMER, fill_missing=True)


# --- O1 load order, O2 slice, U1 union, A1 counts ------------------------------------

_FACT_PREFIX = "Fact"


@query(
    "sort_load_order",
    f"""WITH f AS ({S.FILE_NAMES_SQL})
SELECT name, starts_with(name, '{_FACT_PREFIX}') AS is_fact,
       row_number() OVER (ORDER BY starts_with(name, '{_FACT_PREFIX}'), name, o_orderkey) AS place FROM f""",
)
def q_sort_load_order(spark, sf):
    """O1: dimension files first, facts last, each by name (a distributed sort)."""
    f = S.file_names(spark, sf)
    out = f.select("name", F.col("name").startswith(_FACT_PREFIX).alias("is_fact"), "o_orderkey")
    return numbered(out, ["is_fact", "name", "o_orderkey"], "place").drop("o_orderkey")


@query(
    "limit_slice",
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 50 OFFSET 100",
)
def q_limit_slice(spark, sf):
    """O2: a slice of a total order (offset + limit is the feature; top-k plan)."""
    o = S.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.orderBy("o_orderkey").offset(100).limit(50)


@query(
    "union_chunks",
    "SELECT o_orderkey, o_custkey, o_totalprice, coalesce(o_orderstatus, '?') AS chunk FROM orders",
)
def q_union_chunks(spark, sf):
    """Chunks (one per order status) unioned by name."""
    o = S.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    chunks = [
        o.where(F.col("o_orderstatus") == s).select("o_orderkey", "o_custkey", "o_totalprice", F.lit(s).alias("chunk"))
        for s in ("F", "O", "P")
    ]
    rest = o.where(~F.coalesce(F.col("o_orderstatus").isin("F", "O", "P"), F.lit(False)))
    chunks.append(rest.select("o_orderkey", "o_custkey", "o_totalprice", F.coalesce("o_orderstatus", F.lit("?")).alias("chunk")))
    out = chunks[0]
    for c in chunks[1:]:
        out = out.unionByName(c)
    return out


@query(
    "agg_row_count",
    "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in S.TABLES),
)
def q_agg_row_count(spark, sf):
    """Row count per registered table (one small job per table, unioned)."""
    parts = [spark.read.parquet(f"{sf}/{t}.parquet").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "n_rows") for t in S.TABLES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _d_human_count(n: str) -> str:
    def fixed(units: str, dec: int) -> str:
        scale = 10 ** dec
        return (f"CAST({units} // {scale} AS VARCHAR) || '.' || lpad(CAST({units} % {scale} AS VARCHAR), {dec}, '0')")

    k = f"(({n}) * 2 + 100) // 200"
    lakh = f"(({n}) * 2 + 10000) // 20000"
    crore = f"(({n}) * 2 + 100000) // 200000"
    return (f"CASE WHEN {n} < 1000 THEN CAST({n} AS VARCHAR) WHEN {n} < 100000 THEN {fixed(k, 1)} || 'K' "
            f"WHEN {n} < 10000000 THEN {fixed(lakh, 1)} || ' lakh' ELSE {fixed(crore, 2)} || ' crore' END")


@query(
    "inventory_counts",
    "WITH c AS (" + "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in S.TABLES)
    + f")\nSELECT table_name, n_rows, {_d_human_count('n_rows')} AS rows_text FROM c",
)
def q_inventory_counts(spark, sf):
    """Rows per input file with human units (K / lakh / crore)."""
    counts = q_agg_row_count(spark, sf)
    return counts.select("table_name", "n_rows", human_count(F.col("n_rows")).alias("rows_text"))


# --- S8/K10/K12 seeds -------------------------------------------------------------


def _write_seed(spark, sf):
    path = scratch_path(spark, "seed")
    S.seed_rows(spark, sf).coalesce(1).write.option("header", True).option("escape", '"').csv(path)
    return path


@query(
    "seed_blank_to_null",
    f"""WITH s AS ({S.SEED_SQL})
SELECT SalesGroup, Division, Vertical, CASE WHEN {d_strip('Remarks')} <> '' THEN Remarks END AS Remarks FROM s""",
)
def q_seed_blank_to_null(spark, sf):
    return SEED.read_seed(spark, _write_seed(spark, sf))


@query(
    "seed_load",
    f"""WITH s AS ({S.SEED_SQL})
SELECT Division AS division, CAST({d_to_int('SalesGroup')} AS SMALLINT) AS sales_group, Vertical AS vertical FROM s""",
)
def q_seed_load(spark, sf):
    root = scratch_path(spark, "dim_sales_group")
    SEED.load_seed(spark, _write_seed(spark, sf), DIM_SALES_GROUP, root)
    return L.read_current(spark, root)


# --- P12-P14 routing, S3 listing, S4 missing files -----------------------------------


def _d_snake(x: str) -> str:
    s = f"regexp_replace({x}, '(.)([A-Z][a-z]+)', '\\1_\\2', 'g')"
    return f"lower(regexp_replace({s}, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'))"


def _d_table(stem: str) -> str:
    whens = " ".join(
        f"WHEN starts_with({stem}, '{p}') THEN '{N.FILE_PREFIX_TO_TABLE[p]}'"
        for p in sorted(N.FILE_PREFIX_TO_TABLE, key=len, reverse=True)
    )
    return f"(CASE {whens} ELSE {_d_snake(stem)} END)"


def _d_dataset(stem: str) -> str:
    fact = f"regexp_extract({stem}, '^((?:FactInvoiceDetails|FactInvoiceSecondary)(?:_\\d+){{1,2}})_', 1)"
    is_fact = f"(contains({stem}, 'FactInvoiceDetails') OR contains({stem}, 'FactInvoiceSecondary'))"
    head = f"regexp_replace({stem}, '_.*', '')"
    name = f"(CASE WHEN {is_fact} AND {fact} <> '' THEN {fact} ELSE {head} END)"
    return f"(CASE WHEN lower({name}) = 'dimdealer' THEN 'DimDealerMaster' ELSE {name} END)"


_D_STEM = "regexp_replace(regexp_replace(name, '\\.gz$', '', 'i'), '\\.csv$', '', 'i')"


@query(
    "route_files",
    f"""WITH f AS ({S.FILE_NAMES_SQL}), s AS (SELECT name, {_D_STEM} AS stem FROM f)
SELECT name, stem, {_d_table('stem')} AS table_name, {_d_dataset('stem')} AS dataset,
       array_to_string(string_split(stem, '_')[2:], ',') AS sales_groups
FROM s""",
)
def q_route_files(spark, sf):
    """Table, dataset and sales groups of every incoming file name."""
    f = S.file_names(spark, sf).select("name", N.col_csv_stem(F.col("name")).alias("stem"))
    return f.select(
        "name", "stem",
        N.col_table_from_stem(F.col("stem")).alias("table_name"),
        N.col_dataset_name(F.col("stem")).alias("dataset"),
        F.array_join(N.col_groups_from_stem(F.col("stem")), ",").alias("sales_groups"),
    )


def _written_files(spark, sf):
    """Write CSV files by order status (plus a gzip copy and an empty file)."""
    root = scratch_path(spark, "landing")
    o = S.read(spark, sf, "orders").select("o_orderkey", "o_orderstatus").hint("rebalance", F.col("o_orderstatus"))
    o.write.partitionBy("o_orderstatus").option("header", True).csv(f"{root}/plain")
    o.write.partitionBy("o_orderstatus").option("header", True).option("compression", "gzip").csv(f"{root}/gz")
    fs, _ = hadoop_fs(spark, root)
    fs.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/empty.csv")).close()
    return root


@query(
    "src_file_listing",
    """WITH f AS (SELECT o_orderstatus AS folder, sum(length(CAST(o_orderkey AS VARCHAR)) + 1) AS n FROM orders GROUP BY 1), k AS (SELECT unnest([FALSE, TRUE]) AS is_gzip)
SELECT folder, CASE WHEN NOT is_gzip THEN CAST(n AS BIGINT) END AS data_bytes, is_gzip, FALSE AS is_empty FROM f, k
UNION ALL SELECT '', 0, FALSE, TRUE""",
)
def q_src_file_listing(spark, sf):
    """Bytes of data (without header lines) under the landing folder by sub-folder, gzip and empty files flagged."""
    root = _written_files(spark, sf)
    lst = SRC.file_listing(spark, root, glob="*.csv*")
    return lst.groupBy(
        F.regexp_extract("path", "o_orderstatus=([^/]+)/", 1).alias("folder"),
        F.lower(F.col("name")).endswith(".gz").alias("is_gzip"), (F.col("length") == 0).alias("is_empty"),
    ).agg(F.sum(F.greatest(F.col("length") - len("o_orderkey\n"), F.lit(0))).alias("n")).select(
        "folder", F.when(~F.col("is_gzip"), F.col("n")).alias("data_bytes"), "is_gzip", "is_empty")


_MISSING_SRC = "SELECT 'Orders_' || CAST(o_orderkey AS VARCHAR) AS name FROM orders"
_MISSING_OUT = "SELECT 'Orders_' || CAST(o_orderkey AS VARCHAR) AS name FROM orders WHERE o_orderstatus = 'F'"


@query(
    "src_missing_files_anti",
    f"SELECT s.name FROM ({_MISSING_SRC}) s WHERE NOT EXISTS (SELECT 1 FROM ({_MISSING_OUT}) t WHERE t.name = s.name)",
)
def q_src_missing_files_anti(spark, sf):
    """Incoming files whose output does not exist yet (left anti join on the stem)."""
    o = S.read(spark, sf, "orders")
    src = o.select(F.concat(F.lit("Orders_"), F.col("o_orderkey").cast("string")).alias("name"))
    out = o.where(F.col("o_orderstatus") == "F").select(F.concat(F.lit("Orders_"), F.col("o_orderkey").cast("string")).alias("name"))
    return SRC.missing_outputs(src, out, "name")
