"""Queries: evolution (K14), merge, reconciliation, enrichment, rollup, pipeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.operators import evolve as EV
from saleslake.operators import feed as FD
from saleslake.operators import load as L
from saleslake.operators import profile as P
from saleslake.operators import quality as Q
from saleslake.operators import recon as RC
from saleslake.operators import table as TB
from saleslake.operators.clean import to_double, to_int
from saleslake.operators.project import rename_to_spec
from saleslake.plans import specs as SP
from saleslake.plans import standins as S
from saleslake.plans.oracle_parts import d_to_double, d_to_int
from saleslake.plans.pipeline import load_file
from saleslake.plans.q_load import DETAIL_GROUPS
from saleslake.plans.registry import query
from saleslake.session import scratch_path

_R = f"r AS ({S.RAW_LINES_SQL})"

# --- K14 / A14 -------------------------------------------------------------------

_SPARK_NAME = {"BIGINT": "bigint", "DOUBLE": "double", "INT": "int", "SMALLINT": "smallint"}


def _d_evolve() -> str:
    rows = []
    for c in SP.FACT_LINES.columns:
        raw, fam = c.incoming(), c.family
        if fam in ("SMALLINT", "INT", "TINYINT", "BIGINT"):
            v = f"CAST({d_to_int(raw)} AS HUGEINT)"
            lo, hi = {"TINYINT": (-128, 127), "SMALLINT": (-32768, 32767), "INT": (-2147483648, 2147483647),
                      "BIGINT": (-9223372036854775808, 9223372036854775807)}[fam]
            up = {"TINYINT": ["SMALLINT", "INT", "BIGINT"], "SMALLINT": ["INT", "BIGINT"], "INT": ["BIGINT"],
                  "BIGINT": []}[fam]
            bounds = {"SMALLINT": (-32768, 32767), "INT": (-2147483648, 2147483647),
                      "BIGINT": (-9223372036854775808, 9223372036854775807)}
            whens = " ".join(f"WHEN min({v}) >= {bounds[t][0]} AND max({v}) <= {bounds[t][1]} THEN '{t}'" for t in up)
            new = f"(CASE {whens} ELSE 'LARGEINT' END)" if up else "'LARGEINT'"
            rows.append(
                f"SELECT '{c.name}' AS column_name, '{c.type}' AS old_type, {new} AS new_type, "
                f"'values outside {fam}: min=' || CAST(min({v}) AS VARCHAR) || ', max=' || CAST(max({v}) AS VARCHAR) AS reason, "
                f"(min({v}) < {lo} OR max({v}) > {hi}) AS hit FROM r")
        elif fam == "VARCHAR":
            ml = f"max(length({raw}))"
            rows.append(
                f"SELECT '{c.name}', '{c.type}', 'VARCHAR(' || CAST(least(({ml} * 6) // 5, 5000) AS VARCHAR) || ')', "
                f"'data holds ' || CAST({ml} AS VARCHAR) || ' characters; widened with a 20% buffer', {ml} > {c.limit} FROM r")
        elif fam == "FLOAT":
            rows.append(f"SELECT '{c.name}', '{c.type}', 'DOUBLE', 'data is double precision', TRUE")
    body = "\nUNION ALL\n".join(rows)
    applied = "CASE WHEN new_type LIKE 'VARCHAR%' THEN 'string' " + " ".join(
        f"WHEN new_type = '{k}' THEN '{v}'" for k, v in _SPARK_NAME.items()) + " END"
    return (f"WITH {_R}, x AS ({body})\nSELECT 'fact_lines' AS table_name, column_name, old_type, new_type, reason, "
            f"'ALTER TABLE fact_lines MODIFY COLUMN ' || column_name || ' ' || new_type AS alter_sql, "
            f"{applied} AS applied_type FROM x WHERE hit")


@query("evolve_apply", _d_evolve())
def q_evolve_apply(spark, sf):
    """A14 + K14: propose changes from the profile, evolve the spec, rewrite the data with it."""
    raw = rename_to_spec(S.raw_lines(spark, sf), SP.FACT_LINES)
    prof = P.profile(raw, SP.FACT_LINES).cache()
    changes = EV.schema_changes(prof, SP.FACT_LINES.name)
    new_spec = EV.apply_changes(SP.FACT_LINES, changes)
    typed, _ = P.clean_table(raw, new_spec, policy="raise")     # must pass with the widened types
    root = scratch_path(spark, "evolved")
    L.publish_version(typed, root)
    written = {f.name: f.dataType.simpleString() for f in L.read_current(spark, root).schema.fields}
    applied = F.create_map(*[x for k, v in written.items() for x in (F.lit(k), F.lit(v))])
    return changes.withColumn("applied_type", applied[F.col("column_name")])


# --- N1 merge --------------------------------------------------------------------

_ORD = "o_orderkey, o_custkey, o_totalprice, o_orderstatus"
_D_CHANGES = f"""SELECT o_orderkey, o_custkey, o_totalprice + 1 AS o_totalprice, o_orderstatus, 'U' AS op, 1 AS seq
  FROM orders WHERE o_orderkey % 5 = 0
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice + 2, o_orderstatus, 'U', 2 FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus, 'D', 3 FROM orders WHERE o_orderkey % 7 = 0
UNION ALL SELECT -o_orderkey, o_custkey, o_totalprice, 'N', 'I', 1 FROM orders WHERE o_orderkey % 11 = 0"""


@query(
    "merge_upsert",
    f"""WITH t AS (SELECT {_ORD} FROM orders), ch AS ({_D_CHANGES}),
l AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1)
SELECT coalesce(l.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN l.op IS NOT NULL THEN l.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN l.op IS NOT NULL THEN l.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN l.op IS NOT NULL THEN l.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus
FROM t FULL OUTER JOIN l ON t.o_orderkey = l.o_orderkey
WHERE l.op IS NULL OR l.op <> 'D'""",
)
def q_merge_upsert(spark, sf):
    o = S.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey")
    ch = (
        o.where(k % 5 == 0).select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
                                   "o_orderstatus", F.lit("U").alias("op"), F.lit(1).alias("seq"))
        .unionByName(o.where(k % 10 == 0).select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 2).alias("o_totalprice"),
                                                 "o_orderstatus", F.lit("U").alias("op"), F.lit(2).alias("seq")))
        .unionByName(o.where(k % 7 == 0).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                                                F.lit("D").alias("op"), F.lit(3).alias("seq")))
        .unionByName(o.where(k % 11 == 0).select((-k).alias("o_orderkey"), "o_custkey", "o_totalprice",
                                                 F.lit("N").alias("o_orderstatus"), F.lit("I").alias("op"), F.lit(1).alias("seq")))
    )
    return Q.merge_upsert(o, ch, "o_orderkey")


# every order of some customers has no status: the partition without a value
_D_NO_STATUS = "(SELECT o_orderkey, o_custkey, o_totalprice, CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders)"
_D_CHANGES_MOVE = _D_CHANGES.replace("FROM orders", f"FROM {_D_NO_STATUS}").replace(
    "SELECT o_orderkey, o_custkey, o_totalprice + 2, o_orderstatus, 'U', 2",
    "SELECT o_orderkey, o_custkey, o_totalprice + 2, 'X', 'U', 2")


@query(
    "merge_upsert_partitioned",
    f"""WITH t AS (SELECT {_ORD} FROM {_D_NO_STATUS}), ch AS ({_D_CHANGES_MOVE}),
l AS (SELECT * FROM ch QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1)
SELECT coalesce(l.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN l.op IS NOT NULL THEN l.o_custkey ELSE t.o_custkey END AS o_custkey,
       CASE WHEN l.op IS NOT NULL THEN l.o_totalprice ELSE t.o_totalprice END AS o_totalprice,
       CASE WHEN l.op IS NOT NULL THEN l.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus
FROM t FULL OUTER JOIN l ON t.o_orderkey = l.o_orderkey
WHERE l.op IS NULL OR l.op <> 'D'""",
)
def q_merge_upsert_partitioned(spark, sf):
    """N1 at scale: the target is partitioned by status; some updates move keys to a new partition."""
    status = F.when(F.col("o_custkey") % 9 == 0, F.lit(None)).otherwise(F.col("o_orderstatus"))
    o = S.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", status.alias("o_orderstatus"))
    root = scratch_path(spark, "orders_by_status")
    TB.create(o, root, "o_orderstatus")
    k = F.col("o_orderkey")
    ch = (
        o.where(k % 5 == 0).select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"),
                                   "o_orderstatus", F.lit("U").alias("op"), F.lit(1).alias("seq"))
        .unionByName(o.where(k % 10 == 0).select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 2).alias("o_totalprice"),
                                                 F.lit("X").alias("o_orderstatus"), F.lit("U").alias("op"), F.lit(2).alias("seq")))
        .unionByName(o.where(k % 7 == 0).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                                                F.lit("D").alias("op"), F.lit(3).alias("seq")))
        .unionByName(o.where(k % 11 == 0).select((-k).alias("o_orderkey"), "o_custkey", "o_totalprice",
                                                 F.lit("N").alias("o_orderstatus"), F.lit("I").alias("op"), F.lit(1).alias("seq")))
    )
    Q.merge_partitions(spark, root, ch, "o_orderkey", "o_orderstatus")
    return TB.read_table(spark, root).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")


# --- N2 reconciliation -------------------------------------------------------------


@query(
    "recon_counts",
    f"""WITH {_R}, s AS (SELECT TRY_CAST({d_to_int('salesgroupcode')} AS SMALLINT) AS sales_group_code, value FROM r),
a AS (SELECT sales_group_code, count(*) AS n FROM s GROUP BY 1),
b AS (SELECT sales_group_code, count(*) AS n FROM s WHERE {d_to_double('value')} IS NOT NULL GROUP BY 1)
SELECT coalesce(a.sales_group_code, b.sales_group_code) AS sales_group_code,
       coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS target_rows, coalesce(a.n, 0) - coalesce(b.n, 0) AS diff,
       CASE WHEN a.n IS NULL THEN 'missing_in_source' WHEN b.n IS NULL THEN 'missing_in_target'
            WHEN a.n = b.n THEN 'match' ELSE 'mismatch' END AS status
FROM a FULL OUTER JOIN b ON a.sales_group_code IS NOT DISTINCT FROM b.sales_group_code""",
)
def q_recon_counts(spark, sf):
    """Source = incoming lines per group; target = lines whose value converted."""
    r = S.raw_lines(spark, sf).select(to_int(F.col("salesgroupcode")).try_cast("smallint").alias("sales_group_code"), "value")
    target = r.where(to_double(F.col("value")).isNotNull())
    return Q.recon_counts(r, target, ["sales_group_code"])


@query(
    "recon_duplicates",
    "SELECT l_orderkey, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1",
)
def q_recon_duplicates(spark, sf):
    return Q.recon_duplicates(S.read(spark, sf, "lineitem").select("l_orderkey"), ["l_orderkey"])


@query(
    "recon_missing_keys",
    """SELECT DISTINCT l.doc_id AS key, 'missing_in_documents' AS side FROM labels l
   WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)
UNION ALL SELECT DISTINCT d.doc_id, 'missing_in_labels' FROM documents d
   WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
)
def q_recon_missing_keys(spark, sf):
    """Integrity both ways: labelled documents that do not exist, documents without labels."""
    lab = S.read(spark, sf, "labels")
    doc = S.read(spark, sf, "documents").select("doc_id")
    return Q.recon_missing_keys(lab, doc, "doc_id", "doc_id", "labels", "documents")


_RECON = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
_D_RECON_TARGET = f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 101 = 3 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 97 = 5 THEN o_totalprice + 0.01 ELSE o_totalprice END AS o_totalprice, o_orderpriority
FROM orders WHERE o_orderkey % 89 <> 7
UNION ALL SELECT {_RECON} FROM orders WHERE o_orderkey % 83 = 11
UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 79 = 13
UNION ALL SELECT CAST(NULL AS BIGINT), o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 73 = 17"""


@query(
    "recon_contents",
    f"""WITH s AS (SELECT {_RECON} FROM orders), t AS ({_D_RECON_TARGET}),
d AS ((SELECT * FROM s EXCEPT ALL SELECT * FROM t) UNION ALL (SELECT * FROM t EXCEPT ALL SELECT * FROM s)),
k AS (SELECT DISTINCT o_orderkey AS k FROM d),
a AS (SELECT o_orderkey AS k, count(*) AS n FROM s GROUP BY 1), b AS (SELECT o_orderkey AS k, count(*) AS n FROM t GROUP BY 1)
SELECT k.k AS o_orderkey, coalesce(a.n, 0) AS source_rows, coalesce(b.n, 0) AS target_rows,
       CASE WHEN a.n IS NULL THEN 'missing_in_source' WHEN b.n IS NULL THEN 'missing_in_target' WHEN a.n <> b.n THEN 'repeated' ELSE 'changed' END AS status
FROM k LEFT JOIN a ON a.k IS NOT DISTINCT FROM k.k LEFT JOIN b ON b.k IS NOT DISTINCT FROM k.k""",
)
def q_recon_contents(spark, sf):
    """Orders against a copy with rows changed, missing, added, repeated and without a key."""
    s = S.read(spark, sf, "orders").select(*_RECON.split(", "))
    k = F.col("o_orderkey")
    t = s.where(k % 89 != 7).withColumns({
        "o_orderstatus": F.when(k % 101 != 3, F.col("o_orderstatus")),
        "o_totalprice": F.when(k % 97 == 5, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))})
    t = t.unionByName(s.where(k % 83 == 11)).unionByName(s.where(k % 79 == 13).withColumn("o_orderkey", -k))
    t = t.unionByName(s.where(k % 73 == 17).withColumn("o_orderkey", F.lit(None).cast("long")))
    return RC.recon_contents(s, t, ["o_orderkey"])


# --- N3/N4 enrichment, N5 rollup ------------------------------------------------------


@query(
    "enrich_material",
    """SELECT l_orderkey * 10 + l_linenumber AS invoice_key, l_partkey AS material_code, p_brand AS brand,
       p_type AS vertical, l_extendedprice AS value
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""",
)
def q_enrich_material(spark, sf):
    li = S.read(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_key"),
        F.col("l_partkey").alias("material_code"), F.col("l_extendedprice").alias("value"))
    part = S.read(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("vertical"))
    return Q.enrich(li, part, "material_code", "p_partkey", ["brand", "vertical"]).select(
        "invoice_key", "material_code", "brand", "vertical", "value")


_D_ENRICH_SG = """SELECT l_orderkey * 10 + l_linenumber AS invoice_key, s_nationkey AS sales_group,
       r_name AS division, n_name AS vertical, l_extendedprice AS value
FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey) ON s_nationkey = n_nationkey"""


def _enriched_sales_group(spark, sf):
    li = S.read(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_key"), "l_suppkey",
        F.col("l_extendedprice").alias("value"))
    sup = S.read(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("sales_group"))
    n = S.read(spark, sf, "nation")
    r = S.read(spark, sf, "region")
    dim = n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("r_name").alias("division"), F.col("n_name").alias("vertical"))
    f = Q.enrich(li, sup, "l_suppkey", "s_suppkey", ["sales_group"])
    return Q.enrich(f, dim, "sales_group", "n_nationkey", ["division", "vertical"]).select(
        "invoice_key", "sales_group", "division", "vertical", "value")


@query("enrich_sales_group", _D_ENRICH_SG)
def q_enrich_sales_group(spark, sf):
    return _enriched_sales_group(spark, sf)


@query(
    "report_rollup",
    f"""WITH e AS ({_D_ENRICH_SG})
SELECT division, vertical, count(*) AS n_rows, round(sum(value), 2) AS total_value,
       CAST(grouping(division, vertical) AS INTEGER) AS level
FROM e GROUP BY ROLLUP (division, vertical)""",
)
def q_report_rollup(spark, sf):
    return Q.rollup_report(_enriched_sales_group(spark, sf), ["division", "vertical"], "value")


# --- enrichment with duplicate master rows ------------------------------------------


@query(
    "enrich_duplicate_master",
    """WITH m AS (SELECT p_partkey AS k, p_brand AS brand, p_type AS vertical FROM part
  UNION ALL SELECT p_partkey, 'A-' || p_brand, p_type FROM part WHERE p_partkey % 4 = 0
  UNION ALL SELECT p_partkey, NULL, 'later' FROM part WHERE p_partkey % 8 = 0),
d AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY k ORDER BY brand NULLS FIRST, vertical NULLS FIRST) = 1)
SELECT l_orderkey * 10 + l_linenumber AS invoice_key, l_partkey AS material_code, brand, vertical
FROM lineitem LEFT JOIN d ON l_partkey = k""",
)
def q_enrich_duplicate_master(spark, sf):
    """Duplicate master rows neither multiply facts nor make the result depend on the run."""
    li = S.read(spark, sf, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("invoice_key"), F.col("l_partkey").alias("material_code"))
    p = S.read(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.col("p_brand").alias("brand"), F.col("p_type").alias("vertical"))
    more = p.where("k % 4 = 0").withColumn("brand", F.concat(F.lit("A-"), "brand"))
    none = p.where("k % 8 = 0").select("k", F.lit(None).cast("string").alias("brand"), F.lit("later").alias("vertical"))
    return Q.enrich(li, p.unionByName(more).unionByName(none), "material_code", "k", ["brand", "vertical"])


# --- R3 historical load -----------------------------------------------------------------

_CUT = 19960101
_FILE = "FactInvoiceSecondary_1_2_2024"       # P13: the data set is FactInvoiceSecondary_1_2, the groups 1 and 2
_DETAILS_FILE = "FactInvoiceDetails_107_112_2024"

_D_TYPED = f"""WITH {_R}, f AS (SELECT CASE WHEN count(*) FILTER (WHERE shipdate IS NOT NULL AND try_strptime(shipdate, '%Y-%m-%d') IS NULL) * 10 <= count(*)
  THEN 1 END AS k FROM r),
t AS (SELECT CAST({d_to_int('invoicekey')} AS BIGINT) AS invoice_key, CAST({d_to_int('invoicedate')} AS INTEGER) AS invoice_date,
       CAST({d_to_int('salesgroupcode')} AS SMALLINT) AS sales_group_code, recordtype AS record_type, {d_to_int('quantity')} AS quantity,
       {d_to_double('value')} AS value, CAST({d_to_double('discount')} AS FLOAT) AS discount,
       CAST(try_strptime(shipdate, '%Y-%m-%d') AS DATE) AS ship_date, CAST({d_to_int('linenumber')} AS TINYINT) AS line_number,
       linestatus AS line_status, {d_to_int('bigqty')} AS big_qty FROM r)"""


def _landed(df, spark, name: str) -> str:
    root = scratch_path(spark, name)
    (df.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
       .option("ignoreTrailingWhiteSpace", False).csv(root))
    return root


def _secondary(spark, sf):
    """(existing table, incoming lines, their day)."""
    raw = S.raw_lines(spark, sf)
    day = F.col("invoicedate").cast("int")
    # the existing table: everything that was not invoiced after the cut-off, cleaned the same way
    existing, _ = P.clean_table(raw.where(~F.coalesce(day >= _CUT, F.lit(False))), SP.FACT_LINES, policy="widen")
    root = scratch_path(spark, "fact_secondary")
    L.create_fact(existing, root)
    return root, raw, day


@query(
    "pipeline_historical_load",
    f"""{_D_TYPED}
SELECT * FROM t WHERE NOT coalesce(invoice_date >= {_CUT}, FALSE) AND NOT coalesce(sales_group_code IN (1, 2) AND record_type <> 'DD', FALSE)
UNION ALL SELECT * FROM t WHERE invoice_date >= {_CUT} AND sales_group_code IN (1, 2, 3)""",
)
def q_pipeline_historical_load(spark, sf):
    """R3 with K6: the groups of the data set's name are replaced but for DD; other rows of the file are added."""
    root, raw, day = _secondary(spark, sf)
    landed = _landed(raw.where((day >= _CUT) & to_int(F.col("salesgroupcode")).isin(1, 2, 3)), spark, "landed")
    load_file(spark, landed, _FILE, SP.FACT_LINES, root, floor=_CUT - 1)
    return TB.read_table(spark, root)


@query(
    "pipeline_historical_load_dd",
    f"""{_D_TYPED}
SELECT * FROM t WHERE NOT coalesce(invoice_date >= {_CUT}, FALSE) AND NOT coalesce(record_type = 'DD', FALSE)
UNION ALL SELECT * FROM t WHERE invoice_date >= {_CUT} AND record_type = 'DD'""",
)
def q_pipeline_historical_load_dd(spark, sf):
    """R3 with K7: the DD rows of all groups, also of rows without one."""
    root, raw, day = _secondary(spark, sf)
    landed = _landed(raw.where((day >= _CUT) & (F.col("recordtype") == "DD")), spark, "landed")
    load_file(spark, landed, "FactInvoiceSecondary_DD_2024", SP.FACT_LINES, root, dd=True, floor=_CUT - 1)
    return TB.read_table(spark, root)


_DETAIL_GROUPS_SQL = ", ".join(map(str, DETAIL_GROUPS))
_DETAILS_GROUP = "CASE WHEN o_custkey % 37 = 0 THEN NULL ELSE 100 * (1 + o_custkey % 9) + o_custkey % 13 END"
_POSTED = "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)"
_DETAILS_SQL = f"""SELECT o_orderkey AS order_number, {_POSTED} AS posting_date, CAST({_DETAILS_GROUP} AS SMALLINT) AS sales_group_code,
  CAST(o_totalprice AS DOUBLE) AS net_value, o_orderstatus AS status FROM orders"""


@query(
    "pipeline_historical_load_details",
    f"""WITH t AS ({_DETAILS_SQL})
SELECT * FROM t WHERE posting_date < {_CUT} AND NOT coalesce(sales_group_code IN ({_DETAIL_GROUPS_SQL}), FALSE)
UNION ALL SELECT * FROM t WHERE posting_date >= {_CUT} AND sales_group_code IN (107, 112, 101, 203)""",
)
def q_pipeline_historical_load_details(spark, sf):
    """R3 with F2 and K8: details of groups 107 and 112 replace the further groups, too."""
    t = S.read(spark, sf, "orders").selectExpr(
        "o_orderkey AS order_number", f"{_POSTED} AS posting_date", f"CAST({_DETAILS_GROUP} AS SMALLINT) AS sales_group_code",
        "CAST(o_totalprice AS DOUBLE) AS net_value", "o_orderstatus AS status")
    root = scratch_path(spark, "fact_details")
    TB.create(t.where(F.col("posting_date") < _CUT), root, "sales_group_code")
    # the sender's file also holds rows before the floor, which do not pass
    new = t.where(((F.col("posting_date") >= _CUT) & F.col("sales_group_code").isin(107, 112, 101, 203)) | (F.col("order_number") % 50 == 0) & (F.col("posting_date") < _CUT))
    landed = _landed(new.select(*[F.col(c).cast("string").alias(c.replace("_", "")) for c in t.columns]), spark, "landed_details")
    load_file(spark, landed, _DETAILS_FILE, SP.FACT_DETAILS, root, floor=_CUT - 1)
    return TB.read_table(spark, root)


@query(
    "pipeline_historical_load_dimension",
    f"""WITH r AS ({S.RAW_CUSTOMER_SQL})
SELECT CAST(customercode AS BIGINT) AS customer_code, "Customer Name" AS customer_name, CAST("nation code" AS INTEGER) AS nation_code,
       CAST("acct bal" AS DOUBLE) AS account_balance, MarketSegment AS market_segment, customergroup AS customer_group,
       "customer group" AS cm_customer_group, Div AS div_col_rf, CAST(NULL AS VARCHAR) AS phone
FROM r WHERE customercode % 3 <> 0""",
)
def q_pipeline_historical_load_dimension(spark, sf):
    """R3 with K5: a dimension is refreshed whole, twice."""
    raw = S.raw_customer(spark, sf)
    raw = raw.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in raw.columns])
    root = scratch_path(spark, "dim_customer_master")
    for rows in (raw, raw.where("CAST(customercode AS BIGINT) % 3 <> 0")):
        load_file(spark, _landed(rows, spark, "landed_dim"), "DimCustomerMaster_2024", SP.DIM_CUSTOMER, root, columns=raw.columns)
    return L.read_current(spark, root)


# --- N1/N8 change feed, N5 materialised view, K14 on the manifest ------------------------

_F = "invoice_key, sales_group_code, record_type, value, ship_ymd"
# one fact for each order, so that the key is one
_ORDER_FACTS = [
    ("invoice_key", "o_orderkey"),
    ("sales_group_code", "CAST(CASE WHEN o_custkey % 41 = 0 THEN NULL ELSE o_custkey % 20 END AS SMALLINT)"),
    ("record_type", "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 5 = 2 THEN 'DD' ELSE 'A' || o_orderstatus END"),
    ("value", "CAST(o_totalprice AS DOUBLE)"),
    ("ship_ymd", "CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER)"),
]
_ORDER_FACTS_SQL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _ORDER_FACTS) + " FROM orders"
_CUT_ROWS = f"ship_ymd >= {_CUT}"
# every load mode on one table, as SQL over the facts f: the table after each load
_MODES = {
    1: f"SELECT {_F} FROM f WHERE NOT ({_CUT_ROWS})",
    2: f"SELECT * FROM s1 UNION ALL SELECT {_F} FROM f WHERE {_CUT_ROWS} AND invoice_key % 4 = 0",
    3: f"""SELECT * FROM s2 WHERE NOT coalesce(sales_group_code IN (1, 2) AND record_type <> 'DD', FALSE)
           UNION ALL SELECT {_F} FROM f WHERE {_CUT_ROWS} AND (sales_group_code IN (1, 2) OR sales_group_code IS NULL) AND invoice_key % 4 = 1""",
    4: f"SELECT * FROM s3 WHERE NOT coalesce(record_type = 'DD', FALSE) UNION ALL SELECT {_F} FROM f WHERE {_CUT_ROWS} AND record_type = 'DD' AND invoice_key % 4 = 2",
    5: f"SELECT * FROM s4 WHERE NOT coalesce(sales_group_code IN (5, 6), FALSE) UNION ALL SELECT {_F} FROM f WHERE sales_group_code = 5",
    # every seventh key of some groups gets another value, every eleventh of another goes, some are new, in the group without a name
    6: f"""SELECT * FROM s5 WHERE NOT coalesce({{changed}}, FALSE)
           UNION ALL SELECT invoice_key, sales_group_code, record_type, value + 1, ship_ymd FROM f WHERE {{updated}}
           UNION ALL SELECT -invoice_key, NULL, record_type, value, ship_ymd FROM f WHERE {{new}}""".format(
        changed="sales_group_code IN (8, 9) AND invoice_key % 7 = 0 OR sales_group_code = 10 AND invoice_key % 11 = 0",
        updated="sales_group_code IN (8, 9) AND invoice_key % 7 = 0",
        new="sales_group_code = 12 AND invoice_key % 13 = 0"),
}
_D_STATES = f"WITH f AS ({_ORDER_FACTS_SQL}),\n" + ",\n".join(f"s{v} AS ({sql})" for v, sql in _MODES.items())


def _d_changes() -> str:
    """The multiset difference of neighbouring states, both ways, counted."""
    out = []
    for v in sorted(_MODES):
        for change, a, b in (("insert", f"s{v}", f"s{v - 1}"), ("delete", f"s{v - 1}", f"s{v}")):
            if v == 1:
                if change == "insert":
                    out.append(f"SELECT *, {v} AS _version, '{change}' AS c FROM s1")
                continue
            out.append(f"SELECT *, {v}, '{change}' FROM (SELECT * FROM {a} EXCEPT ALL SELECT * FROM {b})")
    return f"""{_D_STATES}, d AS ({' UNION ALL '.join(out)}),
g AS (SELECT {_F}, CAST(_version AS BIGINT) AS _version, c, count(*) AS _copies FROM d GROUP BY ALL),
u AS (SELECT _version AS v, invoice_key AS k FROM g GROUP BY ALL HAVING count(DISTINCT c) = 2)
SELECT {_F}, _version, CASE WHEN k IS NULL THEN c WHEN c = 'insert' THEN 'update_postimage' ELSE 'update_preimage' END AS _change, _copies
FROM g LEFT JOIN u ON _version = v AND invoice_key = k"""


def _loads(spark, sf, each=lambda root: None) -> str:
    """A table that every load mode has been at; ``each`` is called after each version."""
    f = S.read(spark, sf, "orders").selectExpr(*[f"{e} AS {n}" for n, e in _ORDER_FACTS])
    root = scratch_path(spark, "fact_modes")
    g, cut = F.col("sales_group_code"), F.col("ship_ymd") >= _CUT
    quarter = F.col("invoice_key") % 4
    L.create_fact(f.where(~cut), root)
    each(root)
    L.append(f.where(cut & (quarter == 0)), root)
    each(root)
    L.replace_groups_not_dd(spark, root, f.where(cut & (g.isin(1, 2) | g.isNull()) & (quarter == 1)), ["1", "2"])
    each(root)
    L.replace_dd(spark, root, f.where(cut & (F.col("record_type") == "DD") & (quarter == 2)))
    each(root)
    L.replace_groups_expanded(spark, root, f.where(g == 5), ["5", "6"])
    each(root)
    k = F.col("invoice_key")
    up = f.where(g.isin(8, 9) & (k % 7 == 0)).withColumn("value", F.col("value") + 1).withColumn("op", F.lit("U"))
    gone = f.where((g == 10) & (k % 11 == 0)).withColumn("op", F.lit("D"))
    new = f.where((g == 12) & (k % 13 == 0)).withColumns({"invoice_key": -k, "sales_group_code": F.lit(None).cast("smallint"), "op": F.lit("I")})
    Q.merge_partitions(spark, root, up.unionByName(gone).unionByName(new).withColumn("seq", F.lit(1)), "invoice_key", "sales_group_code")
    each(root)
    return root


@query("table_changes", _d_changes())
def q_table_changes(spark, sf):
    """What each load mode changed, NULL partition included, with pre- and post-images."""
    return FD.table_changes(spark, _loads(spark, sf), 0, key="invoice_key").select(*_F.split(", "), "_version", "_change", "_copies")


_VIEW_DIMS = ["division", "record_type"]


@query(
    "report_rollup_view",
    f"""{_D_STATES}, e AS (SELECT 'D' || CAST(sales_group_code % 7 AS VARCHAR) AS division, record_type, value FROM s6)
SELECT division, record_type, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(28, 6))) AS DOUBLE) AS total_value,
       CAST(grouping(division, record_type) AS INTEGER) AS level
FROM e GROUP BY ROLLUP (division, record_type)""",
)
def q_report_rollup_view(spark, sf):
    """A view of the facts, refreshed after each load from the folders that the load changed."""
    view = scratch_path(spark, "view_division")
    division = F.concat(F.lit("D"), (F.col("sales_group_code") % 7).cast("string"))
    _loads(spark, sf, lambda root: FD.refresh_view(spark, root, view, _VIEW_DIMS, "value", lambda rows: rows.withColumn("division", division)))
    return FD.view_rollup(spark, view, _VIEW_DIMS)


@query(
    "evolve_in_place",
    f"""WITH f AS ({S.fact_sql(S.SECONDARY_GROUP)})
SELECT invoice_key, sales_group_code AS group_code, CAST(ship_ymd AS BIGINT) AS ship_ymd, value AS net_value,
       CAST(NULL AS VARCHAR) AS record_type, CAST(NULL AS VARCHAR) AS note FROM f WHERE ship_ymd < {_CUT}
UNION ALL SELECT invoice_key, sales_group_code, CAST(ship_ymd AS BIGINT) * 1000000, value, record_type, 'new' FROM f WHERE ship_ymd >= {_CUT}""",
)
def q_evolve_in_place(spark, sf):
    """Widen, rename, drop, add again and add by manifests alone; files written before stay as they are and readable."""
    f = S.facts(spark, sf)
    root = scratch_path(spark, "fact_evolved")
    TB.create(f.where(F.col("ship_ymd") < _CUT), root, "sales_group_code")
    before = TB.manifest(spark, root).folders()
    TB.evolve(spark, root, ("widen", "ship_ymd", "bigint"), ("rename", "value", "net_value"), ("rename", "sales_group_code", "group_code"))
    TB.evolve(spark, root, ("drop", "record_type"))
    TB.evolve(spark, root, ("add", "record_type", "string"), ("add", "note", "string"))
    assert TB.manifest(spark, root).folders() == before
    new = f.where(F.col("ship_ymd") >= _CUT).withColumnsRenamed({"value": "net_value", "sales_group_code": "group_code"})
    TB.append(new.withColumns({"ship_ymd": F.col("ship_ymd").cast("long") * 1000000, "note": F.lit("new")}), root)
    return TB.read_table(spark, root).select("invoice_key", "group_code", "ship_ymd", "net_value", "record_type", "note")
