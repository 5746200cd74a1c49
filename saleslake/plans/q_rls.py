"""Queries: RLS build and lookup (R1, R2, N6) with X1-X3, W1, F3, F5."""

from __future__ import annotations

from pyspark.sql import functions as F

from saleslake.functions.arrays import drop_adjacent_repeats, non_empty
from saleslake.functions.scalar import email_path_id
from saleslake.operators import load as L
from saleslake.operators import rls as rls_ops
from saleslake.plans import standins as S
from saleslake.plans.oracle_parts import d_email_id
from saleslake.plans.registry import query
from saleslake.session import scratch_path

# =============================================================================
# RLS (R1, R2, N6) and the scalar/array pieces
# =============================================================================

_LEVELS = (2, 3, 4, 5, 6, 7)
_EM_LIST = "[" + ", ".join(f"sh_{k}_email" for k in _LEVELS) + "]"

_D_RLS = f"""
WITH h AS ({S.HIERARCHY_SQL}),
f AS (SELECT * FROM h WHERE txn_type LIKE '%Sales Hierarchy%' AND sh_2_email IS NOT NULL),
e AS (SELECT *, list_filter({_EM_LIST}, lambda x: x IS NOT NULL AND x <> '') AS em FROM f),
i AS (SELECT *, list_transform(em, lambda x: {d_email_id('x')}) AS ids FROM e),
p AS (SELECT *, list_filter(ids, lambda x, j: x <> '' AND (j = 1 OR ids[j - 1] <> x)) AS path FROM i)
SELECT cluster_code AS cluster, division_code AS division, sales_group, wss_territory_code,
       coalesce(em[1], '') AS email_id, array_to_string(path, '.') AS hierarchy_path,
       sh_2_email AS sh_2, sh_3_email AS sh_3, sh_4_email AS sh_4,
       sh_5_email AS sh_5, sh_6_email AS sh_6, sh_7_email AS sh_7
FROM p WHERE len(path) >= 2
"""


@query("rls_build", _D_RLS)
def q_rls_build(spark, sf):
    return rls_ops.build_rls(S.hierarchy(spark, sf))


_D_EMAIL_ID = "\nUNION ALL\n".join(
    f"SELECT hier_key, {k} AS level, sh_{k}_email AS email, {d_email_id(f'sh_{k}_email')} AS member_id "
    f"FROM h"
    for k in _LEVELS
)


@query("scalar_email_id", f"WITH h AS ({S.HIERARCHY_SQL})\n{_D_EMAIL_ID}")
def q_scalar_email_id(spark, sf):
    h = S.hierarchy(spark, sf)
    pairs = F.array(*[F.struct(F.lit(k).alias("level"), F.col(f"sh_{k}_email").alias("email")) for k in _LEVELS])
    return h.select("hier_key", F.inline(pairs)).select(
        "hier_key", "level", "email", email_path_id(F.col("email")).alias("member_id")
    )


@query(
    "array_drop_adjacent",
    f"""
WITH h AS ({S.HIERARCHY_SQL}),
i AS (SELECT hier_key, list_transform(list_filter({_EM_LIST}, lambda x: x IS NOT NULL AND x <> ''),
                                      lambda x: {d_email_id('x')}) AS ids FROM h),
p AS (SELECT hier_key, ids, list_filter(ids, lambda x, j: x <> '' AND (j = 1 OR ids[j - 1] <> x)) AS path FROM i)
SELECT hier_key, array_to_string(ids, '|') AS ids, array_to_string(path, '|') AS path,
       CAST(len(path) AS INTEGER) AS n FROM p
""",
)
def q_array_drop_adjacent(spark, sf):
    h = S.hierarchy(spark, sf)
    ids = F.transform(non_empty([F.col(f"sh_{k}_email") for k in _LEVELS]), email_path_id)
    w = h.select("hier_key", ids.alias("ids")).withColumn("path", drop_adjacent_repeats(F.col("ids")))
    return w.select(
        "hier_key",
        F.array_join("ids", "|").alias("ids"),
        F.array_join("path", "|").alias("path"),
        F.size("path").alias("n"),
    )


@query(
    "filter_contains_notnull",
    f"""
WITH h AS ({S.HIERARCHY_SQL})
SELECT hier_key, txn_type, sh_2_email FROM h
WHERE contains(txn_type, 'Sales Hierarchy') AND sh_2_email IS NOT NULL
""",
)
def q_filter_contains_notnull(spark, sf):
    h = S.hierarchy(spark, sf)
    return h.filter(F.col("txn_type").contains(rls_ops.TXN_MARKER) & F.col("sh_2_email").isNotNull()).select(
        "hier_key", "txn_type", "sh_2_email"
    )


def _d_lookup(interior: bool) -> str:
    parts = "parts[2:len(parts) - 1]" if interior else "parts"
    return f"""
WITH rls AS ({_D_RLS}),
r AS (SELECT wss_territory_code, string_split(hierarchy_path, '.') AS parts FROM rls),
u AS (SELECT email, {d_email_id('email')} AS mid FROM ({S.USERS_SQL}))
SELECT DISTINCT u.email, r.wss_territory_code
FROM u JOIN r ON list_contains({parts}, u.mid)
WHERE u.mid <> '' AND r.wss_territory_code IS NOT NULL AND r.wss_territory_code <> ''
"""


@query("rls_lookup_interior", _d_lookup(True))
def q_rls_lookup_interior(spark, sf):
    return rls_ops.lookup_codes(rls_ops.build_rls(S.hierarchy(spark, sf)), S.users(spark, sf), interior_only=True)


@query("rls_lookup_member", _d_lookup(False))
def q_rls_lookup_member(spark, sf):
    return rls_ops.lookup_codes(rls_ops.build_rls(S.hierarchy(spark, sf)), S.users(spark, sf), interior_only=False)


@query(
    "rls_secured_fact",
    f"""
WITH rls AS ({_D_RLS}),
u AS (SELECT email, {d_email_id('email')} AS mid FROM ({S.USERS_SQL})),
g AS (SELECT DISTINCT u.email, rls.sales_group FROM u JOIN rls
      ON list_contains(string_split(rls.hierarchy_path, '.'), u.mid)),
fact AS (SELECT o_orderkey, o_totalprice, c_nationkey AS sales_group_code
         FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT g.email, count(*) AS n_rows, round(sum(fact.o_totalprice), 2) AS total
FROM fact JOIN g ON fact.sales_group_code = g.sales_group
GROUP BY g.email
""",
)
def q_rls_secured_fact(spark, sf):
    rls = rls_ops.build_rls(S.hierarchy(spark, sf))
    grants = rls_ops.user_groups(rls, S.users(spark, sf))
    o = S.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = S.read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("sales_group_code"))
    fact = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_totalprice", "sales_group_code")
    return rls_ops.secured_totals(fact, grants, "o_totalprice")


_CALLER = "zm 1@corp.example"


@query(
    "rls_secured_caller",
    f"""
WITH rls AS ({_D_RLS}),
u AS (SELECT {d_email_id("'" + _CALLER + "'")} AS mid),
g AS (SELECT DISTINCT rls.sales_group FROM u JOIN rls ON list_contains(string_split(rls.hierarchy_path, '.'), u.mid))
SELECT o_orderkey, o_totalprice, c_nationkey AS sales_group_code
FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_nationkey IN (SELECT sales_group FROM g)
""",
)
def q_rls_secured_caller(spark, sf):
    """N6 for one caller, against the published RLS table."""
    root = scratch_path(spark, "rls")
    rls_ops.publish_rls(S.hierarchy(spark, sf), root)
    o = S.read(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    c = S.read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("sales_group_code"))
    fact = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_totalprice", "sales_group_code")
    return rls_ops.secured_fact(fact, L.read_current(spark, root), _CALLER)
