"""Row-level security: build hierarchy paths (R1), look codes up (R2), secure reads.

Everything is a narrow projection over the hierarchy table; the only
shuffles are the ``distinct`` of the lookup and the semi join of the secured
read.  No row-level Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleslake.functions.arrays import drop_adjacent_repeats, join_path, non_empty
from saleslake.functions.scalar import email_path_id

# --- fixed values -------------------------------------------------------------
TXN_MARKER = "Sales Hierarchy"          # txn_type must contain this text
LEVELS = (2, 3, 4, 5, 6, 7)             # sh_2 .. sh_7
MIN_PATH_LEN = 2                        # shorter paths give no RLS row
PATH_SEP = "."
# ------------------------------------------------------------------------------

RLS_COLUMNS = (
    "cluster", "division", "sales_group", "wss_territory_code", "email_id",
    "hierarchy_path", "sh_2", "sh_3", "sh_4", "sh_5", "sh_6", "sh_7",
)


def build_rls(hier: DataFrame, marker: str = TXN_MARKER) -> DataFrame:
    """One RLS row per hierarchy row whose de-duplicated path has >= 2 ids.

    F3 -> X3 -> X1 -> W1 -> F5 -> X2, as one select chain.
    """
    src = hier.filter(F.col("txn_type").contains(marker) & F.col("sh_2_email").isNotNull())
    raw = [F.col(f"sh_{k}_email") for k in LEVELS]
    present = [e.isNotNull() & (e != F.lit("")) for e in raw]
    # Ids are computed column by column (inside whole-stage codegen); only the
    # cheap list filters run as higher-order functions.
    ids = [F.when(p, email_path_id(e)) for e, p in zip(raw, present)]
    emails = non_empty(raw)
    # The fold's result is needed by the size filter and by the output.  It
    # is produced by a one-row ``inline`` so that it is computed once per row:
    # a generator output cannot be inlined into the pushed-down filter.
    paths = F.array(F.struct(
        emails.alias("_emails"),
        drop_adjacent_repeats(F.filter(F.array(*ids), lambda x: x.isNotNull())).alias("_path"),
    ))
    staged = src.select("*", F.inline(paths))
    return staged.filter(F.size("_path") >= MIN_PATH_LEN).select(
        F.col("cluster_code").alias("cluster"),
        F.col("division_code").alias("division"),
        F.col("sales_group"),
        F.col("wss_territory_code"),
        F.coalesce(F.get(F.col("_emails"), 0), F.lit("")).alias("email_id"),
        join_path(F.col("_path"), PATH_SEP).alias("hierarchy_path"),
        *[F.col(f"sh_{k}_email").alias(f"sh_{k}") for k in LEVELS],
    )


def path_members(rls: DataFrame) -> DataFrame:
    """Explode each path to ``(pos, n, member_id, wss_territory_code)``.

    Ids never contain ``.`` (it is rewritten to ``_dot_``), so splitting the
    stored path is exact.
    """
    parts = F.split(F.col("hierarchy_path"), r"\.")
    return rls.select(
        "wss_territory_code",
        F.size(parts).alias("n"),
        F.posexplode(parts).alias("pos", "member_id"),
    )


def lookup_codes(rls: DataFrame, users: DataFrame, email_col: str = "email", interior_only: bool = True) -> DataFrame:
    """R2: users -> distinct non-empty territory codes whose path holds the user.

    ``interior_only`` keeps the reference's ``%.id.%`` rule (first and last
    entries never match); otherwise any position matches.  Matching is by
    exact element, never by LIKE, so ``_`` in an id is not a wildcard.

    Scale: ``(member_id, code)`` pairs are de-duplicated *before* the join, so
    a head of hierarchy present in a third of all paths contributes one row
    per code, not one row per path.
    """
    m = path_members(rls)
    if interior_only:
        m = m.filter((F.col("pos") > 0) & (F.col("pos") < F.col("n") - 1))
    pairs = (
        m.filter(F.col("wss_territory_code").isNotNull() & (F.col("wss_territory_code") != ""))
        .select("member_id", "wss_territory_code")
        .distinct()
    )
    u = users.select(F.col(email_col).alias("email")).withColumn("member_id", email_path_id(F.col("email")))
    u = u.filter(F.col("member_id") != "")
    return u.join(pairs, "member_id", "inner").select("email", "wss_territory_code").distinct()


def user_groups(rls: DataFrame, users: DataFrame, email_col: str = "email") -> DataFrame:
    """Sales groups a user may see: every RLS row whose path holds the user anywhere."""
    m = rls.select(
        "sales_group",
        F.explode(F.split(F.col("hierarchy_path"), r"\.")).alias("member_id"),
    ).distinct()
    u = users.select(F.col(email_col).alias("email")).withColumn("member_id", email_path_id(F.col("email")))
    return u.join(m, "member_id", "inner").select("email", "sales_group").distinct()


def secured_fact(fact: DataFrame, rls: DataFrame, email: str, group_col: str = "sales_group_code") -> DataFrame:
    """The fact rows that one caller may see (a left semi join with the caller's sales groups)."""
    caller = rls.sparkSession.createDataFrame([(email,)], "email string")
    groups = user_groups(rls, caller).select(F.col("sales_group").alias(group_col))
    return fact.join(groups, group_col, "left_semi")


def secured_totals(fact: DataFrame, grants: DataFrame, value_col: str, group_col: str = "sales_group_code") -> DataFrame:
    """N6 for all callers: rows and total of what each may see.

    The fact is summed by sales group first, so the join with the grants
    works on groups, not on facts times users.
    """
    per_group = fact.groupBy(F.col(group_col).alias("sales_group")).agg(F.count(F.lit(1)).alias("n"), F.sum(value_col).alias("v"))
    return grants.select("email", "sales_group").join(per_group, "sales_group").groupBy("email").agg(
        F.sum("n").alias("n_rows"), F.round(F.sum("v"), 2).alias("total"))


def publish_rls(hier: DataFrame, root: str) -> int:
    """Replace the RLS table with a freshly built one (a new committed version).

    The previous version stays readable until the new one has committed, so
    readers never see the empty table that a truncate-then-insert would show.
    """
    from saleslake.operators.load import publish_version

    return publish_version(build_rls(hier), root)
