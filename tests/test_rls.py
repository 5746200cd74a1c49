from saleslake.operators import rls as R

COLS = ("cluster_code string, division_code int, sales_group int, wss_territory_code string, "
        "sh_2_email string, sh_3_email string, sh_4_email string, sh_5_email string, sh_6_email string, "
        "sh_7_email string, txn_type string")
H = "Sales Hierarchy"
ROWS = [
    ("C1", 1, 10, "W1", "a@x.com", "a@x.com", "b@x.com", None, None, None, H),          # adjacent duplicate
    ("C1", 1, 11, "W2", "a@x.com", "b@x.com", "a@x.com", None, None, None, H),          # A,B,A kept
    ("C1", 1, 12, "W3", "A@X.com", "a@x.com ", "c@x.com", None, None, None, H),         # case-only repeat
    ("C2", 2, 13, "W4", "solo@x.com", None, None, None, None, None, H),                 # one id: dropped
    ("C2", 2, 14, "W5", "", "p@x.com", "q@x.com", None, None, None, H),                 # sh_2 blank
    ("C2", 2, 15, "W6", "p@x.com", "q@x.com", "r@x.com", None, None, None, None),       # txn_type null
    ("C3", 3, 16, "W7", "h@x.com", "x@y", "z@z.com", None, None, None, "North " + H),
    ("C3", 3, 17, "W8", "h@x.com", "xQatRy", "z@z.com", None, None, None, H),
    ("C3", 3, 18, "", "h@x.com", "x@y", "z@z.com", None, None, None, H),                # empty code
]


def test_build(spark):
    rls = {r["sales_group"]: r for r in R.build_rls(spark.createDataFrame(ROWS, COLS)).collect()}
    assert rls[10]["hierarchy_path"] == "a_at_x_dot_com.b_at_x_dot_com"
    assert rls[11]["hierarchy_path"] == "a_at_x_dot_com.b_at_x_dot_com.a_at_x_dot_com"
    assert rls[12]["hierarchy_path"] == "a_at_x_dot_com.c_at_x_dot_com"
    assert rls[12]["email_id"] == "A@X.com"               # first non-empty raw e-mail
    assert 13 not in rls and 15 not in rls
    assert rls[14]["email_id"] == "p@x.com" and rls[14]["sh_2"] == ""
    assert rls[16]["hierarchy_path"] == "h_at_x_dot_com.x_at_y.z_at_z_dot_com"


def test_lookup_exact_element_not_like(spark):
    rls = R.build_rls(spark.createDataFrame(ROWS, COLS))
    users = spark.createDataFrame([("x@y",), ("a@x.com",), ("nobody@x.com",)], "email string")
    interior = {(r[0], r[1]) for r in R.lookup_codes(rls, users, interior_only=True).collect()}
    # LIKE '%.x_at_y.%' would also match 'xqatry' (row 17); exact matching does not.
    assert interior == {("x@y", "W7")}          # a@x.com is only ever first or last
    member = {(r[0], r[1]) for r in R.lookup_codes(rls, users, interior_only=False).collect()}
    assert ("a@x.com", "W1") in member and ("x@y", "W8") not in member
    assert all(code != "" for _, code in member)


def test_secured_fact(spark):
    rls = R.build_rls(spark.createDataFrame(ROWS, COLS))
    fact = spark.createDataFrame([(10, 1.0), (11, 2.0), (12, 3.0), (10, 4.0), (None, 5.0)], "sales_group_code int, v double")
    got = sorted(tuple(r) for r in R.secured_fact(fact, rls, "b@x.com").collect())
    assert got == [(10, 1.0), (10, 4.0), (11, 2.0)]
    assert R.secured_fact(fact, rls, "nobody@x.com").count() == 0
    grants = R.user_groups(rls, spark.createDataFrame([("b@x.com",)], "email string"))
    assert [tuple(r) for r in R.secured_totals(fact, grants, "v").collect()] == [("b@x.com", 3, 7.0)]
