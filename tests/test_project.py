from saleslake.operators import project as PR
from saleslake.spec import TableSpec, parse_columns

SPEC = TableSpec("dim", parse_columns(
    'customer_code:BIGINT, customer_group:VARCHAR(5), cm_customer_group:VARCHAR(120)<-"customer group", '
    'div_col_rf:VARCHAR(105)<-"div", cgst_percent:DOUBLE<-"cgst%", branch_code:VARCHAR(10)<-"branch code"'
))


def test_rename_without_collisions(spark):
    df = spark.createDataFrame([(1, "a", "b", "d", 1.0, "x", "s")],
                               "CustomerCode long, customergroup string, `customer group` string, Div string, "
                               "`cgst%` double, `Branch Code` string, `Select` string")
    out = PR.rename_to_spec(df, SPEC)
    assert out.columns == ["customer_code", "customer_group", "cm_customer_group", "div_col_rf",
                           "cgst_percent", "branch_code", "Select_raw"]


def test_schema_diff_and_order(spark):
    df = spark.createDataFrame([(1, "x", 9)], "customer_code long, DIV_COL_RF string, extra int")
    only_data, only_table = PR.schema_diff(df, SPEC)
    assert only_data == ["extra"]
    assert set(only_table) == {"customer_group", "cm_customer_group", "cgst_percent", "branch_code"}
    ordered = PR.select_table_order(df, SPEC, fill_missing=True)
    assert ordered.columns == SPEC.names
    assert dict(ordered.dtypes)["cgst_percent"] == "double"


def test_type_gate(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "customer_code int, customer_group string, cgst_percent float")
    assert PR.type_mismatches(df, SPEC) == []          # INT~BIGINT, FLOAT~DOUBLE
    bad = spark.createDataFrame([("1",)], "customer_code string")
    assert PR.type_mismatches(bad, SPEC) == [("customer_code", "VARCHAR", "BIGINT")]


def test_best_match_prefers_type(spark):
    spec = TableSpec("t", parse_columns("customer_group_3:SMALLINT, customer_group_3_status:VARCHAR(107)"))
    assert PR.best_match("customer group 3", True, spec) == "customer_group_3_status"
    assert PR.best_match("customer group 3", False, spec) == "customer_group_3"


def test_upgrade_table():
    from saleslake.spec import is_allowed_upgrade

    assert is_allowed_upgrade("TINYINT", "BIGINT") and is_allowed_upgrade("FLOAT", "DOUBLE")
    assert not is_allowed_upgrade("BIGINT", "INT") and not is_allowed_upgrade("VARCHAR(5)", "INT")


def test_mapping_files_and_check(tmp_path):
    import json

    from saleslake.spec import load_mappings, load_order

    (tmp_path / "05_DimSalesGroup.json").write_text(json.dumps({
        "salesgroup": {"db_column": "sales_group", "data_type": "SMALLINT"},
        "division": {"db_column": "division", "data_type": "VARCHAR", "max_string_length": 50},
    }))
    (tmp_path / "07_FactInvoiceDetails.json").write_text(json.dumps({
        "div": {"db_column": "div_col_rf", "data_type": "VARCHAR(105)"},
    }))
    (tmp_path / "08_Broken.json").write_text("{not json")
    specs, skipped = load_mappings(tmp_path)
    assert skipped == ["08_Broken.json"]
    assert set(specs) == {"dim_sales_group", "fact_invoice_details"}
    sg = specs["dim_sales_group"]
    assert [(c.name, c.type) for c in sg.columns] == [("sales_group", "SMALLINT"), ("division", "VARCHAR(50)")]
    assert specs["fact_invoice_details"].columns[0].incoming() == "div"
    assert [s.name for s in load_order(specs)] == ["dim_sales_group", "fact_invoice_details"]
    assert PR.check_mapping({"salesgroup": "sales_group", "x": "nope"}, sg) == ["nope"]


def test_seed_registry():
    from saleslake.sources.seeds import Seed, enabled_seeds

    reg = {"a": Seed("dim_a", "a.csv"), "b": Seed("dim_b", "b.csv", enabled=False)}
    assert list(enabled_seeds(reg)) == ["a"]


def test_table_reader_and_scale_conf(spark, tmp_path):
    from saleslake.session import scale_conf
    from saleslake.sources.tables import read_table, table_columns

    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(path)
    df = read_table(spark, path, fmt="parquet")
    assert table_columns(df) == [("k", "int"), ("v", "string")]
    conf = scale_conf(100 * 1024 ** 4, executors=1000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
    small = scale_conf(1024, executors=10)
    assert int(small["spark.sql.shuffle.partitions"]) == 2 * 10 * 4
