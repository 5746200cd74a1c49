from pyspark.sql import functions as F

from saleslake.functions import naming as N


def test_normalize_and_lookup_keys():
    assert N.normalize_name('"Customer Group 3-Status"') == "customergroup3status"
    assert N.normalize_name("size/dimensions") == "sizedimensions"
    assert N.normalize_name("cgst%") == "cgst"
    assert N.lookup_key("Div") == "div_raw"           # reserved word keeps a suffix
    assert N.lookup_key("DivisionField") == "divisionfield"


def test_reserved_words_exact_case_insensitive():
    assert N.is_reserved("select") and N.is_reserved("Div")
    assert not N.is_reserved("DropDownSelectionForPoi")
    assert N.safe_name("Select") == "Select_raw"
    assert N.reserved_renames(["a", "Desc", "desc_x"]) == {"Desc": "Desc_raw"}


def test_snake_case_and_longest_prefix():
    assert N.snake_case("SalesTargetPlan") == "sales_target_plan"
    assert N.snake_case("HTTPServerLog") == "http_server_log"
    # longest prefix wins: mapping files must not go to dim_material
    assert N.table_from_stem("DimMaterialMapping_2024") == "dim_material_mapping"
    assert N.table_from_stem("DimMaterial_2024") == "dim_material"
    assert N.table_from_stem("FactInvoiceSecondary_901") == "fact_invoice_secondary"
    assert N.table_from_stem("NewThing") == "new_thing"


def test_column_routing_matches_python(spark):
    names = ["FactInvoiceDetails_107_112_2024.csv", "FactInvoiceDetails_107_112.csv",
             "FactInvoiceSecondary_901_1.csv.gz", "dimdealer_2024.csv", "DimMaterialMapping_x.csv",
             "FactInvoiceSecondary_DD_2024.csv", "X_901_1.csv.gz"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    out = df.select("name", N.col_csv_stem(F.col("name")).alias("stem"))
    out = out.select("name", "stem", N.col_table_from_stem(F.col("stem")).alias("t"),
                     N.col_dataset_name(F.col("stem")).alias("d"),
                     F.array_join(N.col_groups_from_stem(F.col("stem")), ",").alias("g"))
    got = {r["name"]: (r["stem"], r["t"], r["d"], r["g"]) for r in out.collect()}
    assert got["FactInvoiceDetails_107_112_2024.csv"] == (
        "FactInvoiceDetails_107_112_2024", "fact_invoice_details", "FactInvoiceDetails_107_112", "107,112,2024")
    # without a trailing "_" the regex backtracks to one numeric group
    assert got["FactInvoiceDetails_107_112.csv"][2] == "FactInvoiceDetails_107"
    assert got["FactInvoiceSecondary_901_1.csv.gz"][0] == "FactInvoiceSecondary_901_1"
    assert got["dimdealer_2024.csv"][2] == "DimDealerMaster"
    assert got["DimMaterialMapping_x.csv"][1] == "dim_material_mapping"
    # the dataset name keeps digits only, so DD is lost there (kept as a load argument instead)
    assert got["FactInvoiceSecondary_DD_2024.csv"][2] == "FactInvoiceSecondary"
    assert got["X_901_1.csv.gz"] == ("X_901_1", "x_901_1", "X", "901,1")
    for n in names:
        stem = got[n][0]
        assert got[n][1] == N.table_from_stem(stem)
