import pytest
from pyspark.sql import functions as F

from saleslake.operators import load as L
from saleslake.operators import table as TB
from saleslake.spec import TableSpec, parse_columns

SCHEMA = "sales_group_code short, record_type string, value double"
TARGET = [(None, "AB", 0.5), (None, "DD", 0.25), (1, "AB", 1.0), (1, "DD", 2.0), (1, None, 3.0), (2, "AB", 4.0), (3, "AB", 5.0), (3, "DD", 6.0), (4, "X", 7.0)]


def _seed(spark, root):
    TB.create(spark.createDataFrame(TARGET, SCHEMA), root, "sales_group_code")


def _rows(spark, root):
    return sorted(((r["sales_group_code"], r["record_type"], r["value"]) for r in TB.read_table(spark, root).collect()), key=repr)


def test_replace_groups_not_dd_keeps_dd_and_null(spark, tmp_root):
    root = f"{tmp_root}/fact"
    _seed(spark, root)
    new = spark.createDataFrame([(1, "AB", 10.0), (None, "AB", 11.0)], SCHEMA)
    # group 3 is named in the file but has no new rows: its non-DD rows go; rows without a group stay and come
    L.replace_groups_not_dd(spark, root, new, ["1", "3"])
    assert _rows(spark, root) == sorted([(None, "AB", 0.5), (None, "DD", 0.25), (None, "AB", 11.0), (1, "DD", 2.0), (1, None, 3.0), (1, "AB", 10.0), (2, "AB", 4.0),
                                         (3, "DD", 6.0), (4, "X", 7.0)], key=repr)


def test_replace_dd_everywhere(spark, tmp_root):
    root = f"{tmp_root}/fact"
    _seed(spark, root)
    L.replace_dd(spark, root, spark.createDataFrame([(2, "DD", 9.0)], SCHEMA))
    assert [r for r in _rows(spark, root) if r[1] == "DD"] == [(2, "DD", 9.0)]
    assert len(_rows(spark, root)) == 7
    L.replace_dd(spark, root, spark.createDataFrame([(None, "DD", 1.0)], SCHEMA))
    assert [r for r in _rows(spark, root) if r[1] == "DD"] == [(None, "DD", 1.0)]


def test_replace_expanded_removes_empty_partitions(spark, tmp_root):
    root = f"{tmp_root}/fact"
    data = [(107, "A", 1.0), (112, "A", 2.0), (101, "A", 3.0), (203, "A", 4.0), (999, "A", 5.0)]
    TB.create(spark.createDataFrame(data, SCHEMA), root, "sales_group_code")
    assert "101" in L.expand_groups(["107", "112"]) and L.expand_groups(["107"]) == ["107"]
    L.replace_groups_expanded(spark, root, spark.createDataFrame([(107, "B", 7.0)], SCHEMA), ["107", "112"])
    assert _rows(spark, root) == [(107, "B", 7.0), (999, "A", 5.0)]


def test_versioned_refresh_and_create(spark, tmp_root):
    root = f"{tmp_root}/dim"
    spec = TableSpec("d", parse_columns("k:INT!, name:VARCHAR(10)"))
    assert L.create_table(spark, spec, root) == 1
    assert L.read_current(spark, root).count() == 0
    L.publish_version(spark.createDataFrame([(1, "a")], "k int, name string"), root)
    # an uncommitted version (no _SUCCESS) is never read
    spark.createDataFrame([(9, "z")], "k int, name string").write.parquet(f"{root}/v=000099")
    from saleslake.session import hadoop_fs
    fs, _ = hadoop_fs(spark, root)
    fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/v=000099/_SUCCESS"), False)
    assert L.current_version(spark, root) == 2
    assert [tuple(r) for r in L.read_current(spark, root).collect()] == [(1, "a")]
    assert L.drop_table(spark, root) and not L.drop_table(spark, root)


def test_create_all(spark, tmp_root):
    specs = {n: TableSpec(n, parse_columns("k:INT, name:VARCHAR(9)"), order=o) for n, o in (("fact_a", 0), ("dim_b", 2), ("dim_c", 1))}
    rows = {"dim_c": spark.createDataFrame([(1, "x")], "k long, name string")}
    views = {"v_names": "SELECT c.name FROM dim_c c LEFT JOIN dim_b USING (k)", "v_bad": "SELECT nothing FROM nowhere", "v_more": "SELECT * FROM v_names"}
    got = [tuple(r)[:3] for r in L.create_all(spark, specs, tmp_root, views, rows).collect()]
    assert got == [("table", "dim_c", "created"), ("table", "dim_b", "created"), ("table", "fact_a", "created"),
                   ("view", "v_names", "created"), ("view", "v_bad", "failed"), ("view", "v_more", "created")]
    assert [r[0] for r in spark.table("v_more").collect()] == ["x"]
    again = [r["status"] for r in L.create_all(spark, specs, tmp_root).collect()]
    assert again == ["exists"] * 3


def test_tolerance_boundary(spark):
    spec = TableSpec("t", parse_columns("u:VARCHAR(5), v:INT"))
    rows = [("A", "x" if i < 10 else str(i)) for i in range(100)]           # 10.0 % filtered
    rows += [("B", "x" if i < 102 else str(i)) for i in range(1000)]       # 10.2 % filtered
    res = L.tolerant_load(spark.createDataFrame(rows, "u string, v string"), spec, "u")
    st = {r["u"]: (r["total"], r["loaded"], r["filtered"], r["status"]) for r in res.status.collect()}
    assert st == {"A": (100, 90, 10, "Success"), "B": (1000, 0, 102, "Failed")}
    # a failed unit's good rows are rejected too: every row is loaded or rejected
    assert res.loaded.count() == 90 and res.rejected.count() == 10 + 1000
    reasons = {(r["u"], r["reason"]): r["n"] for r in res.rejected.groupBy("u", "reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {("A", "bad_value"): 10, ("B", "bad_value"): 102, ("B", "unit_failed"): 898}
    summary = {r["status"]: (r["units"], r["rows_loaded"]) for r in L.summarize(res.status).collect()}
    assert summary == {"Success": (1, 90), "Failed": (1, 0)}


def test_soh_export_roundtrip(spark, tmp_root):
    df = spark.createDataFrame([(1, "a,b", None), (2, 'q"t', "x\ny")], "k int, s string, t string")
    L.write_delimited(df, f"{tmp_root}/soh")
    from saleslake.sources.files import csv_reader
    back = csv_reader(spark, sep="\u0001", header=False, multi_line=True).schema(df.schema).csv(f"{tmp_root}/soh")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_tolerance_without_a_unit(spark):
    spec = TableSpec("t", parse_columns("u:VARCHAR(5), v:INT, d:DATE"))
    rows = [(None, str(i), "5/1/2024") for i in range(20)] + [(None, "x", "15/12/2024"), ("A", "1", None)]
    res = L.tolerant_load(spark.createDataFrame(rows, "u string, v string, d string"), spec, "u")
    st = {r["u"]: (r["total"], r["loaded"], r["status"]) for r in res.status.collect()}
    assert st == {None: (21, 20, "Success"), "A": (1, 1, "Success")}
    loaded = res.loaded.collect()
    assert len(loaded) == 21 and res.rejected.count() == 1
    assert {str(r["d"]) for r in loaded} == {"2024-01-05", "None"}        # the format that fits, unpadded days too


def test_replace_drops_escaped_and_empty_partitions(spark, tmp_root):
    root = f"{tmp_root}/s"
    schema = "grp string, v int"
    TB.create(spark.createDataFrame([("a/b c", 1), ("x", 2), ("", 3), (None, 4)], schema), root, "grp")
    TB.replace(spark, root, spark.createDataFrame([], schema), None, ["a/b c"])
    got = sorted(((r["grp"], r["v"]) for r in TB.read_table(spark, root).collect()), key=repr)
    assert got == sorted([("x", 2), ("", 3), (None, 4)], key=repr)
    TB.replace(spark, root, spark.createDataFrame([(None, 5)], schema), F.col("v") == 4, [None])
    assert sorted(r["v"] for r in TB.read_table(spark, root).collect()) == [2, 3, 5]


def test_a_load_that_dies_changes_nothing(spark, tmp_root, monkeypatch):
    root = f"{tmp_root}/fact"
    _seed(spark, root)
    before = _rows(spark, root)

    def crash(*_):
        raise OSError("lost between write and switch")

    with monkeypatch.context() as m:
        m.setattr(TB, "commit", crash)
        with pytest.raises(OSError):
            L.replace_groups_not_dd(spark, root, spark.createDataFrame([(1, "AB", 9.0)], SCHEMA), ["1"])
    assert _rows(spark, root) == before
    L.append(spark.createDataFrame([(7, "AB", 9.0)], SCHEMA), root)
    assert len(_rows(spark, root)) == len(before) + 1
    assert TB.vacuum(spark, root) == 1                       # what the dead load had written
    assert len(_rows(spark, root)) == len(before) + 1
    with pytest.raises(L.LoadError):                          # two loads cannot publish the same version
        TB.commit(spark, root, TB.manifest(spark, root))


def test_widened_column_reads_everywhere(spark, tmp_root):
    root = f"{tmp_root}/w"
    TB.create(spark.createDataFrame([(1, 5, 1.5), (2, 6, 2.5)], "g int, n short, x float"), root, "g")
    TB.replace(spark, root, spark.createDataFrame([(1, 99_999_999_999, 0.1, "z")], "g int, n long, x double, t string"), F.lit(True), ["1"])
    got = sorted(tuple(r) for r in TB.read_table(spark, root).collect())
    assert got == [(1, 99_999_999_999, 0.1, "z"), (2, 6, 2.5, None)]
    assert sorted(tuple(r) for r in TB.read_table(spark, root, version=1).collect()) == [(1, 5, 1.5), (2, 6, 2.5)]
    with pytest.raises(L.LoadError):
        TB.append(spark.createDataFrame([("a", 1, 1.0)], "g string, n long, x double"), root)


def test_overwrite_does_not_depend_on_the_session(spark, tmp_root):
    path = f"{tmp_root}/p"
    old = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        L.write_parquet(spark.createDataFrame([(1, 1), (2, 2)], "k int, p int"), path, partition_by=("p",))
        L.write_parquet(spark.createDataFrame([(3, 1)], "k int, p int"), path, partition_by=("p",))
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", old)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(3, 1)]


def test_versions_stay_unless_asked(spark, tmp_root):
    root = f"{tmp_root}/v"
    df = spark.createDataFrame([(1,)], "k int")
    for _ in range(4):
        L.publish_version(df, root)
    assert [v for v, _ in L._versions(spark, root)] == [1, 2, 3, 4]
    L.publish_version(df, root, keep=2)
    assert [v for v, _ in L._versions(spark, root)] == [4, 5]


def test_load_file_kinds(spark, tmp_root):
    """Ragged rows aside, the floor of the kind, rows without a group, and a failed file that changes nothing."""
    import os

    from saleslake.plans.pipeline import load_file
    from saleslake.plans.specs import FACT_DETAILS

    def land(name, *lines):
        os.makedirs(f"{tmp_root}/{name}")
        with open(f"{tmp_root}/{name}/x.csv", "w") as f:
            f.write("\n".join(lines) + "\n")
        return f"{tmp_root}/{name}"

    root = f"{tmp_root}/details"
    TB.create(spark.createDataFrame([(1, 20230401, 107, 1.0, "F"), (2, 20230401, 5, 2.0, "F"), (3, 20230401, None, 3.0, "F")],
                                    "order_number long, posting_date int, sales_group_code short, net_value double, status string"), root, "sales_group_code")
    head = "postingdate,ordernumber,netvalue,salesgroupcode,status"
    landed = land("a", head, "20240101,10,1.5,107,F", "20240101,11,2.5,,O", "20200101,12,1,107,F", "20240101,13", "20240101,14,1,107,F,EXTRA")
    res = load_file(spark, landed, "FactInvoiceDetails_107_112_2024", FACT_DETAILS, root)
    assert (res.table, res.dataset, res.mode) == ("fact_invoice_details", "FactInvoiceDetails_107_112", "replace_expanded")
    keys = lambda: sorted(r["order_number"] for r in TB.read_table(spark, root).collect())
    assert keys() == [2, 3, 10, 11] and res.ragged.count() == 2
    # the name's year is no group (P13): only group 5 is replaced
    res = load_file(spark, land("b", head, "20240101,20,1,5,F"), "FactInvoiceDetails_5_2024", FACT_DETAILS, root)
    assert keys() == [3, 10, 11, 20] and res.affected == ["5"]
    with pytest.raises(L.LoadError):
        load_file(spark, land("c", head, *["20240101,,1,5,F"] * 2, "20240101,30,1,5,F"), "FactInvoiceDetails_5_2024", FACT_DETAILS, root)
    assert keys() == [3, 10, 11, 20]


def test_csv_by_header(spark, tmp_root):
    import os

    from saleslake.sources.files import read_csv_all_string, read_csv_checked
    os.makedirs(f"{tmp_root}/in")
    for name, text in (("a", "id,v\n1,x\n2,y,EXTRA\n3\n"), ("b", "v,id\ny,2\n"), ("c", ""), ("d", 'id\n"4"\n')):
        with open(f"{tmp_root}/in/{name}.csv", "w") as f:
            f.write(text)
    good, bad = read_csv_checked(spark, f"{tmp_root}/in", ["id", "v"])
    assert sorted((r["id"], r["v"]) for r in good.collect()) == [("1", "x"), ("2", "y"), ("4", None)]
    assert sorted(r["id"] for r in good.select("id").collect()) == ["1", "2", "4"]      # also when columns are pruned
    assert sorted(r["record"] for r in bad.collect()) == ["2,y,EXTRA", "3"]
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_all_string(spark, f"{tmp_root}/in/b.csv", columns=["id", "v"]).collect()


def test_listing_and_headers_by_tasks(spark, tmp_root):
    """Names that URIs escape, folders, gzip, blank first lines and empty files; layouts come as one frame."""
    import gzip
    import os

    from saleslake.sources.files import csv_headers, file_listing, read_csv_checked
    root = f"{tmp_root}/many"
    os.makedirs(f"{root}/a b/p=x%231")
    os.makedirs(f"{root}/_hidden")
    for name, text in (("a b/p=x%231/f+1.csv", "id,v\n1,2\n"), ("g.csv", "\n  \nv,id\ny,2\n"), ("a b/e+ m%20.csv", ""), ("blank.csv", "\n \n"), ("_hidden/x.csv", "id\n9\n"), ("note.txt", "")):
        with open(f"{root}/{name}", "w") as f:
            f.write(text)
    with gzip.open(f"{root}/h.csv.gz", "wt") as f:
        f.write("id,v\n3,z\n" + "4,z\n" * 1000)
    listed = {r["name"]: r for r in file_listing(spark, root, "*.csv*").collect()}
    assert {n: r["length"] for n, r in listed.items() if n != "h.csv.gz"} == {"f+1.csv": 9, "g.csv": 13, "e+ m%20.csv": 0, "blank.csv": 3}
    assert listed["h.csv.gz"]["length"] == os.path.getsize(f"{root}/h.csv.gz") and all(r["modified"] for r in listed.values())
    assert listed["e+ m%20.csv"]["path"].endswith("/many/a b/e+ m%20.csv")
    assert sorted(r["name"] for r in file_listing(spark, root).collect()) == sorted([*listed, "note.txt"])
    heads = {r["header"]: [f.rsplit("/", 1)[1] for f in r["files"]] for r in csv_headers(spark, root).collect()}
    assert heads == {"id,v": ["f+1.csv", "h.csv.gz"], "v,id": ["g.csv"]}
    good, bad = read_csv_checked(spark, root, ["id", "v"])
    rows = sorted((r["id"], r["v"]) for r in good.collect())
    assert rows == sorted([("1", "2"), ("2", "y"), ("3", "z")] + [("4", "z")] * 1000) and bad.count() == 0
    os.makedirs(f"{root}/none")
    assert file_listing(spark, f"{root}/none").count() == 0 and read_csv_checked(spark, f"{root}/none", ["id"])[0].count() == 0


def test_rows_of_one_unit_do_not_meet_in_one_task(spark):
    """The verdicts on a few units are sent to the rows, however many these are."""
    key, old = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "20k")
    try:
        rows = spark.range(20_000).selectExpr("'one' AS u", "cast(id * 1234567891 as string) AS v")
        res = L.tolerant_load(rows, TableSpec("t", parse_columns("v:BIGINT")), "u")
        for df in (res.loaded, res.rejected):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert res.loaded.count() == 20_000 and res.status.first()["status"] == "Success"
    finally:
        spark.conf.set(key, old)
