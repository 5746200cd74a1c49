import pytest
from pyspark.sql import functions as F

from saleslake.operators.load import LoadError, read_current
from saleslake.sources import seeds as SEED
from saleslake.spec import DIM_SALES_GROUP
from saleslake.streaming import ingest as ST


def _write(path, text):
    import os
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/seed.csv", "w", encoding="utf-8") as f:
        f.write(text)


def test_seed_blank_cells_quotes_and_dashes(spark, tmp_root):
    _write(f"{tmp_root}/s", 'SalesGroup,Division,Vertical\n101,IP1,FV – JOINERY\n105,"O\'Neil, Ltd",  \n')
    df = SEED.read_seed(spark, f"{tmp_root}/s")
    rows = sorted(map(tuple, df.collect()))
    assert rows == [("101", "IP1", "FV – JOINERY"), ("105", "O'Neil, Ltd", None)]
    # Vertical is NOT NULL: nothing may be published
    with pytest.raises(LoadError):
        SEED.load_seed(spark, f"{tmp_root}/s", DIM_SALES_GROUP, f"{tmp_root}/t")


def test_seed_load_resolves_pascal_headers(spark, tmp_root):
    _write(f"{tmp_root}/s", "SalesGroup,Division,Vertical\n101,IP1,FV\n 105 ,IP2,Retail\n")
    SEED.load_seed(spark, f"{tmp_root}/s", DIM_SALES_GROUP, f"{tmp_root}/t")
    out = read_current(spark, f"{tmp_root}/t")
    assert out.columns == ["division", "sales_group", "vertical"]
    assert sorted(r["sales_group"] for r in out.collect()) == [101, 105]


def test_batch_replay_is_idempotent(spark, tmp_root):
    write = ST.idempotent_batch_writer(f"{tmp_root}/out", "events", "r1")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    write(df, 0)
    write(df, 0)                       # the same batch replayed after a failure
    write(df.where("k = 2"), 1)
    back = spark.read.parquet(f"{tmp_root}/out")
    assert back.count() == 3
    assert {r["load_label"] for r in back.collect()} == {"events_0", "events_1"}


def test_two_streams_share_a_target(spark, tmp_root):
    out = f"{tmp_root}/out"
    for name, rows in (("a", [("1", "x"), ("2", "y")]), ("b", [("3", "z")])):
        spark.createDataFrame(rows, "k string, v string").write.option("header", True).csv(f"{tmp_root}/{name}")
        stream = ST.csv_stream(spark, f"{tmp_root}/{name}", ["k", "v"])
        assert ST.ingest_batches(stream, out, f"{tmp_root}/ck-{name}", "t") == 1
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == ["1", "2", "3"]


def test_seed_values_that_do_not_convert_stop_the_load(spark, tmp_root):
    _write(f"{tmp_root}/s", "SalesGroup,Division,Vertical\nabc,IP1,FV\n")
    with pytest.raises(LoadError, match="sales_group"):
        SEED.load_seed(spark, f"{tmp_root}/s", DIM_SALES_GROUP, f"{tmp_root}/t")


def test_seed_registry_run(spark, tmp_root):
    _write(f"{tmp_root}/in/good", "SalesGroup,Division,Vertical\n101,IP1,FV\n")
    _write(f"{tmp_root}/in/bad", "SalesGroup,Division,Vertical\nx,IP1,FV\n")
    reg = {k: SEED.Seed(k, f, enabled=on, truncate_before_load=cut) for k, f, on, cut in
           (("a", "good", True, True), ("b", "bad", True, True), ("c", "good", False, True), ("d", "good", True, False))}
    specs = dict.fromkeys(reg, DIM_SALES_GROUP)
    for _ in range(2):
        st = {r["table"]: (r["status"], r["n_rows"], r["error"]) for r in SEED.load_seeds(spark, reg, specs, f"{tmp_root}/in", f"{tmp_root}/out").collect()}
    assert st["a"] == ("Success", 1, None) and st["c"] == ("Skipped", None, None) and st["d"] == ("Success", 2, None)
    assert st["b"][0] == "Failed" and "sales_group" in st["b"][2]


def test_available_now_picks_only_new_files(spark, tmp_root):
    land, out, ck = f"{tmp_root}/land", f"{tmp_root}/out", f"{tmp_root}/ck"
    cols = ["k", "v"]
    spark.createDataFrame([("1", "a,b"), ("2", 'q"x')], "k string, v string").write.option("header", True) \
        .option("escape", '"').csv(land)
    ST.ingest_available(ST.csv_stream(spark, land, cols), out, ck)
    ST.ingest_available(ST.csv_stream(spark, land, cols), out, ck)
    assert spark.read.parquet(out).count() == 2
    assert ST.ingest_available(ST.csv_stream(spark, land, cols), out, ck) == 0
    spark.createDataFrame([("3", "c")], "k string, v string").write.mode("append").option("header", True).csv(land)
    ST.ingest_available(ST.csv_stream(spark, land, cols), out, ck)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert got == [("1", "a,b"), ("2", 'q"x'), ("3", "c")]
