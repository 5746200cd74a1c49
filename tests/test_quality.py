from saleslake.operators import quality as Q
from saleslake.operators import table as TB

T = "k long, v double, p string"
C = "k long, v double, p string, op string, seq int"


def test_merge_newest_change_wins(spark):
    tgt = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "a"), (3, 3.0, "b")], T)
    ch = spark.createDataFrame([(1, 10.0, "a", "U", 1), (1, 11.0, "a", "U", 2), (2, 0.0, "a", "D", 5),
                                (2, 9.0, "a", "U", 4), (4, 4.0, "c", "I", 1)], C)
    out = sorted(map(tuple, Q.merge_upsert(tgt, ch, "k").collect()))
    assert out == [(1, 11.0, "a"), (3, 3.0, "b"), (4, 4.0, "c")]


def test_merge_partitions_moves_keys_and_clears_empty(spark, tmp_root):
    root = f"{tmp_root}/t"
    TB.create(spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (3, 3.0, "c"), (4, 4.0, None), (5, 5.0, None)], T), root, "p")
    ch = spark.createDataFrame([(1, 1.5, "b", "U", 1), (2, 0.0, "b", "D", 1), (4, 4.5, None, "U", 1), (6, 6.0, "n", "I", 1)], C)
    touched = Q.merge_partitions(spark, root, ch, "k", "p")
    assert sorted(touched, key=repr) == sorted(["a", "b", None, "n"], key=repr)
    got = sorted((r["k"], r["v"], r["p"]) for r in TB.read_table(spark, root).collect())
    assert got == [(1, 1.5, "b"), (3, 3.0, "c"), (4, 4.5, None), (5, 5.0, None), (6, 6.0, "n")]


def test_recon(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "g int")
    b = spark.createDataFrame([(1,), (3,), (None,)], "g int")
    got = {r["g"]: (r["source_rows"], r["target_rows"], r["status"]) for r in Q.recon_counts(a, b, ["g"]).collect()}
    assert got == {1: (2, 1, "mismatch"), 2: (1, 0, "missing_in_target"), 3: (0, 1, "missing_in_source"),
                   None: (1, 1, "match")}
    assert [tuple(r) for r in Q.recon_duplicates(a, ["g"]).collect()] == [(1, 2)]
    miss = {tuple(r) for r in Q.recon_missing_keys(a, b, "g", "g", "a", "b").collect()}
    assert miss == {(2, "missing_in_b"), (3, "missing_in_a")}


def test_enrich_never_multiplies_rows(spark):
    fact = spark.createDataFrame([(1, 5.0), (2, 6.0)], "m long, v double")
    dim = spark.createDataFrame([(1, "x"), (1, "x2")], "k long, brand string")
    out = Q.enrich(fact, dim, "m", "k", ["brand"])
    assert sorted(tuple(r) for r in out.collect()) == [(1, 5.0, "x"), (2, 6.0, None)]
