"""N2 contents: against a full comparison; ranges that agree are not looked at again."""

import random
from collections import Counter

import pytest

from saleslake.operators import recon as RC

SCHEMA = "k int, a string, b double"


def brute(left, right):
    by = [Counter(r[0] for r in rows) for rows in (left, right)]
    rows = [Counter(rows) for rows in (left, right)]
    keys = {r[0] for r in (rows[0] - rows[1]) + (rows[1] - rows[0])}
    out = []
    for k in keys:
        n, m = by[0][k], by[1][k]
        out.append((k, n, m, "missing_in_source" if not n else "missing_in_target" if not m else "repeated" if n != m else "changed"))
    return sorted(out, key=str)


@pytest.mark.parametrize("changes", [0, 1, 40, 400])
def test_against_full_comparison(spark, changes):
    rng = random.Random(changes)
    value = lambda: (rng.choice([None, "x", "", "y"]), rng.choice([None, 0.0, 1.5]))
    left = [(rng.choice([None, *range(300)]), *value()) for _ in range(1_000)]
    left += [(7, "hot", 1.0)] * 500
    right = list(left)
    for _ in range(changes):
        at = rng.randrange(len(right))
        what = rng.randrange(3)
        if what == 0:
            right[at] = (right[at][0], *value())
        elif what == 1:
            right.append((rng.choice([None, *range(320)]), *value()))
        else:
            del right[at]
    rng.shuffle(right)
    got = RC.recon_contents(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"])
    assert sorted(map(tuple, got.collect()), key=str) == brute(left, right)


def test_nulls_in_other_columns_differ(spark):
    left, right = ([(1, None, 2.0), (2, "a", None)], [(1, "a", None), (2, None, 2.0)])
    got = RC.recon_contents(*(spark.createDataFrame(x, SCHEMA) for x in (left, right)), ["k"])
    assert {r["status"] for r in got.collect()} == {"changed"} and got.count() == 2
    none = spark.createDataFrame([], SCHEMA)
    assert RC.recon_contents(none, none, ["k"]).collect() == []
    assert {r["status"] for r in RC.recon_contents(none, spark.createDataFrame(right, SCHEMA), ["k"]).collect()} == {"missing_in_source"}


def test_only_differing_ranges_are_moved(spark):
    left = spark.range(20_000).selectExpr("cast(id as int) k", "cast(id * 3 as string) a", "cast(id as double) b")
    right = left.where("k <> 777")
    sides = [RC.digested(df, ["k"], left.columns) for df in (left, right)]
    coarse = RC.differing_ranges(*sides, 1, None)
    assert coarse.count() == 1
    fine = RC.differing_ranges(*sides, 2, coarse)
    assert fine.count() == 1
    assert RC.within(sides[0], fine, 2).count() < 10  # of 20,000
    plan = RC.recon_contents(left, right, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftSemi") == 2  # before the keys are grouped, on each side
    assert [tuple(r) for r in RC.recon_contents(left, right, ["k"]).collect()] == [(777, 1, 0, "missing_in_target")]


def test_keys_are_dealt_to_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    """The tasks that add up keys grow with the rows that differ, not with the session's number; a frequent key is no exception."""
    monkeypatch.setattr(RC, "ROWS_A_TASK", 200)
    left = [(i, "x", float(i)) for i in range(1_500)] + [(None, "n", 1.0)] * 900
    right = [(i, "x", i + 0.5) for i in range(1_500)] + [(None, "n", 1.0)] * 899
    got = RC.recon_contents(spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ["k"])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and ", 24" in plan  # 4,799 rows of 200
    assert sorted(map(tuple, got.collect()), key=str) == brute(left, right)
