"""Operator 2 against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslake.llm.op02_cover_tree import CoverTree, dual_search, top_k


def brute(rows, k=5):
    whole = [(i, np.floor(256 * np.array(v, np.float64)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({(i, v.tobytes()) for i, v in whole if i % 50 == 0}):
        vec = np.frombuffer(q[1], np.int64)
        found = sorted((-int(v @ vec), i) for i, v in whole if i != q[0] and len(v) == len(vec))[:k]
        out += [(q[0], r + 1, i, -s) for r, (s, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("spread", [1.0, 0.02])
def test_dual_tree(spread):
    rng = np.random.default_rng(4)
    mids = rng.normal(size=(12, 16))
    x = np.floor(256 * (mids[rng.integers(0, 12, 3000)] + spread * rng.normal(size=(3000, 16)))).astype(np.int64)
    x[100:400] = x[100]  # many equal vectors
    ids = np.arange(3000)
    q = CoverTree.build(ids[::50], x[::50], leaf=8)
    c = CoverTree.build(ids, x, leaf=8)
    assert sorted(c.ids.tolist()) == ids.tolist()
    for node in range(len(c.radius)):
        own = c.vectors[c.at[node] : c.end[node]] - c.center[node]
        assert np.sqrt((own**2).sum(1)).max() <= c.radius[node]
    best, scored = dual_search(q, c)
    s = (q.vectors @ c.vectors.T).astype(float)
    s[q.ids[:, None] == c.ids[None]] = -np.inf
    top = np.lexsort((np.broadcast_to(c.ids, s.shape), -s), axis=1)[:, :5]
    assert np.array_equal(c.ids[top], best.ids) and np.array_equal(np.take_along_axis(s, top, 1), best.scores)
    if spread < 1:
        assert scored < 0.5 * s.size  # whole branches are pruned
    loaded = CoverTree.load(c.dump())
    assert np.array_equal(loaded.vectors, c.vectors) and np.array_equal(loaded.length, c.length)


def test_top_k(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(1000 + i, [0.5] * 6) for i in range(120)]  # ties
    rows += [(450, None), (500, [float("nan")] * 6), (550, [None] + [1.0] * 5), (600, [float("inf")] + [1.0] * 5), (None, [1.0] * 6), (50, rows[50][1]), (650, [1.0, 2.0]), (651, [2.0, 1.0]), (700, [])]
    df = spark.createDataFrame([(i, v, 1, "s", 2, 3) for i, v in rows], "vec_id long, embedding array<double>, label int, score string, id int, rank int")
    got = top_k(df, F.col("vec_id") % 50 == 0, block=64, query_block=8, pivots=5)
    assert sorted(map(tuple, got.collect())) == brute(rows)


def test_hot_id_is_split(spark, monkeypatch):
    """All rows of one id: blocks stay small, and the result is the brute-force one."""
    from saleslake.llm import op02_cover_tree as tree

    rng = np.random.default_rng(8)
    rows = [(7, [float(x) for x in rng.normal(size=4)]) for _ in range(300)] + [(50, [1.0, 0.5, 0.0, -1.0]), (100, [0.0] * 4)]
    sizes = []
    made = tree._blocks
    monkeypatch.setattr(tree, "_blocks", lambda *a: sizes.append(made(*a)) or sizes[-1])
    got = tree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, block=32, pivots=1)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    held = [len(CoverTree.load(r.tree).ids) for r in sizes[0].collect()]
    assert sum(held) == 302 and max(held) < 100


def test_tree_of_blocks(spark, monkeypatch):
    """Several levels of nodes over the blocks: the same result, and far fewer pairs of blocks than all with all."""
    from saleslake.llm import op02_cover_tree as tree

    rng = np.random.default_rng(9)
    mids = 8 * rng.normal(size=(40, 5))
    rows = [(i, [float(x) for x in mids[i % 40] + 0.05 * rng.normal(size=5)]) for i in range(1600)]
    rows += [(3000 + i, [1.0] * 5) for i in range(60)] + [(4000 + i, [float(i), 1.0]) for i in range(0, 200, 10)]  # ties; other lengths
    held, made = {}, tree.written
    monkeypatch.setattr(tree, "written", lambda df, path: held.setdefault(path.rsplit("/", 1)[1].rsplit("-", 1)[0] + str(len(held)), made(df, path)))
    got = tree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, block=20, query_block=2, pivots=40, fan=4)
    assert sorted(map(tuple, got.collect())) == brute(rows)
    sizes = {name.rstrip("0123456789"): [] for name in held}
    for name, df in held.items():
        sizes[name.rstrip("0123456789")].append(df.count())
    assert len(sizes["cover-level"]) >= 2 and sizes["cover-level"] == sorted(sizes["cover-level"], reverse=True)
    all_pairs = sizes["cover-candidates-trees"][0] * sizes["cover-queries-trees"][0]
    assert sizes["cover-first"] == sizes["cover-queries-trees"] and sizes["cover-pairs"][0] < 0.5 * all_pairs


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(df, F.col("vec_id") % 50 == 0).count() == 0
