"""Exact top-k inner products by dual-tree search over cover trees (operator 2).

1. Vectors are dealt to blocks: nearest of ``PIVOTS`` pivots (a bounded sample:
   the rows with the smallest hashes), large cells split by a hash of the row's
   number (rows that repeat an id are split, too), so a block holds about ``BLOCK`` vectors whatever the distribution.  Each
   block becomes one cover tree: a node's children lie within its radius over
   ``BASE`` and further than that apart; every node keeps its covering radius
   and a bound for its vectors' lengths.  Queries are blocked likewise.
2. Candidate blocks are leaves of a tree of balls over their centers, whose
   levels each hold up to ``FAN`` children a node; levels are added until at most
   ``FAN`` nodes are on top.  Each query block first goes down to one candidate
   block, by the largest bound at every level; the worst kth score of its queries
   then rules out nodes on the way down that cannot reach it, and only blocks
   under the others are joined.  Within a pair of blocks the two trees are
   descended together; a pair of nodes is pruned when
   <q, c> + rq |c| + rc |q| + rq rc is below the worst kth score of the query
   node's queries.
3. Each query keeps its best k over all blocks (ties: smaller id).

Every row is a candidate.  A query block is compared with the at most ``FAN``
nodes on top, then with children of nodes that its bound admits (joined by node
number), so pairs of blocks are not listed all with all.  Only vectors of the same length are
compared.  Vectors that are null or hold a null or non-finite component take
no part, nor do rows with a null id.  Rows that repeat an id are separate
candidates, none of them a candidate of a query with that id; a repeated query
row is one query.  An empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm.common import query, scratch, table, written

K = 5
SCALE = 256
PIVOTS = 64
BLOCK = 4096
QUERY_BLOCK = 1024
FAN = 512
LEAF = 48
BASE = 1.3
EXACT = float(1 << 53)


class CoverTree:
    """A cover tree over integer vectors, as flat arrays; node 0 is the root.

    ``at``/``end``: the node's vectors in the tree's order.  ``first``/``count``:
    its children (0: a leaf).  ``center``, ``radius``: all its vectors lie in
    that ball.
    """

    PARTS = ("ids", "vectors", "center", "radius", "at", "end", "first", "count")

    def __init__(self, **parts: np.ndarray):
        self.__dict__.update(parts)
        self.length = np.sqrt((self.center.astype(np.float64) ** 2).sum(1))

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, base: float = BASE) -> "CoverTree":
        points = vectors.astype(np.float64)
        norms = (points**2).sum(1)

        def far(rows: np.ndarray, center: int) -> np.ndarray:
            return np.sqrt(np.maximum(0, norms[rows] + norms[center] - 2 * (points[rows] @ points[center])))

        nodes: list[list] = []  # center row, radius, rows, first child, children
        todo: list[int] = []

        def node(rows: np.ndarray, center: int, dist: np.ndarray) -> None:
            nodes.append([center, float(dist.max()), rows, 0, 0])
            if len(rows) > leaf and dist.max() > 0:
                todo.append(len(nodes) - 1)

        rows = np.arange(len(points))
        node(rows, 0, far(rows, 0))
        while todo:
            own = todo.pop()
            center, radius, rows, _, _ = nodes[own]
            within = radius / base
            near, owner = far(rows, center), np.zeros(len(rows), np.int64)
            centers = [center]
            while near.max() > within:  # the next child: the vector that is furthest from all children
                nxt = int(rows[int(near.argmax())])
                d = far(rows, nxt)
                closer = d < near
                near[closer], owner[closer] = d[closer], len(centers)
                centers.append(nxt)
            groups = [np.flatnonzero(owner == i) for i in range(len(centers))] if len(centers) <= len(rows) // 4 else None
            if groups is None:  # spread out: children of their own would each hold a vector or two
                continue
            nodes[own][3:] = [len(nodes), len(groups)]
            for c, g in zip(centers, groups):
                node(rows[g], c, far(rows[g], c))
        # the vectors in the order of the leaves, so that every node is one range
        order: list[np.ndarray] = []
        at, end, seen = np.zeros(len(nodes), np.int64), np.zeros(len(nodes), np.int64), 0
        stack = [(0, False)]
        while stack:
            i, done = stack.pop()
            if done:
                end[i] = seen
                continue
            at[i] = seen
            _, _, rows, first, count = nodes[i]
            if count:
                stack.append((i, True))
                stack.extend((c, False) for c in range(first + count - 1, first - 1, -1))
            else:
                order.append(rows)
                seen += len(rows)
                end[i] = seen
        perm = np.concatenate(order)
        return cls(
            ids=ids[perm], vectors=vectors[perm], center=vectors[[n[0] for n in nodes]], radius=np.array([n[1] for n in nodes]) * (1 + 1e-9) + 1e-6,
            at=at, end=end, first=np.array([n[3] for n in nodes]), count=np.array([n[4] for n in nodes]),
        )

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{p: getattr(self, p) for p in self.PARTS})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> "CoverTree":
        with np.load(io.BytesIO(data)) as parts:
            return cls(**{p: parts[p] for p in cls.PARTS})


class Best:
    """The k best (score, smaller id first) of each query of a tree, in the tree's order."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = np.full(n, -np.inf) if floor is None else floor

    def worst(self, at: int, end: int) -> float:
        return float(np.maximum(self.scores[at:end, -1], self.floor[at:end]).min())

    def offer(self, at: int, end: int, scores: np.ndarray, ids: np.ndarray) -> None:
        need = np.maximum(self.scores[at:end, -1], self.floor[at:end])
        rows = np.flatnonzero((scores >= need[:, None]).any(1))
        if not len(rows):
            return
        s = np.concatenate([self.scores[at:end][rows], scores[rows]], 1)
        i = np.concatenate([self.ids[at:end][rows], np.broadcast_to(ids, (len(rows), len(ids)))], 1)
        top = np.lexsort((i, -s), axis=1)[:, : self.k]
        self.scores[at + rows] = np.take_along_axis(s, top, 1)
        self.ids[at + rows] = np.where(np.isneginf(self.scores[at + rows]), np.iinfo(np.int64).max, np.take_along_axis(i, top, 1))


def dual_search(queries: CoverTree, cands: CoverTree, k: int = K, floor: np.ndarray | None = None) -> tuple[Best, int]:
    """Best k candidates of each query (not those with its own id), and the number of vector pairs scored."""
    best, scored = Best(len(queries.ids), k, floor), 0
    q_vec, c_vec = queries.vectors.astype(np.float64), cands.vectors.astype(np.float64)
    size = lambda v: float(np.sqrt((v**2).sum(1).max(initial=0)))
    if size(q_vec) * size(c_vec) >= EXACT:  # beyond what doubles add up exactly
        raise OverflowError("inner products do not fit 53 bits")
    q_mid, c_mid = queries.center.astype(np.float64), cands.center.astype(np.float64)

    def bounds(q: int, cs: np.ndarray) -> np.ndarray:
        rq, rc = queries.radius[q], cands.radius[cs]
        return c_mid[cs] @ q_mid[q] + rq * cands.length[cs] + rc * queries.length[q] + rq * rc + 1e-6

    stack = [(0, 0, float(bounds(0, np.array([0]))[0]))]
    while stack:
        q, c, bound = stack.pop()
        qa, qe = int(queries.at[q]), int(queries.end[q])
        if bound < best.worst(qa, qe):
            continue
        if not cands.count[c] and not queries.count[q]:
            ca, ce = int(cands.at[c]), int(cands.end[c])
            scores = q_vec[qa:qe] @ c_vec[ca:ce].T
            scores[queries.ids[qa:qe, None] == cands.ids[None, ca:ce]] = -np.inf
            scored += scores.size
            best.offer(qa, qe, scores, cands.ids[ca:ce])
        elif cands.count[c] and (not queries.count[q] or cands.radius[c] >= queries.radius[q]):
            cs = np.arange(cands.first[c], cands.first[c] + cands.count[c])
            b = bounds(q, cs)
            turn = np.argsort(b)  # the most promising child comes off the stack first
            stack.extend((q, int(cs[i]), float(b[i])) for i in turn)
        else:
            for child in range(int(queries.first[q]), int(queries.first[q] + queries.count[q])):
                stack.append((child, c, float(bounds(child, np.array([c]))[0])))
    return best, scored


def _parts(vectors: DataFrame, column: str, number: str, pivots: list[np.ndarray], size: int, name: str) -> DataFrame:
    """Rows with ``cell`` (the nearest of the pivots of their length) and ``part``: about ``size`` rows of a cell, by ``number``."""
    spark = vectors.sparkSession

    def cells(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            out = np.zeros(len(p), np.int64)
            for dim in p["dim"].unique():
                own, mids = np.flatnonzero(p["dim"] == dim), [v for v in pivots if len(v) == dim]
                if mids:
                    m = np.array(mids, np.float64)
                    x = np.stack(p[column].to_numpy()[own]).astype(np.float64) if dim else np.zeros((len(own), 0))
                    out[own] = ((m**2).sum(1)[None] - 2 * (x @ m.T)).argmin(1)
            p["cell"] = out
            yield p

    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.LongType())])
    dealt = written(vectors.mapInPandas(cells, schema), scratch(spark, f"cover-{name}"))
    sizes = dealt.groupBy("dim", "cell").count()
    return dealt.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64(number), F.ceil(F.col("count") / size))).drop("count")


def _blocks(vectors: DataFrame, pivots: list[np.ndarray], block: int, name: str) -> DataFrame:
    """dim, block, center, radius, tree for blocks of about ``block`` vectors."""
    spark = vectors.sparkSession
    dealt = _parts(vectors.withColumn("uid", F.monotonically_increasing_id()), "v", "uid", pivots, block, name)

    def build(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("id", kind="stable")
        tree = CoverTree.build(p["id"].to_numpy(np.int64), np.array(p["v"].tolist(), np.int64).reshape(len(p), -1))
        return pd.DataFrame({"dim": [p["dim"].iloc[0]], "center": [tree.center[0]], "radius": [tree.radius[0]], "tree": [tree.dump()]})

    trees = dealt.drop("uid").groupBy("dim", "cell", "part").applyInPandas(build, "dim int, center array<bigint>, radius double, tree binary")
    return written(trees.withColumn("block", F.monotonically_increasing_id()), scratch(spark, f"cover-{name}-trees"))


def _bound(q: str, c: str) -> Column:
    dot = F.expr(f"aggregate(zip_with({q}.center, {c}.center, (x, y) -> double(x) * double(y)), 0D, (s, x) -> s + x)")
    norm = lambda t: F.expr(f"sqrt(aggregate({t}.center, 0D, (s, x) -> s + double(x) * double(x)))")
    rq, rc = F.col(f"{q}.radius"), F.col(f"{c}.radius")
    return dot + rq * norm(c) + rc * norm(q) + rq * rc + F.lit(1e-3)


def _tree(blocks: DataFrame, fan: int) -> tuple[DataFrame, list[DataFrame]]:
    """The nodes on top (dim, block, center, radius), and the levels below from the top down (node, children).

    A node's ball holds the balls of its children, so its bound is one for all blocks under it.
    """
    spark = blocks.sparkSession
    top, levels, n = blocks, [], blocks.count()
    while n > fan:
        # at most one pivot for ``fan`` nodes, and ``fan`` of them in all: a level has at most about 2 n / fan nodes
        sample = top.select("center", F.xxhash64("block").alias("h")).orderBy("h").limit(min(fan, -(-n // fan))).toPandas()
        dealt = _parts(top, "center", "block", [np.asarray(v, np.float64) for v in sample["center"]], fan, "nodes")
        nodes = dealt.groupBy("dim", "cell", "part").agg(F.array_sort(F.collect_list(F.struct("block", "center", "radius"))).alias("children"))
        center = F.col("children")[0]["center"]
        reach = F.transform("children", lambda c: c["radius"] + F.sqrt(F.aggregate(F.zip_with(c["center"], center, lambda x, y: (x - y).cast("double")), F.lit(0.0), lambda s, d: s + d * d)))
        nodes = nodes.select("dim", F.monotonically_increasing_id().alias("block"), center.alias("center"), (F.array_max(reach) * (1 + 1e-9) + 1e-6).alias("radius"), "children")
        nodes = written(nodes, scratch(spark, "cover-level"))
        fewer = nodes.count()
        if fewer >= n:  # as many lengths of vectors as nodes, and only nodes of the same length are compared
            break
        levels.insert(0, nodes.select(F.col("block").alias("node"), "children"))
        top, n = nodes.select("dim", "block", "center", "radius"), fewer
    return top, levels


def top_k(df: DataFrame, is_query: Column, k: int = K, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE, block: int = BLOCK, query_block: int = QUERY_BLOCK, pivots: int = PIVOTS, fan: int = FAN) -> DataFrame:
    """query_id, rank, <key>, score: the k largest inner products of floor(scale * x) for the rows where ``is_query``."""
    spark = df.sparkSession
    whole = F.col("x").isNotNull() & F.col("key").isNotNull() & ~F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("x"), is_query.alias("q")).filter(whole)
    rows = rows.select(F.col("key").alias("id"), F.size("x").alias("dim"), F.transform("x", lambda v: F.floor(v * scale).cast("long")).alias("v"), "q")
    rows = written(rows, scratch(spark, "cover-vectors"))
    sample = rows.select("v", F.xxhash64("v", "id").alias("h")).orderBy("h").limit(pivots).toPandas()
    mids = [np.asarray(v, np.float64) for v in sample["v"]]
    cands = _blocks(rows.drop("q"), mids, block, "candidates")
    asked = _blocks(rows.filter("q").select("id", "dim", "v").dropDuplicates(["id", "v"]), mids, query_block, "queries")

    ball = F.struct("block", "center", "radius")
    top, levels = _tree(cands.select("dim", "block", "center", "radius"), fan)
    fronts = asked.select("dim", F.col("block").alias("q_block"), ball.alias("q"))

    def descend(front: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The rows of query blocks, each with ``c``, a candidate block, that ``keep`` leaves at every level."""
        step = front.join(top.select("dim", ball.alias("c")), "dim")
        step = keep(step.withColumn("bound", _bound("q", "c")))
        for level in levels:
            step = step.withColumn("node", F.col("c.block")).drop("c", "bound").join(level, "node").drop("node")
            step = step.withColumn("c", F.explode("children")).drop("children")
            step = keep(step.withColumn("bound", _bound("q", "c")))
        return step

    def search(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for row in p.itertuples(index=False):
                tree = CoverTree.load(row.q_tree)
                floor = np.frombuffer(row.floor, np.float64) if row.floor else None
                best, scored = dual_search(tree, CoverTree.load(row.c_tree), k, floor)
                keep = ~np.isneginf(best.scores)
                worst = np.where(keep.all(1), best.scores[:, -1], -np.inf)
                yield pd.DataFrame({
                    "q_block": [row.q_block], "floor": [worst.tobytes()], "scored": [scored],
                    "query_id": [np.repeat(tree.ids, keep.sum(1))], "id": [best.ids[keep]], "score": [best.scores[keep].astype(np.int64)],
                })

    def searched(which: DataFrame, name: str) -> DataFrame:
        joined = which.join(asked.select(F.col("block").alias("q_block"), F.col("tree").alias("q_tree")), "q_block")
        joined = joined.join(cands.select(F.col("block").alias("c_block"), F.col("tree").alias("c_tree")), "c_block")
        out = joined.select("q_block", "floor", "q_tree", "c_tree").mapInPandas(search, "q_block long, floor binary, scored long, query_id array<bigint>, id array<bigint>, score array<bigint>")
        return written(out, scratch(spark, f"cover-{name}"))

    def nearest(step: DataFrame) -> DataFrame:
        best = step.groupBy("q_block").agg(F.any_value("dim").alias("dim"), F.any_value("q").alias("q"), F.max(F.struct("bound", "c")).alias("m"))
        return best.select("q_block", "dim", "q", "m.c", "m.bound")

    first = written(descend(fronts, nearest).select("q_block", F.col("c.block").alias("c_block")), scratch(spark, "cover-first"))
    seeds = searched(first.withColumn("floor", F.lit(None).cast("binary")), "seeds")
    # the worst kth score of a block's queries: nodes and candidate blocks below it are out
    least = F.pandas_udf(lambda floors: floors.map(lambda f: float(np.frombuffer(f, np.float64).min())), "double")
    reach = first.join(seeds.select("q_block", "floor", least("floor").alias("least")), "q_block").withColumnRenamed("c_block", "seen")
    others = descend(fronts.join(reach, "q_block"), lambda step: step.filter("bound >= least")).filter("c.block <> seen")
    rest = searched(written(others.select("q_block", F.col("c.block").alias("c_block"), "floor"), scratch(spark, "cover-pairs")), "rest")
    found = seeds.union(rest).select(F.explode(F.arrays_zip("query_id", "id", "score")).alias("r")).select("r.*")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", F.col("id").alias(key), "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


@query("op2_cover_tree_top_k", SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
