"""Prefix trie of conversations by a splitter skeleton (operator 11).

Every conversation is a path of turns; each distinct prefix is a node.

1. Turns are placed by one distributed sort (``order.numbered``), and each
   becomes a digest of role and text and a number of bytes: no text is moved
   again.  A path is cut into segments of ``SEGMENT`` turns, so that no row
   grows with a conversation.  The trie is then one of segments: the trie of
   all paths from the turn ``SEGMENT * k`` on that share what stands before.
2. Segments are ordered by (trie, path, conversation).  Splitters between the
   shards are shortest prefixes that part neighbours of a sample (a copy that
   fills several shards is parted by the conversation).  The trie of their
   paths, the skeleton, is broadcast: one path of at most ``SEGMENT`` digests
   a shard.
3. A node with members in two shards lies on a splitter between them.  So a
   shard, sorted, finishes all its other nodes with one stack, and sends one
   partial aggregate for each skeleton node on its two edges.  Those are
   reduced by node; the skeleton's leaves and bytes are then added to their
   ancestors.  Conversations that end at a skeleton node come as blocks of
   ids, which a task hashes in order without holding them.
4. What later segments add to a subtree (bytes, distinct bytes, leaves) is
   summed by conversation beforehand: each later node counts for its smallest
   member, which is a member of every node above it.

Rows without a conv_id take no part.  A null role or text counts as empty;
turns are ordered with null first, and rows that tie by their digest.  Rows
that repeat a turn are turns of their own.  An empty table has no nodes;
other columns are not read.
"""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.llm.common import query, scratch, table, written
from saleslake.operators.order import numbered

SEGMENT = 256  # turns of a path in one row
SHARD_TURNS = 100_000  # turns for each shard
SAMPLED = 32  # rows of the sample for each splitter
MIX = 9  # rebuilt: up to MIX - 1 turns come from another conversation
BLOCK = 1 << 20  # bytes of a block of ids
WIDTH = 16  # bytes of a digest
LEAST = -(1 << 63)


# --- paths ----------------------------------------------------------------------------


def turn_rows(df: DataFrame) -> DataFrame:
    """conv, place (of all turns, in the order of conv and turn), digest, bytes."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = df.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    return numbered(rows, ["conv", "turn", "digest"], "place")


def rebuilt(df: DataFrame, mix: int = MIX, every: int = 5) -> DataFrame:
    """The contract's conversations: conv, depth (from 1; 0: the conversation as such), digest, bytes, n_turns.

    The first h turns come from conversation c - c % ``every``, the rest from c after its own first h.
    """
    turns = turn_rows(df)
    own = turns.groupBy("conv").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    # at most mix - 1 turns of a conversation are lent
    lent = turns.where(F.col("conv") % every == 0).join(own, "conv").where(F.col("place") < F.col("first") + mix - 1)
    lent = lent.groupBy(F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("place", "digest", "bytes"))).alias("lent"))
    whole = own.withColumn("base", F.col("conv") - F.col("conv") % every).withColumn("h", F.crc32(F.col("conv").cast("string")) % mix)
    whole = whole.join(lent, "base", "left").withColumn("taken", F.slice(F.coalesce("lent", F.array().cast(lent.schema["lent"].dataType)), F.lit(1), F.col("h").cast("int")))
    whole = whole.withColumn("skip", F.size("taken") - F.col("h")).withColumn("n_turns", F.size("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    whole = written(whole.select("conv", "first", "h", "taken", "skip", "n_turns"), scratch(df.sparkSession, "trie-conversations"))
    pos = F.col("place") - F.col("first") + 1
    rest = turns.join(whole.select("conv", "first", "h", "skip", "n_turns"), "conv").where(pos > F.col("h"))
    rest = rest.select("conv", (pos + F.col("skip")).alias("depth"), "digest", "bytes", "n_turns")
    head = whole.select("conv", "n_turns", F.posexplode("taken").alias("i", "t"))
    head = head.select("conv", (F.col("i") + 1).cast("long").alias("depth"), "t.digest", "t.bytes", "n_turns")
    start = whole.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("digest"), F.lit(0).cast("long").alias("bytes"), "n_turns")
    return rest.unionByName(head).unionByName(start)


def segments(paths: DataFrame, length: int) -> DataFrame:
    """The rows of the shards: one segment of ``length`` turns of one conversation each.

    conv; trie, k1, k2 (the trie: number of the segment, key of the path before); path (digests), sizes (bytes) of
    its turns; above (bytes of the turn before); n1, n2 (key of the next trie); and of what comes later: rest (bytes),
    later_bytes and later_leaves (of the nodes that count for conv).  A conversation's last segment is the first
    that is not full, an empty one if need be.
    """
    spark = paths.sparkSession
    last = F.floor(F.col("n_turns") / length)
    turns = paths.where("depth > 0").withColumn("trie", F.floor((F.col("depth") - 1) / length))
    marks = paths.where((F.col("depth") == 0) & (F.col("n_turns") % length == 0)).withColumn("trie", last)
    turn = F.when(F.col("digest").isNotNull(), F.struct("depth", "digest", "bytes"))
    rows = turns.unionByName(marks).withColumn("deep", last > 0).groupBy("conv", "trie", "deep").agg(
        F.sort_array(F.collect_list(turn)).alias("t"))  # at most ``length``
    zero = F.lit(0).cast("long")
    rows = rows.select("conv", "trie", "deep", F.unhex(F.array_join(F.col("t.digest"), "")).alias("path"), F.col("t.bytes").alias("sizes"))
    rows = written(rows, scratch(spark, "trie-segments"))
    key = (F.xxhash64("trie", "path"), F.xxhash64(F.lit(7), "trie", "path"))
    names = ["conv", "trie", "k1", "k2", "path", "sizes", "above", "rest", "later_bytes", "later_leaves"]
    single = rows.where("NOT deep").select("conv", "trie", zero.alias("k1"), zero.alias("k2"), "path", "sizes", *[zero.alias(n) for n in names[6:]])
    # conversations of more segments than one: a row for each ``length`` turns
    each = Window.partitionBy("conv").orderBy("trie")
    before, after = each.rowsBetween(Window.unboundedPreceding, -1), each.rowsBetween(1, Window.unboundedFollowing)
    deep = rows.where("deep").withColumns({"h1": key[0], "h2": key[1]}).select(
        "conv", "trie", F.coalesce(F.bit_xor("h1").over(before), zero).alias("k1"), F.coalesce(F.bit_xor("h2").over(before), zero).alias("k2"),
        "path", "sizes", F.coalesce(F.lag(F.get("sizes", F.size("sizes") - 1)).over(each), zero).alias("above"),
        F.aggregate("sizes", zero, lambda a, x: a + x).alias("total"))
    deep = written(deep, scratch(spark, "trie-deep")).join(owned(deep, length), ["conv", "trie"], "left")
    deep = deep.withColumns({"rest": F.coalesce(F.sum("total").over(after), zero), "later_bytes": F.coalesce(F.sum("own_bytes").over(after), zero),
                             "later_leaves": F.coalesce(F.sum("own_leaves").over(after), zero)})
    out = single.unionByName(deep.select(*names))
    return out.withColumns({"n1": F.col("k1").bitwiseXOR(key[0]), "n2": F.col("k2").bitwiseXOR(key[1])})


def owned(deep: DataFrame, length: int) -> DataFrame:
    """conv, trie, own_bytes, own_leaves: of the nodes of later segments whose smallest member is conv."""
    names = ["node", "trie", "conv", "bytes", "on"]
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]

    def nodes(batches):
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                path, n = r["path"], len(r["path"]) // WIDTH
                top = f"{r['trie']} {r['k1']} {r['k2']} ".encode()
                for d in range(n + 1):  # a full segment's last node goes on, into the next
                    name = hashlib.blake2b(top + path[: WIDTH * d], digest_size=16).digest()
                    out.append((name, r["trie"], r["conv"], r["sizes"][d - 1] if d else 0, d < n or n == length))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 5, kinds)], names)

    each = deep.where("trie > 0").select("trie", "k1", "k2", "path", "sizes", "conv").mapInArrow(nodes, "node binary, trie long, conv long, bytes long, on boolean")
    each = each.groupBy("node", "trie").agg(F.min("conv").alias("conv"), F.max("bytes").alias("bytes"), F.max("on").alias("on"))
    return each.groupBy("conv", "trie").agg(F.sum("bytes").alias("own_bytes"), F.count_if(~F.col("on")).alias("own_leaves"))


# --- the skeleton --------------------------------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """Digests that two paths begin with alike."""
    n = min(len(a), len(b)) // WIDTH
    if a[: WIDTH * n] == b[: WIDTH * n]:
        return n
    for d in range(n):
        if a[WIDTH * d : WIDTH * d + WIDTH] != b[WIDTH * d : WIDTH * d + WIDTH]:
            return d
    return n


class Skeleton:
    """Splitters in order, and the trie of their paths."""

    def __init__(self, sample: list[tuple], shards: int):
        """``sample``: sorted (trie, path, conv), where trie is (number, key, key); at most ``shards`` shards of about equal weight."""
        self.keys: list[tuple] = []
        self.nodes: dict[tuple, int] = {}  # (trie, path) -> number
        weights = list(accumulate(1 + len(path) // WIDTH for _, path, _ in sample))
        cuts = {bisect.bisect_left(weights, weights[-1] * s / shards) for s in range(1, shards)} if sample else set()
        for i in sorted(cuts - {0, len(sample)}):
            a, b = sample[i - 1], sample[i]
            if a[0] != b[0]:
                key = (b[0], b"", LEAST)
            elif a[1] != b[1]:
                key = (b[0], b[1][: WIDTH * (common(a[1], b[1]) + 1)], LEAST)
            else:
                key = b
            self.keys.append(key)
            for d in range(0, len(key[1]) + 1, WIDTH):
                self.nodes.setdefault((key[0], key[1][:d]), len(self.nodes))

    def shard(self, trie: tuple, path: bytes, conv: int) -> int:
        return bisect.bisect_right(self.keys, (trie, path, conv))

    def edges(self, shard: int) -> list[tuple]:
        return self.keys[max(0, shard - 1) : shard + 1]

    def whole(self, parts: dict[int, tuple], length: int) -> list[tuple]:
        """Nodes from their reduced partial aggregates: (number, trie, k1, k2, conv, depth, parent, n, kids, leaves, saved).

        The skeleton's own leaves and bytes count once for each node above them.
        """
        kids, leaves, distinct = Counter(), Counter(), Counter()
        order = sorted(self.nodes, key=lambda x: -len(x[1]))
        out = []
        for trie, path in order:
            i, up = self.nodes[trie, path], self.nodes[trie, path[:-WIDTH]] if path else None
            part, d = parts[i], len(path) // WIDTH
            kids[i] += part["kids"]
            leaves[i] += not kids[i] and d < length
            if up is not None:
                kids[up] += 1
                leaves[up] += leaves[i]
                distinct[up] += distinct[i] + part["bytes"]
            if d < length:
                saved = part["inner"] + (part["n"] - 1) * part["bytes"] - part["distinct"] - distinct[i]
                out.append((i, *trie, part["conv"], trie[0] * length + d, None if up is None else parts[up]["conv"], part["n"], kids[i], part["leaves"] + leaves[i], saved))
        return out


# --- shards ---------------------------------------------------------------------------

DONE, ROOT, LINK, PART, ENDS = "done", "root", "link", "part", "ends"
OUT = ("kind string, trie long, k1 long, k2 long, node int, above int, conv long, depth long, parent long, n long, kids long, leaves long, "
       "inner long, distinct long, bytes long, saved long, ends string, shard int, block int, ids binary")
_KINDS = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
_FIELDS = [(name, _KINDS[kind]) for name, kind in (x.split() for x in OUT.split(", "))]
_AT = {name: i for i, (name, _) in enumerate(_FIELDS)}
NOBODY = hashlib.sha256().hexdigest()


class Node:
    """A node on the stack, with sums over the members seen so far."""

    __slots__ = ("depth", "bytes", "skeleton", "conv", "n", "kids", "leaves", "inner", "distinct", "hash", "ids", "blocks", "rows", "next")

    def __init__(self, depth: int, size: int, skeleton: int | None):
        self.depth, self.bytes, self.skeleton = depth, size, skeleton
        self.conv, self.n, self.kids, self.leaves = None, 0, 0, 0
        self.inner = 0  # bytes of the members' turns below the node
        self.distinct = 0  # bytes of the nodes below it
        self.hash, self.ids, self.blocks = None, bytearray(), 0  # of the conversations that end here
        self.rows: list[int] = []  # of finished children, which lack the node's conv
        self.next: tuple | None = None


class Shard:
    """Finishes the nodes of one shard, whose segments come in order; ``out`` has the rows to send."""

    def __init__(self, number: int, skeleton: Skeleton, length: int):
        self.number, self.nodes, self.length = number, skeleton.nodes, length
        self.edges = skeleton.edges(number)
        self.trie, self.path = None, b""
        self.stack: list[Node] = []
        self.out: list[list] = []

    def put(self, kind: str, trie: tuple, **values) -> int:
        row = [None] * len(_FIELDS)
        row[:4] = kind, *trie
        for name, value in values.items():
            row[_AT[name]] = value
        self.out.append(row)
        return len(self.out) - 1

    def add(self, r: dict) -> None:
        trie, path, conv = (r["trie"], r["k1"], r["k2"]), r["path"], r["conv"]
        # nodes down to this depth lie on a splitter: others than this shard may have members
        shared = max((common(path, p) for t, p, _ in self.edges if t == trie), default=-1)
        if trie != self.trie:
            self.close()
            self.trie, self.path = trie, b""
            self.stack.append(Node(0, r["above"], self.nodes[trie, b""] if shared >= 0 else None))
        same = common(self.path, path)
        while len(self.stack) > same + 1:
            self.pop()
        for d in range(same + 1, len(path) // WIDTH + 1):
            self.stack.append(Node(d, r["sizes"][d - 1], self.nodes[trie, path[: WIDTH * d]] if d <= shared else None))
        self.path = path
        node = self.stack[-1]
        node.n += 1
        node.conv = conv if node.conv is None else min(node.conv, conv)
        if node.depth == self.length:  # goes on in the next segment
            node.next = (trie[0] + 1, r["n1"], r["n2"])
            node.inner += r["rest"]
            node.distinct += r["later_bytes"]
            node.leaves += r["later_leaves"]
        elif node.skeleton is None:
            if node.hash is None:
                node.hash = hashlib.sha256(b"%d" % conv)
            else:
                node.hash.update(b",%d" % conv)
        else:
            node.ids += b",%d" % conv
            if len(node.ids) >= BLOCK:
                self.send_ids(node)

    def send_ids(self, node: Node) -> None:
        self.put(ENDS, self.trie, node=node.skeleton, shard=self.number, block=node.blocks, ids=bytes(node.ids))
        node.ids, node.blocks = bytearray(), node.blocks + 1

    def pop(self) -> None:
        node = self.stack.pop()
        up = self.stack[-1] if self.stack else None
        full = node.depth == self.length
        at = None
        if full:  # the root of the next trie, which knows all but the parent
            at = self.put(LINK, node.next)
        if node.skeleton is not None:
            if node.ids:
                self.send_ids(node)
            self.put(PART, self.trie, node=node.skeleton, conv=node.conv, n=node.n, kids=node.kids, leaves=node.leaves,
                     inner=node.inner, distinct=node.distinct, bytes=node.bytes)
        else:
            if not node.kids and not full:
                node.leaves = 1
            for i in node.rows:
                self.out[i][_AT["parent"]] = node.conv
            if not full:
                at = self.put(
                    DONE if node.depth else ROOT, self.trie, conv=node.conv, depth=self.trie[0] * self.length + node.depth, n=node.n, kids=node.kids,
                    leaves=node.leaves, saved=node.inner + (node.n - 1) * node.bytes - node.distinct, ends=node.hash.hexdigest() if node.hash else NOBODY)
        if up is None:
            return
        if at is not None:
            if up.skeleton is None:
                up.rows.append(at)
            else:
                self.out[at][_AT["above"]] = up.skeleton
        up.n += node.n
        up.conv = node.conv if up.conv is None else min(up.conv, node.conv)
        up.inner += node.inner + node.n * node.bytes
        up.leaves += node.leaves
        up.distinct += node.distinct
        if node.skeleton is None:  # the skeleton's own nodes count once, in ``whole``
            up.kids += 1
            up.distinct += node.bytes

    def close(self) -> None:
        while self.stack:
            self.pop()

    def ready(self) -> bool:
        """Nothing on the stack waits to give its rows a parent."""
        return len(self.out) >= 20_000 and all(x.skeleton is not None for x in self.stack)

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.out)) or [()] * len(_FIELDS)
        self.out = []
        return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(cols, _FIELDS)], [n for n, _ in _FIELDS])


def finish(batches: Iterator[pa.RecordBatch], skeleton: Skeleton, length: int) -> Iterator[pa.RecordBatch]:
    """Segments sorted by (shard, trie, path, conv) to rows of OUT."""
    shard: Shard | None = None
    for batch in batches:
        for r in batch.to_pylist():
            if shard is None or shard.number != r["shard"]:
                if shard is not None:
                    shard.close()
                    yield shard.batch()
                shard = Shard(r["shard"], skeleton, length)
            shard.add(r)
            if shard.ready():
                yield shard.batch()
    if shard is not None:
        shard.close()
        yield shard.batch()


def hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ids (each id after a comma), sorted by (node, shard, block), to one digest for each node."""
    node, state = None, None
    done = lambda: pa.record_batch([pa.array([node], pa.int32()), pa.array([state.hexdigest()])], ["node", "ends"])
    for batch in batches:
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids")):
            ids = ids.as_py()
            if key != node:
                if node is not None:
                    yield done()
                node, state, ids = key, hashlib.sha256(), ids[1:]
            state.update(ids)
    if node is not None:
        yield done()


def trie_nodes(paths: DataFrame, segment: int = SEGMENT, shards: int | None = None) -> DataFrame:
    """One row for each node of the trie of ``paths`` (conv, depth, digest, bytes, n_turns; see ``rebuilt``)."""
    spark = paths.sparkSession
    segs = segments(paths, segment)
    n, turns = segs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("sizes")), F.lit(0))).first()
    if shards is None:
        shards = max(-(-(n + turns) // SHARD_TURNS), min(n // 8, int(spark.conf.get("spark.sql.shuffle.partitions"))), 1)
    kept = min(1 << 20, -(-(SAMPLED * shards << 20) // max(n, 1)))
    some = segs.where(F.pmod(F.xxhash64(F.lit(11), "conv", "trie"), F.lit(1 << 20)) < kept)  # about SAMPLED for each shard
    sample = sorted(((r.trie, r.k1, r.k2), bytes(r.path), r.conv) for r in some.select("trie", "k1", "k2", "path", "conv").collect())
    skeleton = Skeleton(sample, shards)
    shared = spark.sparkContext.broadcast(skeleton)

    def route(batches):
        for batch in batches:
            where = [shared.value.shard(t, p, c) for t, p, c in zip(
                zip(*(batch.column(k).to_pylist() for k in ("trie", "k1", "k2"))), batch.column("path").to_pylist(), batch.column("conv").to_pylist())]
            yield batch.append_column("shard", pa.array(where, pa.int32()))

    schema = T.StructType([*segs.schema.fields, T.StructField("shard", T.IntegerType())])
    dealt = segs.mapInArrow(route, schema).repartitionById(len(skeleton.keys) + 1, "shard").sortWithinPartitions("shard", "trie", "k1", "k2", "path", "conv")
    rows = written(dealt.mapInArrow(lambda batches: finish(batches, shared.value, segment), OUT), scratch(spark, "trie-rows"))

    # the skeleton: as many nodes as the broadcast trie
    sums = [F.sum(c).alias(c) for c in ("n", "kids", "leaves", "inner", "distinct")]
    parts = rows.where(F.col("kind") == PART).groupBy("node").agg(F.min("conv").alias("conv"), F.max("bytes").alias("bytes"), *sums)
    whole = skeleton.whole({r.node: r for r in parts.collect()}, segment)
    names = "trie long, k1 long, k2 long, conv long, depth long, parent long, n long, kids long, leaves long, saved long"
    whole = spark.createDataFrame(whole, "node int, " + names)
    blocks = rows.where(F.col("kind") == ENDS).select("node", "shard", "block", "ids")
    ends = blocks.repartition("node").sortWithinPartitions("node", "shard", "block").mapInArrow(hashed_ends, "node int, ends string")
    own = whole.join(ends, "node", "left").withColumn("ends", F.coalesce("ends", F.lit(NOBODY)))
    above = F.broadcast(parts.select(F.col("node").alias("above"), F.col("conv").alias("above_conv")))
    cols = [x.split()[0] for x in names.split(", ")] + ["ends"]

    def parented(kind: str) -> DataFrame:
        some = rows.where(F.col("kind") == kind).join(above, "above", "left")
        return some.withColumn("parent", F.coalesce("parent", "above_conv")).select(*cols)

    roots = rows.where(F.col("kind") == ROOT).select(*cols).unionByName(own.where(F.col("parent").isNull()).select(*cols))
    links = parented(LINK).groupBy("trie", "k1", "k2").agg(F.max("parent").alias("parent"))  # a link from each shard of a skeleton node
    roots = roots.drop("parent").join(links, ["trie", "k1", "k2"], "left").select(*cols)
    out = parented(DONE).unionByName(own.where(F.col("parent").isNotNull()).select(*cols)).unionByName(roots)
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))


@query("op11_splitter_trie")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(rebuilt(table(spark, sf_dir, "conversations")))
