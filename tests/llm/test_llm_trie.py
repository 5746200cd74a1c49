"""Operator 11: against a brute-force trie, with small segments and many shards."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from saleslake.llm import op11_splitter_trie as trie

from tests.conftest import SF_SMALL

COLUMNS = "conv_id long, turn long, role string, text string, place string, depth string, n string"


def brute(rows):
    """(conv, depth) -> the contract's columns, from whole paths."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.md5(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, digest), (role or "", text or "")))
    own = {c: [t for _, t in sorted(x)] for c, x in own.items()}
    paths = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        paths[c] = tuple(own.get(c - c % 5, [])[:h] + x[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
        ends[paths[c]].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p in members:
        gain = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += gain
            leaves[p[:d]] += not kids[p]
    out = []
    for p, who in members.items():
        text = ",".join(map(str, ends[p]))
        out.append((who[0], len(p), members[p[:-1]][0] if p else None, len(who), kids[p], leaves[p], saved[p], hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, df, **how):
    rows = trie.trie_nodes(trie.rebuilt(df), **how)
    assert rows.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, rows.collect()), key=str)


def conversations():
    rng = random.Random(11)
    turns = [(rng.choice(["user", "assistant", None]), rng.choice(["", "é", "hello", "a longer text", None, "x" * 300])) for _ in range(5)]
    rows = []
    for conv in range(70):
        for turn in range(rng.randrange(1, 14)):
            role, text = turns[rng.randrange(2 if turn < 3 else 5)]
            rows.append((conv, turn if rng.random() < 0.9 else None, role, text))
    rows += [(c, t, "user", "the same") for c in range(100, 160) for t in range(4)]  # copies over several shards
    rows += [(200, t, "user", f"turn {t}") for t in range(90)]  # one long one,
    rows += [(201, t, "user", f"turn {t}" if t < 70 else "elsewhere") for t in range(80)]  # and two that leave it
    rows += [(202, t, "user", f"turn {t}") for t in range(88)]
    rows += [(300, 1, "a", "tie"), (300, 1, "a", "tie"), (300, 1, "b", "tie"), (300, None, "c", None)]
    rows += [(None, 0, "user", "no conversation"), (7, 3, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("segment, shards", [(256, None), (256, 1), (3, 40), (1, 9), (4, 400)])
def test_against_brute_force(spark, segment, shards):
    rows = conversations()
    df = spark.createDataFrame([(*r, "p", "d", "n") for r in rows], COLUMNS).repartition(5)
    assert got(spark, df, segment=segment, shards=shards) == brute(rows)


def test_given_table(spark):
    df = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    want = brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
    from saleslake.llm.queries import QUERIES

    assert sorted(map(tuple, QUERIES["op11_splitter_trie"](spark, SF_SMALL).collect()), key=str) == want


def test_turnless_and_empty(spark):
    assert got(spark, spark.createDataFrame([], COLUMNS)) == []
    # crc32("8") % 9 turns come from conversation 5, which isn't there: a conversation without turns
    c = next(c for c in range(1000) if c % 5 and zlib.crc32(str(c).encode()) % 9)
    rows = [(c, 0, "user", "taken away")]
    assert got(spark, spark.createDataFrame([(*r, "", "", "") for r in rows], COLUMNS)) == brute(rows) == [
        (c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_skeleton_covers_every_split_node():
    rng = random.Random(2)
    paths = sorted(((0, 0, 0), b"".join(rng.choice(b"ab").to_bytes(1, "big") * 16 for _ in range(rng.randrange(6))), c) for c in range(300))
    own = trie.Skeleton(paths, 25)
    shards = defaultdict(set)
    for t, p, c in paths:
        for d in range(0, len(p) + 1, 16):
            shards[t, p[:d]].add(own.shard(t, p, c))
    assert len(own.keys) > 15
    assert all(node in own.nodes for node, at in shards.items() if len(at) > 1)
    assert all(node in shards for node in own.nodes)
