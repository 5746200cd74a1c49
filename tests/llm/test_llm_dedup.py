"""Operators 3, 5 and 8 against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from saleslake.llm import op05_simhash_tiles as simhash
from saleslake.llm.op03_difference_cover import COVER, PERIOD, is_cover, remove_repeats
from saleslake.llm.op08_grace_dedup import ContentTable, exact_dedup, grace, order

from tests.llm.conftest import odd_rows

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def repeats(texts, window):
    words = [WORDS.findall((t or "").encode()) for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        out.append((len(w), sum(gone), hashlib.sha256(b" ".join(a for a, g in zip(w, gone) if not g)).hexdigest()))
    return out


def test_cover():
    assert is_cover(PERIOD, COVER) and not is_cover(PERIOD, COVER[:-1])


@pytest.mark.parametrize("window,period,cover", [(35, 21, COVER), (5, 3, (0, 1))])
def test_substring_dedup(odd, none, window, period, cover):
    rows = odd_rows()
    want = Counter((i, *r) for (i, _), r in zip(rows, repeats([t for _, t in rows], window)))
    got = remove_repeats(odd, window=window, period=period, cover=cover, chunk_bytes=20_000, bucket_bytes=30_000)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert remove_repeats(none).count() == 0


def test_substring_dedup_text(spark):
    rng = random.Random(1)
    shared = [str(rng.random()) for _ in range(40)]
    docs = [(k, " ".join([f"{k}a{i}" for i in range(k)] + shared + [f"{k}b"])) for k in range(30)]
    got = remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), with_text=True, chunk_bytes=2000, bucket_bytes=3000).collect()
    assert {r.doc_id: r.kept_text for r in got} == {k: " ".join([f"{k}a{i}" for i in range(k)] + [f"{k}b"]) for k, _ in docs}


def fingerprint(text):
    words = WORDS.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))


def groups(fps, radius=4):
    fps = np.array(fps, np.uint64)
    near = np.bitwise_count(fps[:, None] ^ fps[None]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return label
        label = new


def test_simhash(odd, none):
    rows = odd_rows()
    fps = [fingerprint(t) for _, t in rows]
    label = groups(fps)
    ids = defaultdict(list)
    for (i, _), g in zip(rows, label):
        if i is not None:
            ids[g].append(i)
    want = Counter((i, format(fp, "016x"), min(ids[g], default=None)) for (i, _), fp, g in zip(rows, fps, label))
    assert Counter(tuple(r) for r in simhash.near_dedup(odd, tile=4).collect()) == want
    assert simhash.near_dedup(none).count() == 0


def test_links_over_tiles(spark):
    rng = np.random.default_rng(0)
    base = rng.integers(0, 1 << 64, 150, dtype=np.uint64)
    chain = [int(base[0])]
    for _ in range(60):  # a long chain, each four bits from the last
        chain.append(chain[-1] ^ sum(1 << int(b) for b in rng.choice(64, 4, replace=False)))
    dense = [int(base[1]) ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)]  # all near each other
    fps = np.unique(np.concatenate([base, base[:50] ^ np.uint64(0xF0), np.array(chain, np.uint64), np.array(dense, np.uint64)]))
    df = spark.createDataFrame(pd.DataFrame({"fp": fps.view(np.int64)}))
    edges = simhash.links(df, tile=64)
    assert edges.count() < 8 * len(fps)
    root = {r.a: r.b for r in simhash.components(edges).collect()}
    got, want = defaultdict(set), defaultdict(set)
    for fp, g in zip(fps.view(np.int64).tolist(), groups(fps)):
        got[root.get(fp, fp)].add(fp)
        want[g].add(fp)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_exact_dedup(odd, none):
    rows = odd_rows()
    text = lambda t: re.sub(rb"[\x20\x09-\x0D]+", b" ", (t or "").encode())
    by_text = defaultdict(list)
    for i, t in rows:
        by_text[text(t)].append(i)
    first = lambda t: min((i for i in by_text[text(t)] if i is not None), default=None)
    want = Counter((i, first(t), len(by_text[text(t)]), hashlib.sha256(text(t)).hexdigest()) for i, t in rows)
    got = exact_dedup(odd).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(by_text)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    assert exact_dedup(none).count() == 0


def test_grace_recursion():
    rng = random.Random(2)
    contents = [b"%d" % i * rng.randrange(1, 60) for i in range(3000)]
    picks = [rng.choice(contents) for _ in range(9000)] + [contents[0]] * 3000
    records = [(hash(c) % 7, c, u, order(None if u % 50 == 0 else u // 2, u), 2) for u, c in enumerate(picks)]  # few hashes: many collisions
    want = defaultdict(list)
    for u, c in enumerate(picks):
        want[c].append(u)
    got = {tuple(sorted(carriers)): (first, n) for carriers, first, n in grace(records, limit=30_000)}
    assert got == {tuple(us): (min(order(None if u % 50 == 0 else u // 2, u) for u in us), 2 * len(us)) for us in want.values()}


def test_grace_spills_negative_hashes():
    """Hashes are signed longs; a full table sends records of either sign to its spill files."""
    records = [((-1) ** u * (u // 2 + 1) * 2**40 if u > 1 else (-(2**63), 2**63 - 1)[u], b"%d" % u * 20, u, order(u, u), 1) for u in range(400)]
    got = sorted((carriers.tolist(), first, n) for carriers, first, n in grace(records + [(*r[:2], r[2] + 1000, order(r[2] + 1000, r[2] + 1000), 1) for r in records], limit=2_000))
    assert got == [([u, u + 1000], order(u, u), 2) for u in range(400)]


def test_exact_with_full_tables(spark, odd):
    """With a table that holds one text at a time, the groups are those of one that holds all."""
    cols = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    rows = lambda **how: sorted(map(repr, exact_dedup(odd, **how).select(*cols).collect()))
    assert rows(table_bytes=1) == rows()


def test_content_table_compares_contents():
    t = ContentTable()
    assert [t.find(5, c) for c in (b"a", b"b", b"a")] == [0, 1, 0]
    assert t.find(5, b"c", add=False) == -1
