"""Operator 12: against a brute-force search for runs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from saleslake.llm import op12_basic_factors as factors
from saleslake.llm.queries import QUERIES

from tests.conftest import SF_SMALL
from tests.llm.conftest import odd_rows

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(words):
    """All (start, length, period)."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(6, 4 * q):
                own = words[i : i + length]
                if not any(own[p:] == own[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(key, text):
    words = WORD.findall(text or "")
    n = len(words)
    if key is not None and n and zlib.crc32(str(key).encode()) % 10 == 0:
        g = zlib.crc32(str(key).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    drop = {i for s, l, q in runs for i in range(s + q, s + l)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (key, len(runs), *four, sha("".join(f"{s},{l},{q}\n" for s, l, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


@pytest.mark.parametrize("seed", range(40))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(25):
        words = []
        while len(words) < rng.choice((3, 20, 90)):
            period = [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(rng.choice((1, 2, 3, 4, 5, 7, 8, 9, 16, 17)))]
            words += (period * rng.randrange(1, 8))[: rng.randrange(1, 70)]
        texts.append(words)
    begin = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = factors.runs_of(np.array(sum(texts, []), np.int64), begin)
    assert {i: r for i, t in enumerate(texts) if (r := brute(t))} == got


def test_long_runs():
    for words in ([0] * 50_000, [0, 1] * 30_000, list(range(5_000)) * 4, list(range(5_001)) * 3 + list(range(5_000)), [0, 0, 1] * 9_999 + [7] + [0, 0, 1] * 50):
        n = len(words)
        got = factors.runs_of(np.array(words), np.array([0, n]))
        for start, length, period in got.get(0, ()):
            assert words[start : start + length - period] == words[start + period : start + length] and length >= 4 * period
        best = max(got.get(0, [(0, 0, 0)]), key=lambda r: r[1])
        assert best == {50_000: (0, 50_000, 1), 60_000: (0, 60_000, 2), 20_000: (0, 20_000, 5_000), 20_003: (0, 0, 0), 30_148: (0, 29_997, 3)}[n]


def test_query(spark):
    got = QUERIES["op12_basic_factor_runs"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(expected(*r) for r in rows)
    assert sum(w[1] > 0 for w in want) > 10
    assert sorted(map(tuple, got.collect())) == want


def test_odd_rows(spark, odd, none):
    planted = lambda d: factors.periodic_runs(d, tail=factors.planted_tail)
    got = planted(odd).collect()
    few = lambda t: t is None or len(t) < 60_000
    want = sorted((expected(*r)[1:] for r in odd_rows() if few(r[1])), key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    mine = []
    for r in got:
        runs = [tuple(x) for x in r.runs]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=None)
        four = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        mine.append((len(runs), *four, sha("".join("%d,%d,%d\n" % x for x in runs)), sha(r.collapsed)))
    assert len(mine) == len(odd_rows())
    assert all(mine.count(w) >= want.count(w) for w in want)
    assert planted(none).collect() == []
