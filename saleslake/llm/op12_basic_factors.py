"""Periodic runs by a dictionary of basic factors (operator 12).

For every length F = 1, 2, 4, ... each factor of F words gets a name that it
shares with its other occurrences in the same text; the name of a factor of
2F words is that of the pair of its halves.  The next occurrence of a factor
within 2F words is its successor; where neighbouring places have successors
at the same distance d, they form an arithmetic progression and propose the
period d.  A proposal is extended word by word to both sides, and proposals
that become the same stretch are one run, with the smallest of their periods.

Why none is lost: let a run have the smallest period q and 4 q words or more,
and F be the least power of two that is not below q.  Then F < 2 q, so every
factor of F words of the run's first 4 q - F - q + 1 > q places occurs again q
words on.  It does not occur earlier: then the run would have a smaller
period.  So all those places have successors at the distance q.

A factor that occurs once is dropped, with all that contain it, so later
lengths look at what repeats only; a text takes part while it can hold runs
of the length in question.  Words are compared by exact ids, not by hashes.

Null texts have no words (no runs, an empty collapsed text).  Rows are
independent: repeated rows give repeated results; a null key is passed on; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm.common import arrow_map, query, table
from saleslake.llm.tokens import byte_groups, byte_view
from saleslake.llm.words import Words

LEAST_WORDS = 6
EXPONENT = 4
GROUP_BYTES = 4_000_000  # texts named at a time in a worker


def proposals(ids: np.ndarray, begin: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first place, places + factor length, distance) of each progression of successors.

    ``ids``: word ids; ``begin``: first place of each text, and the end; ``text``: the text of each place.
    """
    n = np.diff(begin)
    end = begin[1:][text]  # of the place's text
    at = np.flatnonzero(n[text] >= LEAST_WORDS)
    if not len(at):
        return
    names = np.full(len(ids), -1, np.int64)
    names[at] = text[at] * (int(ids.max()) + 1) + ids[at]
    f = 1
    while len(at):
        order = np.argsort(names[at], kind="stable")
        at = at[order]  # by name, then place
        key = names[at]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        alone = new & np.concatenate([new[1:], [True]])
        far = np.diff(at)
        near = np.flatnonzero(~new[1:] & (2 * far > f) & (far <= 2 * f))
        if len(near):
            place, d = at[near], far[near]
            order = np.argsort(place)
            place, d = place[order], d[order]
            cut = np.flatnonzero((np.diff(place) != 1) | (np.diff(d) != 0)) + 1
            first, last = np.concatenate([[0], cut]), np.concatenate([cut, [len(place)]])
            long = last - first >= 2  # a run has more than q >= 1 such places
            yield from zip(place[first[long]].tolist(), (last - first + f - 1)[long].tolist(), d[first[long]].tolist())
        # factors of 2 f words: both halves occur more than once, and the text can hold a run with a period over f
        names[at] = np.where(alone, -1, np.cumsum(new) - 1)
        top = int(new.sum())
        at = at[~alone]
        at = at[(at + 2 * f <= end[at]) & (n[text[at]] >= EXPONENT * (f + 1))]
        at = at[names[at + f] >= 0]
        pairs = names[at] * top + names[at + f]
        names[:] = -1
        names[at] = pairs
        f *= 2


def extended(ids: np.ndarray, lo: int, hi: int, first: int, last: int, d: int) -> tuple[int, int]:
    """The longest [first, last) within [lo, hi) in which words ``d`` apart are equal."""
    step = 16
    while first > lo:
        m = min(step, first - lo)
        other = np.flatnonzero(ids[first - m : first] != ids[first - m + d : first + d])
        if len(other):
            first -= m - 1 - int(other[-1])
            break
        first, step = first - m, 2 * step
    step = 16
    while last < hi:
        m = min(step, hi - last)
        other = np.flatnonzero(ids[last : last + m] != ids[last - d : last - d + m])
        if len(other):
            last += int(other[0])
            break
        last, step = last + m, 2 * step
    return first, last


def runs_of(ids: np.ndarray, begin: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
    """text -> sorted (start, length, period) of its runs."""
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    found: dict[tuple[int, int], int] = {}
    covered: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for place, matched, d in proposals(ids, begin, text):
        own = int(text[place])
        done = covered.setdefault((own, d), [])
        if any(a <= place and place + matched + d <= b for a, b in done[-2:]):
            continue
        a, b = extended(ids, int(begin[own]), int(begin[own + 1]), place, place + matched + d, d)
        done.append((a, b))
        if b - a >= max(LEAST_WORDS, EXPONENT * d):
            found[a, b] = min(d, found.get((a, b), d))
    out: dict[int, list[tuple[int, int, int]]] = {}
    for (a, b), d in sorted(found.items(), key=lambda x: (x[0][0], x[1])):
        own = int(text[a])
        out.setdefault(own, []).append((a - int(begin[own]), b - a, d))
    return out


def periodic_runs(df: DataFrame, key: str = "doc_id", text: str = "text", tail: Callable[[object, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """key, n_words, runs (start, length, period; by start, then period), collapsed (the words that stay, joined by a space).

    A word goes if any run contains it after that run's first period.
    ``tail(key, n)``: (a, p) if each word i >= a of a text of n words is to be replaced by its word a + (i - a) % p.
    """
    names = ["key", "n_words", "runs", "collapsed"]
    run_type = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "period")]))

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, off = byte_view(batch.column(1))
        keys = batch.column(0)
        for lo, hi in byte_groups(off, GROUP_BYTES):
            words = Words(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            begin, source = words.before, np.arange(len(words.ids))
            changed = set()
            for i, own in enumerate(keys.slice(lo, hi - lo).to_pylist()) if tail else ():
                a0, n = int(begin[i]), int(begin[i + 1] - begin[i])
                if cut := tail(own, n):
                    a, p = cut
                    source[a0 + a : a0 + n] = a0 + a + np.arange(n - a) % p
                    changed.add(i)
            runs = runs_of(words.ids[source], begin)
            joined, at = words.joined()
            texts = []
            for i in range(hi - lo):
                a, b = int(begin[i]), int(begin[i + 1])
                if i not in changed and i not in runs:
                    texts.append(joined[at[a] : at[b] - 1] if b > a else b"")
                    continue
                keep = np.ones(b - a, bool)
                for start, length, period in runs.get(i, ()):
                    keep[start + period : start + length] = False
                own = source[a:b][keep]
                texts.append(b" ".join([joined[x:y] for x, y in zip(at[own].tolist(), (at[own + 1] - 1).tolist())]))
            rows = [[dict(zip(("start", "length", "period"), r)) for r in runs.get(i, ())] for i in range(hi - lo)]
            yield pa.record_batch([keys.slice(lo, hi - lo), pa.array(np.diff(begin)), pa.array(rows, run_type), pa.array(texts, pa.binary()).cast(pa.string())], names)

    kind = df.schema[key].dataType.simpleString()
    out = arrow_map(df.select(key, text), work, f"key {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return out.withColumnRenamed("key", key)


def planted_tail(key, n: int) -> tuple[int, int] | None:
    """The contract's periodic tail of every tenth text (none for a null key)."""
    if key is None or not n:
        return None
    h = zlib.crc32(str(key).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


@query("op12_basic_factor_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(table(spark, sf_dir, "documents"), tail=planted_tail)
    # greatest length, then smallest start, then smallest period
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
