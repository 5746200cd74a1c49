"""SimHash near-dedup by tiled exact comparison (operator 5).

1. Fingerprints: words of the ASCII-lower-cased text, shingles of ``SHINGLE``
   words, XXH64 (seed 42) of each; a bit is set if over half of the hashes
   have it.  Texts of fewer words hash the whole sequence; without words the
   fingerprint is zero, and linked like any other.
2. Distinct fingerprints are range partitioned by the population counts of
   their four 16-bit quarters and cut, in that order, into ranges of up to
   about a million.  Two fingerprints differ in at least as many bits as the
   sum of the differences of those counts, so pairs of ranges (and, within
   them, of tiles of 256) whose count boxes are further apart than the radius
   are skipped; all others are compared exactly by exclusive-or and bit counts
   in numpy.  The pairs of ranges are the cells of a grid: with g ranges each
   fingerprint is sent to at most g cells, and a cell is one group of a
   shuffle.  It returns only a spanning forest of its links, so a group of
   near copies gives about a row for each member and cell.
3. Components: alternating large-star and small-star joins until nothing
   changes; every round is written to the shared folder.  The neighbours of a
   hub are spread over ``SALTS`` tasks.

The number of compared pairs grows with the square of the distinct
fingerprints, as any exact comparison; the boxes keep its constant small.

Null texts count as empty.  Null keys take part; the component id ignores
them (null if a component has no other).  Repeated rows share a fingerprint
and so a component; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm.common import arrow_map, query, scratch, table, written
from saleslake.llm.tokens import IS_SPACE, byte_groups, byte_view

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 16_384
SUB_TILE = 256
RANGES = 16  # of fingerprints, at least; their pairs are the cells that are compared
RANGE_TILES = 64  # tiles in a range, at most
TASKS = 20_000  # for the cells, at most
SALTS = 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# _SPREAD[h][b]: bits 4h to 4h+3 of byte b, each in a 16-bit lane
_SPREAD = np.array([[sum(((b >> (4 * h + i)) & 1) << (16 * i) for i in range(4)) for b in range(256)] for h in (0, 1)], np.uint64)
_LANE = 65_535


def word_places(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end bytes of all words, and the number of words before each text."""
    space = IS_SPACE[raw]
    first = ~space
    first[1:] &= space[:-1]
    starts = off[:-1][off[:-1] < len(raw)]
    first[starts] = ~space[starts]
    last = ~space
    last[:-1] &= space[1:]
    ends = off[1:][off[1:] > 0] - 1
    last[ends] = ~space[ends]
    begins = np.flatnonzero(first)
    return begins, np.flatnonzero(last) + 1, np.searchsorted(begins, off)


def bit_sums(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each run bounds[i]:bounds[i+1] (none empty) of hashes, how many have each of the 64 bits."""
    cuts = [np.arange(a, b, _LANE) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    firsts, owner = np.concatenate(cuts), np.repeat(np.arange(len(cuts)), [len(c) for c in cuts])
    by_byte = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    out = np.zeros((len(cuts), 64), np.int64)
    for byte in range(8):
        for half in (0, 1):
            lanes = np.add.reduceat(_SPREAD[half][by_byte[:, byte]], firsts)
            np.add.at(out[:, 8 * byte + 4 * half : 8 * byte + 4 * half + 4], owner, lanes.astype("<u8").view("<u2").reshape(-1, 4).astype(np.int64))
    return out


def fingerprints_of(raw: np.ndarray, off: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each text."""
    begins, ends, before = word_places(raw, off)
    n_texts, out = len(off) - 1, np.zeros(len(off) - 1, np.uint64)
    if not len(begins):
        return out
    # all words with one space between them
    low, gap = _LOWER[raw], np.append(begins[1:] - ends[:-1], 1)
    keep = ~IS_SPACE[raw]
    keep[ends[:-1][gap[:-1] > 0]] = True
    low[IS_SPACE[raw]] = 32
    joined = low[keep].tobytes()
    at = np.concatenate([[0], np.cumsum(keep)])
    begins, ends = at[begins], at[ends]
    words = np.diff(before)
    width = np.minimum(words, shingle)  # words of a shingle, by text
    count = np.where(words > 0, words - width + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(count)])
    own = np.repeat(np.arange(n_texts), count)
    first = np.arange(bounds[-1]) - bounds[own] + before[own]
    a, b = begins[first].tolist(), ends[first + width[own] - 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[x:y], SEED) for x, y in zip(a, b)), np.uint64, len(a))
    full = np.flatnonzero(count)
    sums = bit_sums(hashes, np.append(bounds[:-1][full], bounds[-1]))
    bits = 2 * sums > count[full][:, None]
    out[full] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return out


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """key, fp (long with the fingerprint's bits) of every row."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, off = byte_view(batch.column(1))
        for lo, hi in byte_groups(off, 4_000_000):
            fp = fingerprints_of(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], shingle)
            yield pa.record_batch([batch.column(0).slice(lo, hi - lo), pa.array(fp.view(np.int64))], ["key", "fp"])

    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return arrow_map(rows, run, f"key {df.schema[key].dataType.simpleString()}, fp long")


def quarter_counts(fp: np.ndarray) -> np.ndarray:
    return np.bitwise_count(fp.view("<u2").reshape(-1, 4)).astype(np.int16)


class Forest:
    """Union-find over positions; the smallest position is the root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def roots(self, at: np.ndarray) -> np.ndarray:
        r = self.parent[at]
        while True:
            up = self.parent[r]
            if np.array_equal(up, r):
                self.parent[at] = r
                return r
            r = up

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            if not apart.any():
                return
            low, high = np.minimum(ra, rb)[apart], np.maximum(ra, rb)[apart]
            np.minimum.at(self.parent, high, low)


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS, sub: int = SUB_TILE) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (fingerprint, smaller root) of the links within a tile, or between two tiles."""
    fp = left if right is None else np.concatenate([left, right])
    forest = Forest(len(fp))
    rows = range(0, len(left), sub)
    cols = rows if right is None else range(len(left), len(fp), sub)
    ends = lambda lo: min(lo + sub, len(left) if lo < len(left) else len(fp))
    counts = quarter_counts(fp)
    boxes = {lo: (counts[lo : ends(lo)].min(0), counts[lo : ends(lo)].max(0)) for lo in {*rows, *cols}}
    low, high = (np.array([boxes[lo][k] for lo in cols]) for k in (0, 1))
    for a in rows:
        own_low, own_high = boxes[a]
        gaps = np.maximum(0, np.maximum(low - own_high, own_low - high)).sum(1)
        for b in np.array(cols)[gaps <= radius].tolist():
            if right is None and b < a:
                continue
            near = np.bitwise_count(fp[a : ends(a), None] ^ fp[None, b : ends(b)]) <= radius
            if near.any():
                i, j = np.nonzero(near)
                forest.join(i + a, j + b)
    at = np.arange(len(fp))
    root = forest.roots(at)
    moved = root != at
    return fp[moved], fp[root[moved]]


def links(distinct: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b): edges that connect just the distinct fingerprints (column fp) within ``radius`` bits."""
    spark = distinct.sparkSession
    n_parts = max(RANGES, -(-distinct.count() // tile))
    n_ranges = max(RANGES, -(-n_parts // RANGE_TILES))
    quarters = [F.bit_count(F.shiftrightunsigned("fp", 48 - 16 * q).bitwiseAND(F.lit(65535))) for q in range(4)]

    def tiles(batches):
        held: list[np.ndarray] = []
        number = TaskContext.get().partitionId() * n_ranges // n_parts

        def row(fp: np.ndarray) -> pa.RecordBatch:
            counts = quarter_counts(fp)
            return pa.record_batch([pa.array([number], pa.int32()), pa.array([counts.min(0).tolist()], pa.list_(pa.int32())), pa.array([counts.max(0).tolist()], pa.list_(pa.int32())), pa.array([fp.tobytes()], pa.binary())], ["range", "low", "high", "fps"])

        for b in batches:
            held.append(np.asarray(b.column(0)).view(np.uint64))
            if sum(map(len, held)) >= 2 * tile:
                own = np.concatenate(held)
                yield row(own[:tile])
                held = [own[tile:]]
        if held and sum(map(len, held)):
            yield row(np.concatenate(held))

    parts = distinct.repartitionByRange(n_parts, *quarters, "fp").sortWithinPartitions(*quarters, "fp")
    tiled = written(parts.select("fp").mapInArrow(tiles, "range int, low array<int>, high array<int>, fps binary"), scratch(spark, "simhash-tiles"))

    # the cells whose boxes are near enough: a row for each pair of ranges, not of tiles
    edge = lambda fn, name: F.array(*[fn(F.col(name)[q]) for q in range(4)])
    boxes = tiled.groupBy("range").agg(edge(F.min, "low").alias("low"), edge(F.max, "high").alias("high"))
    one = boxes.select(F.col("range").alias("one"), "low", "high", F.explode(F.sequence("range", F.lit(n_ranges - 1))).alias("two"))
    other = boxes.select(F.col("range").alias("two"), F.col("low").alias("low2"), F.col("high").alias("high2"))
    gap = F.expr("aggregate(zip_with(arrays_zip(low, high), arrays_zip(low2, high2), (x, y) -> greatest(0, x.low - y.high2, y.low2 - x.high)), 0, (s, d) -> s + d)")
    cells = written(one.join(other, "two").filter(gap <= radius).select("one", "two"), scratch(spark, "simhash-cells"))

    payload = tiled.select("range", "fps")
    left = payload.join(cells, F.col("range") == F.col("one")).select("one", "two", F.lit(False).alias("right"), "fps")
    right = payload.join(cells.filter("one <> two"), F.col("range") == F.col("two")).select("one", "two", F.lit(True).alias("right"), "fps")

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        fps = [np.sort(np.concatenate([np.frombuffer(f, np.uint64) for f in cell["fps"][cell["right"] == side]] or [np.empty(0, np.uint64)])) for side in (False, True)]
        fps = [f[np.lexsort(quarter_counts(f).T[::-1])] for f in fps]  # in the order of the counts, so that tiles have small boxes
        a, b = tile_links(fps[0], fps[1] if len(fps[1]) else None, radius)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    # a number of tasks of its own: little data, much work
    dealt = left.union(right).repartition(min(TASKS, n_ranges * (n_ranges + 1) // 2), "one", "two")
    return dealt.groupBy("one", "two").applyInPandas(compare, "a long, b long")


def _by_hub(rows: DataFrame, spread: str, hubs: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``hubs`` (one row a key): a key's rows go to ``SALTS`` tasks by ``spread``."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    return salted.join(hubs.select("*", salts), [key, "_salt"], how).drop("_salt")


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each node of ``edges`` (a, b) but the smallest of its component, with that smallest."""
    spark = edges.sparkSession
    state = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    edges = written(edges, scratch(spark, "components"))
    before = state(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _by_hub(both, "b", least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _by_hub(large, "b", least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        edges = written(small.union(least.select("a", F.col("m").alias("b"))).distinct(), scratch(spark, "components"))
        now = state(edges)
        if now == before:
            break
        before = now
    return edges


def near_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """key, fingerprint (16 hex digits), component_id (the smallest key reachable) of every row."""
    spark = df.sparkSession
    rows = written(fingerprints(df, key, text, shingle), scratch(spark, "simhash"))
    distinct = written(rows.groupBy("fp").agg(F.min("key").alias("first_key")), scratch(spark, "simhash-distinct"))
    roots = components(links(distinct.select("fp"), radius, tile)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    member = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # of one fingerprint alone, the component is its own
    ids = member.groupBy("root").agg(F.min("first_key").alias("component_id"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    of_fp = _by_hub(member, "fp", ids, "root", "left").select("fp", F.coalesce("component_id", "first_key").alias("component_id"))
    return rows.join(of_fp, "fp").select(F.col("key").alias(key), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op5_simhash_tiles")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(table(spark, sf_dir, "documents"))
