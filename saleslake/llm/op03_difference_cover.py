"""Substring dedup by difference-cover anchors (operator 3).

Every window of ``WINDOW`` words that also starts elsewhere is removed from
wherever it stands.  A difference cover D of the period v holds, for every
shift, two members that far apart (mod v).  So two equal windows at i and j
have a common d < v with i + d and j + d both at cover positions, and share
the aligned anchor of WINDOW - v + 1 words that starts there.  Hence:

1. Texts are written once as chunks (compressed, numbered), so that later
   passes see the same rows.
2. Anchors at cover positions only (5 of 21) are hashed; a chunk sends its
   distinct hashes, packed by hash range, to buckets, which answer with one
   bit each: does it occur elsewhere?
3. Around the anchors that do, every window that contains one is extended to
   its whole length and hashed to 96 bits, and the buckets answer again.
4. The words under windows that occur elsewhere are removed.

A passage that a third of all documents share is one hash per chunk, so no
bucket grows with it.  The number of buckets follows the bytes of text.  Equal
96-bit hashes count as equal words (two independent polynomials over mixed
word hashes; at 10^13 windows the chance of one false match is below 0.1 %).

Null texts have no words.  Windows are judged on the input, repeated rows are
further places.  Null keys pass through; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from saleslake.llm.common import query, scratch, table, written
from saleslake.llm.op05_simhash_tiles import word_places
from saleslake.llm.tokens import byte_groups, byte_view

WINDOW = 35
PERIOD = 21
COVER = (0, 1, 4, 14, 16)
CHUNK_BYTES = 4_000_000
BUCKET_BYTES = 16_000_000  # text bytes for each bucket

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_POWERS: dict[int, np.ndarray] = {}


def is_cover(period: int, cover: tuple[int, ...]) -> bool:
    return {(a - b) % period for a in cover for b in cover} == set(range(period))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64 (kept for the process)."""
    own = _POWERS.get(int(base))
    if own is None or len(own) < n:
        own = np.full(max(n, 1 << 16), base, np.uint64)
        own[0] = 1
        own = np.multiply.accumulate(own)
        if n <= 1 << 22:
            _POWERS[int(base)] = own
    return own[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(raw: np.ndarray, begins: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """A 64-bit hash of each word's bytes."""
    if not len(begins):
        return np.empty(0, np.uint64)
    size = ends - begins
    firsts = np.cumsum(size) - size
    within = np.arange(int(size.sum())) - np.repeat(firsts, size)
    value = raw[within + np.repeat(begins, size)].astype(np.uint64) + np.uint64(1)
    return mix(np.add.reduceat(value * powers(base, int(size.max()))[within], firsts) + size.astype(np.uint64) * base)


def window_hashes(words: np.ndarray, at: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """A 64-bit hash of words[i : i + length] for each i in ``at``."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(base, len(words)), dtype=np.uint64)])
    return mix((sums[at + length] - sums[at]) * powers(inverse, len(words))[at])


class Chunk:
    """The words of some texts, and the keys of their rows."""

    def __init__(self, payload: bytes):
        batch = pa.ipc.open_stream(pa.CompressedInputStream(pa.BufferReader(payload), "zstd")).read_next_batch()
        self.keys = batch.column(0)
        self.raw, self.off = byte_view(batch.column(1))
        self.begins, self.ends, self.before = word_places(self.raw, self.off)
        n = np.diff(self.before)
        self.place = np.arange(len(self.begins)) - np.repeat(self.before[:-1], n)  # of a word in its text
        self.left = np.repeat(self.before[1:], n) - np.arange(len(self.begins))  # words from it to its text's end
        self.words = word_hashes(self.raw, self.begins, self.ends, _BASES[0])

    @staticmethod
    def pack(keys: pa.Array, texts: pa.Array) -> bytes:
        batch = pa.record_batch([keys, texts], ["key", "text"])
        sink = pa.BufferOutputStream()
        with pa.CompressedOutputStream(sink, "zstd") as out, pa.ipc.new_stream(out, batch.schema) as stream:
            stream.write_batch(batch)
        return sink.getvalue().to_pybytes()


class Asked:
    """Distinct hashes of a chunk in order, each with whether the chunk has it more than once."""

    def __init__(self, high: np.ndarray, low: np.ndarray | None, buckets: int):
        order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
        high, low = high[order], None if low is None else low[order]
        new = np.ones(len(high), bool)
        new[1:] = high[1:] != high[:-1]
        if low is not None:
            new[1:] |= low[1:] != low[:-1]
        firsts = np.flatnonzero(new)
        self.rank = np.empty(len(high), np.int64)  # of each hash asked, in the distinct list
        self.rank[order] = np.cumsum(new) - 1
        self.high, self.low = high[firsts], None if low is None else low[firsts]
        self.many = np.diff(np.append(firsts, len(high))) > 1
        # the buckets that are asked, and where the hashes of each begin
        bucket = self.high // np.uint64(-(-(1 << 64) // buckets)) if buckets > 1 else np.zeros(len(firsts), np.uint64)
        first = np.ones(len(bucket), bool)
        first[1:] = bucket[1:] != bucket[:-1]
        self.bounds = np.append(np.flatnonzero(first), len(firsts))
        self.buckets = bucket[first].astype(np.int64)

    def rows(self, chunk: int) -> pa.RecordBatch:
        """One row for each bucket that is asked: bucket, chunk, hashes, many."""
        out = list(zip(self.buckets.tolist(), self.bounds[:-1].tolist(), self.bounds[1:].tolist()))
        packed = lambda lo, hi: self.high[lo:hi].astype("<u8").tobytes() + (b"" if self.low is None else self.low[lo:hi].astype("<u4").tobytes())
        return pa.record_batch([
            pa.array([b for b, _, _ in out], pa.int64()), pa.array([chunk] * len(out), pa.int64()), pa.array([hi - lo for _, lo, hi in out], pa.int64()),
            pa.array([packed(lo, hi) for _, lo, hi in out], pa.binary()), pa.array([np.packbits(self.many[lo:hi]).tobytes() for _, lo, hi in out], pa.binary()),
        ], ["bucket", "chunk", "n", "hashes", "many"])

    def answered(self, answers) -> np.ndarray:
        """Of each hash asked: does it occur elsewhere (the buckets' answers: (bucket, bits))?"""
        yes = np.zeros(len(self.high), bool)
        answers = answers if answers is not None else ()
        places = np.searchsorted(self.buckets, [a["bucket"] for a in answers]).tolist()
        for a, at in zip(answers, places):
            lo, hi = self.bounds[at], self.bounds[at + 1]
            yes[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], np.uint8), count=hi - lo).astype(bool)
        return yes[self.rank]


ASKED = "bucket long, chunk long, n long, hashes binary, many binary"


def answer(p: pd.DataFrame) -> pd.DataFrame:
    """For all rows of a bucket: which of their hashes occur more than once in the corpus."""
    n = p["n"].to_numpy()
    high = np.concatenate([np.frombuffer(h, "<u8", k) for h, k in zip(p["hashes"], n)])
    low = np.concatenate([np.frombuffer(h, "<u4", offset=8 * k) if len(h) > 8 * k else np.zeros(k, "<u4") for h, k in zip(p["hashes"], n)])
    yes = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=k).astype(bool) for m, k in zip(p["many"], n)])
    order = np.lexsort((low, high))
    same = (high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])
    yes[order[1:][same]] = True
    yes[order[:-1][same]] = True
    ends = np.cumsum(n)
    bits = [yes[e - k : e] for e, k in zip(ends, n)]
    some = [b.any() for b in bits]
    return pd.DataFrame({"chunk": p["chunk"][some], "bucket": p["bucket"][some], "bits": [np.packbits(b).tobytes() for b, s in zip(bits, some) if s]})


def anchors(chunk: Chunk, window: int, period: int, cover: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors, and their hashes."""
    length = window - period + 1
    at = np.flatnonzero(np.isin(np.arange(period), cover)[chunk.place % period] & (chunk.left >= length))
    return at, window_hashes(chunk.words, at, length, _BASES[0])


def windows(chunk: Chunk, anchor_at: np.ndarray, window: int, period: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of all windows that contain an anchor at one of these places; their 96-bit hashes."""
    step = np.zeros(len(chunk.words) + 1, np.int32)
    np.add.at(step, anchor_at - np.minimum(period - 1, chunk.place[anchor_at]), 1)
    np.add.at(step, anchor_at + 1, -1)
    at = np.flatnonzero((np.cumsum(step[:-1]) > 0) & (chunk.left >= window))
    if not len(at):
        return at, np.empty(0, np.uint64), np.empty(0, np.uint32)
    other = word_hashes(chunk.raw, chunk.begins, chunk.ends, _BASES[1])
    high, low = window_hashes(chunk.words, at, window, _BASES[0]), window_hashes(other, at, window, _BASES[1])
    return at, high, (low >> np.uint64(32)).astype(np.uint32)


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, period: int = PERIOD, cover: tuple[int, ...] = COVER, with_text: bool = False, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """key, n_words, n_removed, kept_sha256 and, if asked for, kept_text of every row."""
    if not (is_cover(period, cover) and period < window):
        raise ValueError("not a difference cover that leaves an anchor")
    spark = df.sparkSession
    field = df.schema[key].dataType
    kind, arrow_kind = field.simpleString(), to_arrow_type(field)

    def pack(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            off = byte_view(batch.column(1))[1]
            for lo, hi in byte_groups(off, chunk_bytes):
                payload = Chunk.pack(batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo))
                yield pa.record_batch([pa.array([number], pa.int64()), pa.array([int(off[hi] - off[lo])], pa.int64()), pa.array([payload], pa.binary())], ["chunk", "n_bytes", "payload"])
                number += 1

    path = scratch(spark, "cover-chunks")
    chunks = df.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(pack, "chunk long, n_bytes long, payload binary")
    chunks.write.option("compression", "uncompressed").option("parquet.block.size", 8 << 20).parquet(path)
    chunks = spark.read.schema(chunks.schema).parquet(path)
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))

    def each(batches, fn) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch.column(1)[row].as_buffer().to_pybytes())
                answers = [batch.column(i)[row].as_py() for i in range(2, batch.num_columns)]
                yield fn(batch.column(0)[row].as_py(), chunk, *answers)

    def ask_anchors(number: int, chunk: Chunk) -> pa.RecordBatch:
        return Asked(anchors(chunk, window, period, cover)[1], None, buckets).rows(number)

    def ask_windows(number: int, chunk: Chunk, first) -> pa.RecordBatch:
        at, hashes = anchors(chunk, window, period, cover)
        _, high, low = windows(chunk, at[Asked(hashes, None, buckets).answered(first)], window, period)
        return Asked(high, low, buckets).rows(number)

    def keep(number: int, chunk: Chunk, first, second) -> pa.RecordBatch:
        step = np.zeros(len(chunk.words) + 1, np.int32)
        if first:
            at, hashes = anchors(chunk, window, period, cover)
            at, high, low = windows(chunk, at[Asked(hashes, None, buckets).answered(first)], window, period)
            at = at[Asked(high, low, buckets).answered(second)]
            np.add.at(step, at, 1)
            np.add.at(step, at + window, -1)
        gone = np.cumsum(step[:-1]) > 0
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[chunk.before])
        data, texts = chunk.raw.tobytes(), []
        for i, (lo, hi) in enumerate(zip(chunk.off[:-1].tolist(), chunk.off[1:].tolist())):
            own = data[lo:hi].split()
            if removed[i]:
                own = [w for w, g in zip(own, gone[chunk.before[i] : chunk.before[i + 1]].tolist()) if not g]
            texts.append(b" ".join(own))
        cols = [chunk.keys.cast(arrow_kind), pa.array(np.diff(chunk.before)), pa.array(removed), pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())]
        if with_text:
            cols.append(pa.array(texts, pa.binary()).cast(pa.string()))
        return pa.record_batch(cols, ["key", "n_words", "n_removed", "kept_sha256", "kept_text"][: len(cols)])

    def answers(asked: DataFrame, name: str) -> DataFrame:
        got = asked.groupBy("bucket").applyInPandas(answer, "chunk long, bucket long, bits binary")
        got = got.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))
        return written(got, scratch(spark, f"cover-{name}"))

    payloads = chunks.select("chunk", "payload")
    first = answers(payloads.mapInArrow(lambda b: each(b, ask_anchors), ASKED), "anchors")
    second = answers(payloads.join(first, "chunk").mapInArrow(lambda b: each(b, ask_windows), ASKED), "windows")
    schema = f"key {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    done = payloads.join(first.join(second, "chunk"), "chunk", "left").mapInArrow(lambda b: each(b, keep), schema)
    return done.withColumnRenamed("key", key)


@query("op3_difference_cover_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
