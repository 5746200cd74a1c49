"""Token ids as static range-ANS blocks, written in key order and read back (operator 1).

Writing: ids of every text (plus an end id) are counted over the whole corpus;
the counts, quantised to 2^``SCALE_BITS``, are the one frequency table that
all blocks share (its size is bounded by the vocabulary).  Texts are range
partitioned by key; each task cuts its id stream into blocks of ``BLOCK`` ids.
A block is coded by ``LANES`` interleaved rANS states, holds its own document
index, a checkpoint of all states every ``CHECKPOINT`` steps and a checksum
for each stretch between checkpoints, so blocks, and stretches within a block,
decode independently of each other.

File format: a Parquet table of blocks (shard, block, n_ids, payload) beside a
one-row Parquet table with the frequency table.  Parquet gives the commit
protocol that lost executors need; the payload is the layout of ``HEADER``.

Null texts count as empty (only the end id).  Null keys come first; rows with
the same key stay separate documents, in reading order.  An empty table gives
an empty file set and an empty result.  Other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from saleslake.llm.common import arrow_map, query, scratch, table, written
from saleslake.llm.tokens import WORD_BPE, memo_tokenizer

END_ID = 2
SCALE_BITS = 22
LANES = 1024
BLOCK = 1 << 19
CHECKPOINT = 256  # steps; a step codes one id in each lane
LOW = np.uint64(1 << 31)
#: magic, version, scale bits, lanes, steps between checkpoints, ids, documents, checkpoints, words
HEADER = struct.Struct("<4sHHIIQIII")
MAGIC = b"RANS"


class FrequencyTable:
    """Counts quantised to a sum of 2^bits, at least 1 for every symbol that occurs."""

    def __init__(self, symbols: np.ndarray, freqs: np.ndarray, bits: int = SCALE_BITS):
        self.symbols, self.bits = symbols.astype(np.uint32), bits
        self.freq = freqs.astype(np.uint64)
        self.cum = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self.index = np.zeros(int(symbols.max()) + 1 if len(symbols) else 1, np.uint32)
        self.index[self.symbols] = np.arange(len(symbols), dtype=np.uint32)
        self._slots: np.ndarray | None = None

    @classmethod
    def of_counts(cls, symbols: np.ndarray, counts: np.ndarray, bits: int = SCALE_BITS) -> "FrequencyTable":
        total, scale = int(counts.sum()), 1 << bits
        if len(symbols) > scale:
            raise ValueError(f"{len(symbols)} symbols do not fit a scale of 2^{bits}")
        if not len(symbols):
            return cls(np.empty(0, np.uint32), np.empty(0, np.uint64), bits)
        freq = np.maximum(1, np.floor(counts.astype(np.float64) * scale / total)).astype(np.int64)
        excess = int(freq.sum()) - scale
        if excess < 0:
            freq[int(np.argmax(freq))] -= excess
        while excess > 0:  # symbols that were raised to 1: take it from the largest, in proportion
            spare = freq - 1
            take = np.minimum(spare, np.ceil(spare * (excess / spare.sum())).astype(np.int64))
            over = np.cumsum(take) - excess
            take = np.where(over > 0, np.maximum(0, take - over), take)
            freq -= take
            excess -= int(take.sum())
        return cls(symbols, freq, bits)

    def slots(self) -> np.ndarray:
        """The symbol index of each of the 2^bits slots."""
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._slots


def encode_block(ids: np.ndarray, docs: np.ndarray, freq: FrequencyTable, lanes: int = LANES, checkpoint: int = CHECKPOINT) -> bytes:
    """One block: header, document index, checksums, checkpoints, words, checksum of all before.

    docs: int64 rows (uid, first id of the piece within its document, ids of
    the piece, ids of the document, ids of the shard before the document).
    """
    n = len(ids)
    lanes = max(1, min(lanes, n // 64))
    steps = -(-n // lanes)
    sym = freq.index[ids]
    f, c = freq.freq[sym], freq.cum[sym]
    up, shift32, bits = np.uint64(63 - freq.bits), np.uint64(32), np.uint64(freq.bits)
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[np.ndarray, int]] = []
    emitted = 0
    for t in range(steps - 1, -1, -1):
        lo, hi = t * lanes, min(n, (t + 1) * lanes)
        x, fs = state[: hi - lo], f[lo:hi]
        full = x >= (fs << up)
        if full.any():
            words.append(x[full].astype(np.uint32))
            emitted += len(words[-1])
            x = np.where(full, x >> shift32, x)
        q = x // fs
        state[: hi - lo] = (q << bits) + (x - q * fs) + c[lo:hi]
        if t % checkpoint == 0:
            marks.append((state.copy(), emitted))
    marks.reverse()
    stretch = lanes * checkpoint
    sums = np.array([zlib.crc32(np.ascontiguousarray(ids[a : a + stretch], "<u4")) for a in range(0, n, stretch)], "<u4")
    places = np.array([emitted - e for _, e in marks], "<u8")
    body = b"".join([
        HEADER.pack(MAGIC, 1, freq.bits, lanes, checkpoint, n, len(docs), len(marks), emitted),
        np.ascontiguousarray(docs, "<i8").tobytes(),
        sums.tobytes(),
        places.tobytes(),
        *(np.ascontiguousarray(s, "<u8").tobytes() for s, _ in marks),
        *(np.ascontiguousarray(w, "<u4").tobytes() for w in reversed(words)),
    ])
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A read block; stretches between checkpoints can be decoded one by one."""

    def __init__(self, payload: bytes, freq: FrequencyTable):
        if struct.unpack_from("<I", payload, len(payload) - 4)[0] != zlib.crc32(memoryview(payload)[:-4]):
            raise ValueError("block checksum does not match")
        magic, version, bits, self.lanes, self.every, self.n, n_docs, n_marks, n_words = HEADER.unpack_from(payload)
        if magic != MAGIC or version != 1 or bits != freq.bits:
            raise ValueError("not a block of this format and table")
        at = HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(payload, kind, count, at)
            at += out.nbytes
            return out

        self.freq = freq
        self.docs = take("<i8", 5 * n_docs).reshape(n_docs, 5)
        self.sums, self.places = take("<u4", n_marks), take("<u8", n_marks)
        self.states = take("<u8", n_marks * self.lanes).reshape(n_marks, self.lanes)
        self.words = take("<u4", n_words)

    def stretch(self, k: int) -> np.ndarray:
        """The ids between checkpoint k and the next."""
        freq = self.freq
        slots, bits, mask, shift32 = freq.slots(), np.uint64(freq.bits), np.uint64((1 << freq.bits) - 1), np.uint64(32)
        state, place = self.states[k].copy(), int(self.places[k])
        first = k * self.every * self.lanes
        last = min(self.n, first + self.every * self.lanes)
        out = np.empty(last - first, np.uint32)
        for lo in range(first, last, self.lanes):
            hi = min(last, lo + self.lanes)
            x = state[: hi - lo]
            slot = x & mask
            sym = slots[slot]
            x = freq.freq[sym] * (x >> bits) + slot - freq.cum[sym]
            low = np.flatnonzero(x < LOW)
            x[low] = (x[low] << shift32) | self.words[place : place + len(low)]
            place += len(low)
            state[: hi - lo] = x
            out[lo - first : hi - first] = sym
        ids = freq.symbols[out]
        if zlib.crc32(np.ascontiguousarray(ids, "<u4")) != self.sums[k]:
            raise ValueError(f"checksum of stretch {k} does not match")
        return ids

    def ids(self) -> np.ndarray:
        return np.concatenate([self.stretch(k) for k in range(len(self.places))]) if len(self.places) else np.empty(0, np.uint32)


_GF = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of polynomials modulo the crc32 polynomial (bit 31 is x^0)."""
    out = 0
    while b:
        if b & 0x80000000:
            out ^= a
        a = (a >> 1) ^ (_GF if a & 1 else 0)
        b = (b << 1) & 0xFFFFFFFF
    return out


def joined_crc32(first: int, second: int, n_bytes: int) -> int:
    """crc32 of two strings one after another, from theirs and the second's length."""
    power, base, n = 0x80000000, 0x00800000, n_bytes  # x^0; x^8
    while n:
        if n & 1:
            power = _times(power, base)
        base = _times(base, base)
        n >>= 1
    return _times(first, power) ^ second


def _tokenized(df: DataFrame, key: str, text: str, path: str, end_id: int) -> DataFrame:
    """uid, key, n_ids, ids (packed unsigned 16- or 32-bit) of every row."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        memo = memo_tokenizer(path)
        unit = "<u2" if max(memo.n_ids, end_id + 1) <= 1 << 16 else "<u4"
        for lo, hi, ids, ends in memo.encode_column(batch.column(2)):
            n = np.diff(ends)
            packed = np.insert(ids, ends[1:], end_id).astype(unit)
            at = np.concatenate([[0], np.cumsum(n + 1)]) * packed.itemsize
            col = pa.LargeBinaryArray.from_buffers(pa.large_binary(), hi - lo, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(packed)])
            yield pa.record_batch([batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), pa.array(n + 1), col.cast(pa.binary()), pa.array(np.full(hi - lo, packed.itemsize, np.int32))], ["uid", "key", "n_ids", "ids", "unit"])

    rows = df.select(F.monotonically_increasing_id().alias("uid"), F.col(key).alias("key"), F.col(text).alias("text"))
    return arrow_map(rows, run, f"uid long, key {df.schema[key].dataType.simpleString()}, n_ids long, ids binary, unit int")


def _id_counts(tokens: DataFrame) -> DataFrame:
    """id, n over the whole corpus; one row per id and task before the shuffle."""

    def run(batches):
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            for ids, unit in zip(b.column(0), b.column(1).to_pylist()):
                got = np.bincount(np.frombuffer(ids.as_buffer(), f"<u{unit}"))
                if len(got) > len(total):
                    total = np.concatenate([total, np.zeros(len(got) - len(total), np.int64)])
                total[: len(got)] += got
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["id", "n"])

    return tokens.select("ids", "unit").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", tokenizer: str = WORD_BPE, end_id: int = END_ID, block: int = BLOCK, lanes: int = LANES, checkpoint: int = CHECKPOINT) -> None:
    """Write ``path``/table and ``path``/blocks; documents in ascending key order."""
    spark = df.sparkSession
    tokens = written(_tokenized(df, key, text, tokenizer, end_id), scratch(spark, "rans-tokens"))
    counts = _id_counts(tokens).toPandas().sort_values("id")  # one row per id of the vocabulary at most
    freq = FrequencyTable.of_counts(counts["id"].to_numpy(np.int64), counts["n"].to_numpy(np.int64))
    spark.createDataFrame([(freq.bits, freq.symbols.astype("<u4").tobytes(), freq.freq.astype("<u4").tobytes())], "bits int, symbols binary, freqs binary").coalesce(1).write.parquet(f"{path}/table")

    def run(batches):
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        ids: list[np.ndarray] = []
        docs: list[tuple] = []
        held = 0

        def flushed() -> pa.RecordBatch:
            nonlocal number, ids, docs, held
            payload = encode_block(np.concatenate(ids), np.array(docs, np.int64), freq, lanes, checkpoint)
            out = pa.record_batch([pa.array([shard], pa.int64()), pa.array([number], pa.int64()), pa.array([held], pa.int64()), pa.array([payload], pa.binary())], ["shard", "block", "n_ids", "payload"])
            number, ids, docs, held = number + 1, [], [], 0
            return out

        for b in batches:
            for uid, raw, unit in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                own, done = np.frombuffer(raw.as_buffer(), f"<u{unit}"), 0
                while done < len(own):
                    n = min(block - held, len(own) - done)
                    ids.append(own[done : done + n].astype(np.uint32))
                    docs.append((uid, done, n, len(own), before))
                    done, held = done + n, held + n
                    if held == block:
                        yield flushed()
                before += len(own)
        if held:
            yield flushed()

    ordered = tokens.repartitionByRange("key", "uid").sortWithinPartitions("key", "uid").select("uid", "ids", "unit")
    ordered.mapInArrow(run, "shard long, block long, n_ids long, payload binary").write.option("compression", "uncompressed").option("parquet.block.size", 16 << 20).parquet(f"{path}/blocks")
    tokens.select("uid", "key").write.parquet(f"{path}/keys")


def read_ids(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Decoded pieces: uid, piece_start, n_ids, doc_ids, shard, start_in_shard, crc32 and, if asked for, ids."""
    bits, symbols, freqs = spark.read.parquet(f"{path}/table").first()
    symbols, freqs = np.frombuffer(symbols, "<u4"), np.frombuffer(freqs, "<u4")
    held: dict[str, FrequencyTable] = {}

    def run(batches):
        freq = held.setdefault("table", FrequencyTable(symbols, freqs, bits))
        for batch in batches:
            for shard, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                got = Block(payload.as_buffer().to_pybytes(), freq)
                packed = memoryview(got.ids().astype("<u4").tobytes())
                at = np.concatenate([[0], np.cumsum(got.docs[:, 2])]) * 4
                parts = [packed[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                cols = [pa.array(got.docs[:, i]) for i in range(5)] + [pa.array(np.full(len(parts), shard, np.int64)), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if with_ids:
                    cols.append(pa.array([bytes(p) for p in parts], pa.binary()))
                yield pa.record_batch(cols, names)

    names = ["uid", "piece_start", "n_ids", "doc_ids", "start_in_shard", "shard", "crc32"] + ["ids"] * with_ids
    schema = ", ".join(f"{c} long" for c in names[:7]) + ", ids binary" * with_ids
    return spark.read.parquet(f"{path}/blocks").select("shard", "payload").mapInArrow(run, schema)


@F.pandas_udf(LongType())
def _doc_crc32(parts: pd.Series) -> pd.Series:
    """Of a document's pieces in order: crc32 and ids of each."""

    def one(pieces) -> int:
        crc = pieces[0]["crc32"]
        for p in pieces[1:]:
            crc = joined_crc32(crc, p["crc32"], 4 * p["n_ids"])
        return crc

    return parts.map(one)


def ids_digest(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """key, start, n_tokens, ids_crc32 of every document, from the written files."""
    shards = spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))  # one row per shard
    docs = read_ids(spark, path).groupBy("uid").agg(
        F.min("shard").alias("shard"), F.min("start_in_shard").alias("start_in_shard"), F.sum("n_ids").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("piece_start", "n_ids", "crc32"))).alias("parts"),
    )
    docs = docs.withColumn("ids_crc32", F.when(F.size("parts") == 1, F.col("parts")[0]["crc32"]).otherwise(_doc_crc32("parts")))
    keys = spark.read.parquet(f"{path}/keys")
    return docs.join(keys, "uid").join(shards, "shard").select(F.col("key").alias(key), (F.col("shard_start") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")


@query("op1_rans_token_blocks")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "rans")
    write_ids(table(spark, sf_dir, "documents"), path)
    return ids_digest(spark, path)
