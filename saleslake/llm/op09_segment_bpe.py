"""Byte-level BPE with a segment tree, and decoding (operator 9).

Every match of the split pattern is encoded on its own.  The tree's leaves are
the byte positions; a leaf holds the rank of the pair that starts there (and
its position), a node the smallest of its children, so the root is always the
leftmost pair of least rank.  A merge changes two live neighbours: two point
updates of logarithmic length.  Distinct matches are encoded once per worker
and kept in a memo that is emptied when full.

Null texts count as empty (no ids).  Rows are independent: repeated rows give
repeated results, an empty table an empty one; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from saleslake.llm.common import arrow_map, query, table
from saleslake.llm.tokens import byte_groups, byte_view

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
MEMO_ENTRIES = 600_000
LONG_MATCH = 64  # longer matches are encoded each time, not kept
NONE = 1 << 62

_LOADED: dict[str, "SegmentTreeBpe"] = {}


def segment_bpe(path: str = RANKS) -> "SegmentTreeBpe":
    if path not in _LOADED:
        _LOADED[path] = SegmentTreeBpe(path)
    return _LOADED[path]


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match: merges the leftmost pair of least rank until none is left."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    size = 1 << (n - 1).bit_length()
    after = list(range(1, n + 1))  # start of the next live token
    before = list(range(-1, n - 1))
    tree = [NONE] * (2 * size)
    get = ranks.get
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank * size + i
    for node in range(size - 1, 0, -1):
        a, b = tree[2 * node], tree[2 * node + 1]
        tree[node] = a if a < b else b
    while tree[1] < NONE:
        i = tree[1] % size
        j = after[i]
        k = after[j]
        after[i] = k
        if k < n:
            before[k] = i
        p = before[i]
        changes = [(j, NONE)]
        rank = get(piece[i : after[k]]) if k < n else None
        changes.append((i, NONE if rank is None else rank * size + i))
        if p >= 0:
            rank = get(piece[p:k])
            changes.append((p, NONE if rank is None else rank * size + p))
        for at, value in changes:
            node = size + at
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    break
                tree[node] = least
                node >>= 1
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class SegmentTreeBpe:
    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        self.ranks = load_ranks(path)
        self.find = regex.compile(pattern).findall
        self.memo: dict[bytes, bytes] = {}
        tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.tokens = pa.array(tokens, pa.large_binary())

    def _ids_of(self, pieces: list[bytes]) -> list[bytes]:
        memo, ranks = self.memo, self.ranks
        if len(memo) + len(pieces) // 4 > MEMO_ENTRIES:
            memo.clear()
        out = list(map(memo.get, pieces))
        for i in [i for i, ids in enumerate(out) if ids is None]:
            piece = pieces[i]
            out[i] = ids = np.array(merged(piece, ranks), "<u4").tobytes()
            if len(piece) <= LONG_MATCH:
                memo[piece] = ids
        return out

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text)."""
        found: list[str] = []
        ends = [0]
        for text in texts:
            if text:
                found.extend(self.find(text))
            ends.append(len(found))
        if not found:
            return np.empty(0, np.uint32), np.zeros(len(ends), np.int64)
        words = pa.array(found, pa.large_string()).cast(pa.large_binary()).dictionary_encode()
        del found
        ids = pa.array(self._ids_of(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        at = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
        flat = np.frombuffer(ids.buffers()[2], "<u4")[at[0] // 4 : at[-1] // 4]
        return flat, (at[ends] - at[0]) // 4

    def decode(self, ids: np.ndarray, off: np.ndarray) -> tuple[memoryview, list[int]]:
        """(bytes, offsets by text) of ids."""
        out = self.tokens.take(pa.array(ids))
        at = np.frombuffer(out.buffers()[1], np.int64)[out.offset : out.offset + len(out) + 1]
        data = out.buffers()[2]
        return memoryview(data if data is not None else b""), at[off].tolist()


def bpe_digests(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = RANKS, with_ids: bool = False) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (packed unsigned 32-bit) of every row."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bpe = segment_bpe(path)
        texts = batch.column(1)
        for lo, hi in byte_groups(byte_view(texts)[1], 4_000_000):
            flat, off = bpe.encode(texts.slice(lo, hi - lo).to_pylist())
            data, ends = bpe.decode(flat, off)
            packed, at = memoryview(flat.tobytes()), (4 * off).tolist()
            cols = [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(off))]
            cols += [pa.array([hashlib.sha256(x[a:b]).hexdigest() for a, b in zip(e[:-1], e[1:])], pa.string()) for x, e in ((packed, at), (data, ends))]
            if with_ids:
                cols.append(pa.array([bytes(packed[a:b]) for a, b in zip(at[:-1], at[1:])], pa.binary()))
            yield pa.record_batch(cols, names)

    names = ["key", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][: 5 if with_ids else 4]
    schema = f"key {df.schema[key].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids
    return arrow_map(df.select(key, text), run, schema).withColumnRenamed("key", key)


@query("op9_segment_tree_bpe")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))
