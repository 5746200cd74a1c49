"""Hierarchical multi-length packing (operator 4).

Each task packs the documents of its own split, in one pass with a bounded
pool, so nothing is shuffled and no group grows with the data.  A document of
n ids gives full windows of the longest tier at once; its rest is routed to
the smallest tier (power of two) that holds it.  Each tier is packed from its
longest piece; the gap of a window is filled with the longest pieces of
shorter tiers that fit, and at last by cutting one piece.  What is left at the
end of a split is cut into powers of two, so that no window needs padding.
Windows of a tier are dealt to step groups of ``step_tokens`` each, so every
step group holds as many tokens as any other (the last of a tier and split may
hold fewer).

Null texts count as empty: their single piece is the end id.  Null keys stay;
repeated rows are packed each on their own; an empty table gives no pieces;
other columns are not read.  ``sequence_id`` and ``step_id`` are unique, not
contiguous: the split's number is in the upper half.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm.common import query, table
from saleslake.llm.tokens import WORD_BPE, memo_tokenizer

TIERS = (256, 512, 1024, 2048)
END_ID = 1
STEP_TOKENS = 16 * 2048
POOL = 2048  # pieces that wait for a window
KEEP = 256  # pieces that stay as a choice until the split ends


class TierPacker:
    """Packs (length, document, start) pieces; yields (window, [(document, start, length), ...])."""

    def __init__(self, tiers: tuple[int, ...] = TIERS):
        self.tiers = sorted(tiers)
        self.top = self.tiers[-1]
        self.pools: list[list[tuple[int, int, int]]] = [[] for _ in self.tiers]
        self.waiting = 0

    def _route(self, doc: int, start: int, length: int) -> None:
        insort(self.pools[bisect_left(self.tiers, length)], (length, doc, start))
        self.waiting += 1

    def _pop(self, tier: int, at: int) -> tuple[int, int, int]:
        self.waiting -= 1
        return self.pools[tier].pop(at)

    def add(self, doc: int, length: int) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        start = 0
        while length - start >= self.top:
            yield self.top, [(doc, start, self.top)]
            start += self.top
        if length > start:
            self._route(doc, start, length - start)
        if self.waiting > POOL:
            yield from self.pack(KEEP)

    def _fill(self, gap: int, below: int) -> tuple[int, int, int] | None:
        """The longest waiting piece of tiers up to ``below`` that fits, else a cut of the shortest one."""
        for tier in range(min(below, bisect_left(self.tiers, gap)), -1, -1):
            at = bisect_right(self.pools[tier], (gap, np.inf, np.inf))
            if at:
                return self._pop(tier, at - 1)
        for tier in range(len(self.tiers)):
            if self.pools[tier]:
                length, doc, start = self._pop(tier, 0)
                self._route(doc, start + gap, length - gap)
                return gap, doc, start
        return None

    def pack(self, keep: int = 0) -> Iterator[tuple[int, list[tuple[int, int, int]]]]:
        """Windows until at most ``keep`` pieces wait; with 0, what is left is cut into powers of two."""
        while self.waiting > keep:
            tier = max(range(len(self.tiers)), key=lambda t: (len(self.pools[t]) * self.tiers[t], t))
            window, gap = [], self.tiers[tier]
            length, doc, start = self._pop(tier, -1)
            while True:
                window.append((doc, start, length))
                gap -= length
                piece = self._fill(gap, tier) if gap else None
                if piece is None:
                    break
                length, doc, start = piece
            if not gap:
                yield self.tiers[tier], window
                continue
            left = self.tiers[tier] - gap  # nothing else waits: powers of two
            while left:
                size = 1 << (left.bit_length() - 1)
                part, need = [], size
                while need:
                    doc, start, length = window.pop(0)
                    if length > need:
                        window.insert(0, (doc, start + need, length - need))
                        length = need
                    part.append((doc, start, length))
                    need -= length
                yield size, part
                left -= size


def pack(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = WORD_BPE, end_id: int = END_ID, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per piece: key, start, length, doc_tokens, sequence_id, offset, window, step_id, ids (packed unsigned 32-bit)."""

    def run(batches):
        memo = memo_tokenizer(path)
        packer = TierPacker(tiers)
        held: dict[int, list] = {}  # document -> [key, ids, ids not yet written]
        n_docs, n_windows = 0, 0
        base = TaskContext.get().partitionId() << 32
        steps: dict[int, list[int]] = {}  # window -> [step group, windows it still takes]
        n_steps = 0
        rows: list[tuple] = []

        def write(window: int, pieces: list[tuple[int, int, int]]) -> None:
            nonlocal n_windows, n_steps
            step = steps.get(window)
            if step is None or not step[1]:
                step = steps[window] = [n_steps, max(1, step_tokens // window)]
                n_steps += 1
            step[1] -= 1
            offset = 0
            for doc, start, length in pieces:
                own = held[doc]
                rows.append((own[0], start, length, len(own[1]), base + n_windows, offset, window, base + step[0], own[1][start : start + length].tobytes()))
                offset += length
                own[2] -= length
                if not own[2]:
                    del held[doc]
            n_windows += 1

        def flushed() -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [[]] * 9
            rows.clear()
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)], names)

        kinds = None
        for batch in batches:
            keys = batch.column(0)
            kinds = [keys.type, *[pa.int64()] * 7, pa.binary()]
            names = ["key", "start", "length", "doc_tokens", "sequence_id", "offset", "window", "step_id", "ids"]
            for lo, hi, ids, ends in memo.encode_column(batch.column(1)):
                own_keys = keys.slice(lo, hi - lo).to_pylist()
                for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
                    own = np.empty(b - a + 1, "<u4")
                    own[:-1], own[-1] = ids[a:b], end_id
                    held[n_docs] = [own_keys[i], own, len(own)]
                    for window in packer.add(n_docs, len(own)):
                        write(*window)
                    n_docs += 1
                    if len(rows) > 4000:
                        yield flushed()
        for window in packer.pack():
            write(*window)
        if rows:
            yield flushed()

    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, window long, step_id long, ids binary"
    return df.select(key, text).mapInArrow(run, schema).withColumnRenamed("key", key)


@query("op4_tiered_packing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step_id")
