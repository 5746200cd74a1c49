"""Exact dedup by Grace hashing (operator 8).

1. Each Arrow batch normalises its texts, finds its own copies in an
   open-addressing table that compares complete contents, and writes one
   record per row; only the first of the batch's equal texts carries the
   (compressed) content.  A text that a third of all rows share thus reaches
   the shuffle once per batch.
2. The carriers are shuffled by content hash.  A task streams its partition
   into an open-addressing table; once the table is full, records whose
   content is not in it go to spill files by further hash bits, and each file
   is treated in the same way, recursively, until it fits.  Equality is always
   decided on complete contents, never on the hash.
3. Every record is joined with its carrier's group.

Spill files are anonymous files of the task, next to Spark's own spills; they
vanish with the task, and a lost task is simply run again from the shuffle.

Null texts count as empty.  The row with the smallest key stays, null keys
after all others, and of rows with the same key the first read; exactly one
row of a group has ``kept``.  An empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm.common import arrow_map, query, scratch, table, written
from saleslake.llm.tokens import IS_SPACE, byte_groups, byte_view

TABLE_BYTES = 48_000_000  # contents held by one task's table
FAN_OUT = 16


def normalised(raw: np.ndarray, off: np.ndarray) -> tuple[bytes, list[int]]:
    """Texts with each run of ASCII white space as one space: (bytes, offsets)."""
    space = IS_SPACE[raw]
    keep = ~space
    keep[1:] |= ~space[:-1]
    keep[off[:-1][off[:-1] < len(raw)]] = True
    out = np.where(space, np.uint8(32), raw)[keep]
    places = np.flatnonzero(keep)
    return out.tobytes(), np.searchsorted(places, off).tolist()


class ContentTable:
    """Open addressing with linear probing; entries are equal only if their whole contents are."""

    def __init__(self):
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.bytes = 0

    def find(self, h: int, content: bytes, add: bool = True) -> int:
        """The entry of ``content``; a new one if there is none and ``add``, else -1."""
        mask = len(self.slots) - 1
        i = h & mask
        while (e := self.slots[i]) >= 0:
            if self.hashes[e] == h and self.contents[e] == content:
                return e
            i = (i + 1) & mask
        if not add:
            return -1
        self.slots[i] = len(self.hashes)
        self.hashes.append(h)
        self.contents.append(content)
        self.bytes += len(content) + 100
        if 2 * len(self.hashes) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for e, own in enumerate(self.hashes):
                i = own & mask
                while self.slots[i] >= 0:
                    i = (i + 1) & mask
                self.slots[i] = e
        return len(self.hashes) - 1


def _read(file) -> Iterator[tuple]:
    file.seek(0)
    while True:
        try:
            yield from pickle.load(file)
        except EOFError:
            return


def grace(records: Iterable[tuple], limit: int = TABLE_BYTES, level: int = 0) -> Iterator[tuple[list[int], tuple, int]]:
    """(carriers, first, rows) of each group of (hash, content, carrier, first, rows) records."""
    contents = ContentTable()
    carriers: list[array] = []
    firsts: list[tuple] = []
    sizes: list[int] = []
    files: list = []
    held: list[list[tuple]] = []
    for h, content, carrier, first, n in records:
        e = contents.find(h, content, add=contents.bytes < limit)
        if e < 0:
            if not files:
                where = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
                files = [tempfile.TemporaryFile(dir=where if os.path.isdir(where) else None) for _ in range(FAN_OUT)]
                held = [[] for _ in files]
            k = int.from_bytes(hashlib.blake2b(h.to_bytes(8, "little", signed=True), digest_size=2, salt=level.to_bytes(8, "little")).digest(), "little") % FAN_OUT
            held[k].append((h, content, carrier, first, n))
            if len(held[k]) >= 64:
                pickle.dump(held[k], files[k])
                held[k] = []
        elif e == len(sizes):
            carriers.append(array("q", [carrier]))
            firsts.append(first)
            sizes.append(n)
        else:
            carriers[e].append(carrier)
            firsts[e] = min(firsts[e], first)
            sizes[e] += n
    del contents
    yield from zip(carriers, firsts, sizes)
    del carriers, firsts, sizes
    for file, rest in zip(files, held):
        if rest:
            pickle.dump(rest, file)
        with file:
            yield from grace(_read(file), limit, level + 1)


def order(key, uid: int) -> tuple:
    return key is None, 0 if key is None else key, uid


def _records(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    uids, keys = batch.column(0), batch.column(1)
    raw, off = byte_view(batch.column(2))
    squeeze = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
    contents = ContentTable()
    firsts: list[tuple] = []
    carrier: list[int] = []
    entry: list[int] = []
    shas: list[bytes] = []
    for lo, hi in byte_groups(off):
        data, ends = normalised(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
        own_uids, own_keys = uids.slice(lo, hi - lo).to_pylist(), keys.slice(lo, hi - lo).to_pylist()
        for i, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
            text = data[a:b]
            sha = hashlib.sha256(text).digest()
            e = contents.find(int.from_bytes(sha[:8], "little", signed=True), squeeze(text))
            here = order(own_keys[i], own_uids[i])
            if e == len(firsts):
                firsts.append(here)
                carrier.append(own_uids[i])
            else:
                firsts[e] = min(firsts[e], here)
            entry.append(e)
            shas.append(sha)
    of = np.array(entry, np.int64)
    sizes = np.bincount(of, minlength=len(firsts)).tolist()
    carriers = np.array(carrier, np.int64)[of] if len(of) else of
    first_row = carriers == np.asarray(uids)
    shown = [e if f else None for e, f in zip(entry, first_row.tolist())]
    yield pa.record_batch(
        [uids, keys, pa.array(shas, pa.binary()), pa.array(carriers)]
        + [pa.array([None if e is None else x[e] for e in shown], t) for x, t in ((contents.hashes, pa.int64()), (contents.contents, pa.binary()), (sizes, pa.int64()))]
        + [pa.array([None if e is None or firsts[e][0] else firsts[e][1] for e in shown], keys.type), pa.array([None if e is None else firsts[e][2] for e in shown], pa.int64())],
        ["uid", "key", "sha", "carrier", "hash", "content", "n", "first_key", "first_uid"],
    )


def exact_dedup(df: DataFrame, key: str = "doc_id", text: str = "text", uid: str | None = None, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """uid, key, keep_id, group_size, kept, text_sha256 for every row.

    ``uid``: a column of unique longs, if the caller has one; else rows are
    numbered here.
    """
    spark = df.sparkSession
    number = F.col(uid) if uid else F.monotonically_increasing_id()
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(number.alias("uid"), F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"uid long, key {kind}, sha binary, carrier long, hash long, content binary, n long, first_key {kind}, first_uid long"
    records = written(arrow_map(rows, _records, schema), scratch(spark, "dedup-records"))

    def group(batches):
        def stream():
            for b in batches:
                for h, content, u, k, first, n in zip(*(b.column(i).to_pylist() for i in range(6))):
                    yield h, content, u, order(k, first), n

        out: list[list] = [[], [], [], []]
        for carriers, first, n in grace(stream(), table_bytes):
            out[0].extend(carriers)
            for col, x in zip(out[1:], (None if first[0] else first[1], first[2], n)):
                col.extend([x] * len(carriers))
            if len(out[0]) >= 10_000:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names)
                out = [[], [], [], []]
        if out[0]:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, kinds)], names)

    from pyspark.sql.pandas.types import to_arrow_type

    kinds, names = [pa.int64(), to_arrow_type(df.schema[key].dataType), pa.int64(), pa.int64()], ["carrier", "keep_id", "keep_uid", "group_size"]
    carriers = records.filter(F.col("content").isNotNull()).select("hash", "content", "uid", "first_key", "first_uid", "n")
    groups = carriers.repartition("hash").mapInArrow(group, f"carrier long, keep_id {kind}, keep_uid long, group_size long")
    return records.select("uid", "key", "sha", "carrier").join(groups, "carrier").select(
        "uid", F.col("key").alias(key), "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256")
    )


SQL = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM t WINDOW w AS (PARTITION BY body)
"""


@query("op8_grace_exact_dedup", SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).drop("uid")
