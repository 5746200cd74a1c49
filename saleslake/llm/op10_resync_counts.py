"""Token counts by overlap resynchronisation (operator 10).

A text is encoded in chunks of ``CHUNK_BYTES`` that overlap by ``OVERLAP``
bytes, with offsets (a short text is one chunk); no chunk knows what stands
outside it.  Two neighbouring chunks are spliced at a position of their overlap
that is a proven token boundary (the tokenizer drops white space, and always
cuts between a letter and punctuation other than an apostrophe) and from which
both encodings agree, id by id and offset by offset, for ``STRETCHES`` stretches
between such boundaries.  Where there is none (a word longer than the overlap,
a special string across a cut), the text is encoded again with overlaps that
double until they align, up to a chunk that covers all that is left; memory is
bounded by one text.  All chunks of a batch are encoded together.

Null texts count as empty (0 bytes, 0 tokens); rows are independent, so
repeated rows give repeated results; an empty table gives an empty result;
columns other than the key and the text are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from saleslake.llm.common import arrow_map, query, table
from saleslake.llm.tokens import WORD_BPE, MemoTokenizer, byte_groups, byte_view, memo_tokenizer

CHUNK_BYTES = 4_096
OVERLAP = 256
STRETCHES = 2
LIMIT = 2048
AGREE = 8

_STABLE = re.compile(r"[ \t\n\v\f\r]|(?<=[A-Za-z])(?=[!#-&(-/:;=?@\[-`{}~])")


def _encoded(tok, text: str, lo: int, hi: int) -> tuple[list[int], list[int], list[int]]:
    """Ids, first and end positions (in the whole text) of text[lo:hi]."""
    e = tok.encode(text[lo:hi], add_special_tokens=False)
    return e.ids, [lo + a for a, _ in e.offsets], [lo + b for _, b in e.offsets]


def splice(text: str, left: tuple, right: tuple, lo: int, hi: int) -> tuple[int, int] | None:
    """(tokens of left before, token of right from) the first stable common boundary in [lo, hi), or None."""
    l_ids, l_from, l_to = left
    r_ids, r_from, r_to = right
    for m in _STABLE.finditer(text, lo, hi):
        p = m.start()
        if p == lo or "<|" in text[max(0, p - 16) : p + 2]:
            continue
        i, j = bisect_left(l_from, p), bisect_left(r_from, p)
        if (i and l_to[i - 1] > p) or (j and r_to[j - 1] > p):
            continue
        n = min(AGREE, len(l_ids) - i, len(r_ids) - j)
        # the last tokens of the left chunk may be cut short: they don't count as agreement
        if n < AGREE or l_to[i + n - 1] >= hi:
            return None
        if l_ids[i : i + n] == r_ids[j : j + n] and l_from[i : i + n] == r_from[j : j + n]:
            return i, j
    return None


def count_by_chunks(tok, text: str, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP) -> tuple[int, int]:
    """(tokens, widened overlaps) of one text, as the library would count it whole."""
    n, widened = 0, 0
    lo, hi = 0, min(len(text), chunk)
    left = _encoded(tok, text, lo, hi)
    taken = 0  # tokens of ``left`` that lie before the last splice
    while hi < len(text):
        back = min(overlap, hi - lo)
        while True:
            start = hi - back
            end = min(len(text), start + max(chunk, 2 * back))
            right = _encoded(tok, text, start, end)
            at = splice(text, left, right, start, hi)
            # a splice must not fall before the one that began this chunk
            if at is not None and at[0] >= taken:
                n += at[0] - taken
                lo, hi, left, taken = start, end, right, at[1]
                break
            widened += 1
            if start == lo:  # the whole chunk overlaps: take a longer one from the same place
                left, hi = right, end
                if hi >= len(text):
                    break
                back = min(overlap, hi - lo)
                continue
            back = min(2 * back, hi - lo)
    return n + len(left[0]) - taken, widened


def chunked(raw: np.ndarray, off: np.ndarray, chunk: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first bytes, end bytes, chunks before each text and in all) of overlapping chunks, cut between characters."""
    size = np.diff(off)
    step = chunk - overlap
    n = 1 + np.maximum(0, -(-(size - chunk) // step))
    before = np.concatenate([[0], np.cumsum(n)])
    within = np.arange(before[-1]) - np.repeat(before[:-1], n)
    first = np.repeat(off[:-1], n) + step * within
    end = np.minimum(first + chunk, np.repeat(off[1:], n))
    for at in (first, end):
        for _ in range(3):  # a character has three bytes after its first at most
            inside = (at < len(raw)) & (at > 0)
            inside[inside] = (raw[at[inside]] & 0xC0) == 0x80
            at[inside] -= 1
    return first, end, before


def aligned(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray], ids: np.ndarray) -> tuple[int, int] | None:
    """(stretch of the left chunk, stretch of the right one) at which both can be spliced, or None.

    A chunk is (first byte of each stretch, ids before each stretch and behind
    the last).  The right chunk's first stretch and the left one's last may be cut.
    """
    (l_at, l_ids), (r_at, r_ids) = left, right
    i = int(np.searchsorted(l_at, r_at[1])) if len(r_at) > 1 else len(l_at)
    while i + STRETCHES < len(l_at):
        j = int(np.searchsorted(r_at, l_at[i]))
        if 0 < j and j + STRETCHES <= len(r_at) and np.array_equal(l_at[i : i + STRETCHES], r_at[j : j + STRETCHES]):
            a, b, c, d = l_ids[i], l_ids[i + STRETCHES], r_ids[j], r_ids[j + STRETCHES]
            if np.array_equal(ids[a:b], ids[c:d]):
                return i, j
        i += 1
    return None


def spliced(memo: MemoTokenizer, raw: np.ndarray, off: np.ndarray, chunk: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, chunks) of each text; -1 tokens for a text with a pair of chunks that do not align."""
    first, end, before = chunked(raw, off, chunk, overlap)
    own = np.concatenate([[0], np.cumsum(end - first)])
    place = np.arange(own[-1]) + np.repeat(first - own[:-1], end - first)
    ids, at, begins, by_chunk = memo.stretches(raw[place], own)
    n = at[by_chunk[1:]] - at[by_chunk[:-1]]  # tokens of each chunk
    n_chunks = np.diff(before)
    out = np.add.reduceat(n, before[:-1]) if len(n) else np.zeros(0, np.int64)
    for t in np.flatnonzero(n_chunks > 1).tolist():
        parts = []
        for c in range(before[t], before[t + 1]):
            s, e = by_chunk[c], by_chunk[c + 1]
            parts.append((begins[s:e] - own[c] + first[c], at[s : e + 1]))
        total, taken = 0, 0  # ids of all chunks so far, and the first stretch of the current one that counts
        for left, right in zip(parts[:-1], parts[1:]):
            cut = aligned(left, right, ids)
            if cut is None or cut[0] < taken:
                total = -1
                break
            total += int(left[1][cut[0]] - left[1][taken])
            taken = cut[1]
        out[t] = total if total < 0 else total + int(parts[-1][1][-1] - parts[-1][1][taken])
    return out, n_chunks


def token_counts(df: DataFrame, key: str = "doc_id", text: str = "text", path: str = WORD_BPE, chunk_bytes: int = CHUNK_BYTES, overlap: int = OVERLAP, limit: int = LIMIT) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit, chunks, widened (overlaps that had to grow) for every row."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        memo: MemoTokenizer = memo_tokenizer(path)
        texts = batch.column(1)
        raw, off = byte_view(texts)
        n_tokens, chunks, widened = (np.zeros(len(off) - 1, np.int64) for _ in range(3))
        for lo, hi in byte_groups(off):
            n_tokens[lo:hi], chunks[lo:hi] = spliced(memo, raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo], chunk_bytes, overlap)
        for i in np.flatnonzero(n_tokens < 0).tolist():
            n_tokens[i], widened[i] = count_by_chunks(memo.tok, texts[i].as_py(), chunk_bytes, overlap)
        n_bytes = np.diff(off)
        return pa.record_batch([batch.column(0), *map(pa.array, (n_bytes, n_tokens, n_tokens > limit, chunks, widened))], ["key", "n_bytes", "n_tokens", "over_limit", "chunks", "widened"])

    kind = df.schema[key].dataType.simpleString()
    out = arrow_map(df.select(key, text), count, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean, chunks long, widened long")
    return out.withColumnRenamed("key", key)


@query("op10_resync_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_tokens", "over_limit")
