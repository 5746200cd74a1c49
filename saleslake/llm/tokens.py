"""Token ids of whole texts through the tokenizers library, with a bounded memo.

The ``word_bpe_49k`` pipeline (NFC, white space folding, lower-casing, a regex
split whose matches never contain white space, special strings without white
space) treats the stretches between ASCII white space independently, so a
text's ids are the ids of its stretches one after another.  It always cuts
between a letter and ASCII punctuation other than an apostrophe, too.
Stretches repeat a great deal; each distinct one is encoded by the library
once per worker and kept in a memo that is emptied when it is full (memory
bound, results do not depend on it).
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

MEMO_ENTRIES = 700_000  # about 120 MB
LONG_STRETCH = 64  # longer stretches are encoded each time, not kept
GROUP_BYTES = 8_000_000  # texts handled at a time in a worker

# A special string may start, or a combining mark may join the letter before it.
_CAREFUL = re.compile(rb"<\||\xcc|\xcd")
# Lower-case ASCII and Latin-1 letters as UTF-8: one match of the split pattern.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")

_BYTES = np.arange(256, dtype=np.uint8)
IS_SPACE = np.isin(_BYTES, np.frombuffer(b" \t\n\v\f\r", np.uint8))
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_LETTER = (_BYTES >= 97) & (_BYTES <= 122)
_PUNCT = (_BYTES > 32) & (_BYTES < 127) & ~np.isin(_BYTES, np.frombuffer(b"'0123456789", np.uint8))
_PUNCT &= ~((_LOWER >= 97) & (_LOWER <= 122))

_LOADED: dict[str, "MemoTokenizer"] = {}


def memo_tokenizer(path: str = WORD_BPE) -> "MemoTokenizer":
    """The worker's tokenizer for ``path`` (one per Python process)."""
    if path not in _LOADED:
        _LOADED[path] = MemoTokenizer(path)
    return _LOADED[path]


def byte_view(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls count as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[off[0] : off[-1]] if len(off) else raw, off - off[0]


def byte_groups(offsets: np.ndarray, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes (a longer row makes a range of its own)."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


class MemoTokenizer:
    """Whole texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.memo: dict[bytes, bytes] = {}
        # Byte-level alphabet: printable bytes stand for themselves, the rest follow from 256 on.
        own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        others = [b for b in range(256) if b not in set(own)]
        self.alphabet = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.n_ids = max(self.tok.get_vocab(with_added_tokens=True).values()) + 1

    def encode_plain(self, texts: list[str]) -> list[bytes]:
        """Straight through the library."""
        if not texts:
            return []
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids_of(self, stretches: list[bytes]) -> list[bytes]:
        """Ids of each of some distinct stretches."""
        if len(self.memo) + len(stretches) // 4 > MEMO_ENTRIES:
            self.memo.clear()
        memo, tokenize, alphabet = self.memo, self.tok.model.tokenize, self.alphabet
        out = list(map(memo.get, stretches))
        rest: list[int] = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            b = stretches[i]
            if b.isalpha() and b.islower():
                ids = array("I", [t.id for t in tokenize(b.decode("ascii"))]).tobytes()
            elif _LETTERS.fullmatch(b):
                ids = array("I", [t.id for t in tokenize(b.decode("latin-1").translate(alphabet))]).tobytes()
            else:
                rest.append(i)
                continue
            out[i] = ids
            if len(b) <= LONG_STRETCH:
                memo[b] = ids
        for i, ids in zip(rest, self.encode_plain([stretches[i].decode("utf-8", "replace") for i in rest])):
            out[i] = ids
            if len(stretches[i]) <= LONG_STRETCH:
                memo[stretches[i]] = ids
        return out

    def encode(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets by text) of texts given as in ``byte_view``."""
        flat, at, _, by_text = self.stretches(raw, off)
        return flat, at[by_text]

    def stretches(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, ids before each stretch and in all, first byte of each stretch, stretches before each text and in all)."""
        low = _LOWER[raw]
        cut = np.zeros(len(raw), bool)
        np.logical_and(_LETTER[low[:-1]], _PUNCT[low[1:]], out=cut[1:])
        if _CAREFUL.search(raw):
            for lo, hi in zip(off[:-1].tolist(), off[1:].tolist()):
                if _CAREFUL.search(raw[lo:hi]):
                    low[lo:hi] = raw[lo:hi]
                    cut[lo:hi] = False
        space = IS_SPACE[raw]
        start = cut
        start[1:] |= space[:-1]
        start[off[:-1][off[:-1] < len(raw)]] = True
        start &= ~space
        firsts = np.flatnonzero(start)
        by_text = np.searchsorted(firsts, off)
        kept = low[~space]
        if not len(firsts):
            return np.empty(0, np.uint32), np.zeros(1, np.int64), firsts, by_text
        begins = np.append(np.flatnonzero(start[~space]), len(kept)).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(firsts), [None, pa.py_buffer(begins), pa.py_buffer(kept)])
        words = words.dictionary_encode()
        ids = pa.array(self._ids_of(words.dictionary.to_pylist()), pa.large_binary()).take(words.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset : ids.offset + len(ids) + 1]
        flat = np.frombuffer(ids.buffers()[2], "<u4")[ends[0] // 4 : ends[-1] // 4]
        return flat, (ends - ends[0]) // 4, firsts, by_text

    def encode_column(self, col: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(first row, end row, ids, offsets) for groups of rows of a string column."""
        raw, off = byte_view(col)
        for lo, hi in byte_groups(off):
            ids, ends = self.encode(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            yield lo, hi, ids, ends
