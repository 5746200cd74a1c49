"""The words of some texts as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from saleslake.llm.op05_simhash_tiles import word_places
from saleslake.llm.tokens import IS_SPACE


class Words:
    """Stretches between ASCII white space of texts given as in ``byte_view``; equal words have equal ids."""

    def __init__(self, raw: np.ndarray, off: np.ndarray):
        begins, ends, self.before = word_places(raw, off)
        self.before = self.before.astype(np.int64)
        self.size = (ends - begins).astype(np.int64)
        self.kept = raw[~IS_SPACE[raw]]
        at = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(self.size), [None, pa.py_buffer(at), pa.py_buffer(self.kept)])
        self.ids = np.asarray(words.dictionary_encode().indices, np.int64) if len(words) else np.empty(0, np.int64)

    def joined(self) -> tuple[bytes, np.ndarray]:
        """All words, each followed by a space, and the place of each (and of the end)."""
        n = len(self.size)
        out = np.full(len(self.kept) + n, 32, np.uint8)
        out[np.arange(len(self.kept)) + np.repeat(np.arange(n), self.size)] = self.kept
        return out.tobytes(), np.concatenate([[0], np.cumsum(self.size + 1)]).astype(np.int64)
