"""All queries of this package (importing the modules registers them)."""

from __future__ import annotations

from saleslake.llm import op01_rans, op02_cover_tree, op03_difference_cover, op04_pack, op05_simhash_tiles, op06_byte_cnn, op07_pii_surrogates, op08_grace_dedup, op09_segment_bpe, op10_resync_counts, op11_splitter_trie, op12_basic_factors, op13_adaptive_rules  # noqa: F401
from saleslake.llm.common import ORACLE, QUERIES  # noqa: F401
