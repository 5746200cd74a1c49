"""Operators 1, 4, 9 and 10 against the tokenizer libraries on whole texts."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from saleslake.llm import op01_rans as rans
from saleslake.llm.op04_pack import TierPacker, pack
from saleslake.llm.op09_segment_bpe import RANKS, bpe_digests, load_ranks, merged
from saleslake.llm import op10_resync_counts as resync
from saleslake.llm.op10_resync_counts import count_by_chunks, token_counts
from saleslake.llm.tokens import WORD_BPE, memo_tokenizer

from tests.conftest import SF_SMALL
from tests.llm.conftest import odd_rows


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(WORD_BPE)
    return lambda text: tok.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_memo_equals_library(library):
    texts = [t for _, t in odd_rows()] + ["a<|b A<|endoftext|>", "ß. é! \x85 ​ z\x0b,q", "İstanbul ΑΣ, Ǆ", "日本語, test🙂."]
    for lo, hi, ids, ends in memo_tokenizer().encode_column(pa.array(texts)):
        for i in range(lo, hi):
            assert ids[ends[i - lo] : ends[i - lo + 1]].tolist() == library(texts[i]), texts[i]


def test_rans_round_trip_and_stretches():
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.3, 70_000) % 49_409).astype(np.uint32)
    symbols, counts = np.unique(ids, return_counts=True)
    freq = rans.FrequencyTable.of_counts(symbols.astype(np.int64), counts)
    assert int(freq.freq.sum()) == 1 << rans.SCALE_BITS and freq.freq.min() >= 1
    for n in (1, 63, 64, 5000, 70_000):
        payload = rans.encode_block(ids[:n], np.zeros((1, 5), np.int64), freq, lanes=64, checkpoint=16)
        block = rans.Block(payload, freq)
        assert np.array_equal(block.ids(), ids[:n])
        k = len(block.places) - 1  # the last stretch alone, without those before it
        assert np.array_equal(block.stretch(k), ids[k * 16 * block.lanes : n])
    damaged = bytearray(payload)
    damaged[200] ^= 1
    with pytest.raises(ValueError):
        rans.Block(bytes(damaged), freq)
    skewed = rans.FrequencyTable.of_counts(np.arange(3), np.array([10**12, 1, 1]))
    assert int(skewed.freq.sum()) == 1 << rans.SCALE_BITS and skewed.freq.min() >= 1


def test_joined_crc32():
    a, b = b"hello" * 9, b"abc" * 77
    assert rans.joined_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_rans_files(spark, odd, none, tmp_path, library):
    path = str(tmp_path / "ids")
    rans.write_ids(odd, path, block=4096, lanes=64, checkpoint=16)  # long documents span several blocks
    got = rans.ids_digest(spark, path).orderBy("start").collect()
    want = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [i for i, _ in want]
    start = 0
    by_id = defaultdict(list)
    for i, t in want:
        by_id[i].append(crc(library(t) + [2]))
    for r in got:
        assert r.start == start and r.ids_crc32 in by_id[r.doc_id]
        start += r.n_tokens
    assert start == sum(len(library(t)) + 1 for _, t in want)
    rans.write_ids(none, str(tmp_path / "none"))
    assert rans.ids_digest(spark, str(tmp_path / "none")).count() == 0


def test_packing(odd, none, library):
    rows = pack(odd).withColumn("crc", F.crc32("ids")).drop("ids").collect()
    assert pack(none).count() == 0
    sequences, tokens = defaultdict(list), Counter()
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        tokens[r.doc_id] += r.length
    want = Counter()
    for i, t in odd_rows():
        want[i] += len(library(t)) + 1
    assert tokens == want
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048 and at & (at - 1) == 0  # no padding at all
    one = {i: library(t) + [1] for i, t in odd_rows() if i not in (7, None)}
    for r in rows:
        if r.doc_id in one:
            assert r.crc == crc(one[r.doc_id][r.start : r.start + r.length]) and r.doc_tokens == len(one[r.doc_id])


def test_packer_keeps_every_token_once():
    rng = np.random.default_rng(3)
    lengths = [int(x) for x in rng.integers(1, 250, 5000)] + [2047, 2048, 2049, 9000]
    packer, seen = TierPacker(), Counter()
    windows = [w for i, n in enumerate(lengths) for w in packer.add(i, n)] + list(packer.pack())
    for size, pieces in windows:
        assert sum(n for _, _, n in pieces) == size
        for doc, start, n in pieces:
            seen.update((doc, x) for x in range(start, start + n))
    assert len(seen) == sum(lengths) and set(seen.values()) == {1}


def test_segment_tree_equals_tiktoken(odd, none):
    ranks = load_ranks(RANKS)
    ref = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    for piece in (b"hello", b" world" * 40, b"ab" * 500, "日本語🙂".encode() * 30, b"\xff\xfe"):
        assert merged(piece, ranks) == ref._encode_single_piece(piece)
    want = Counter()
    for i, t in odd_rows():
        ids = np.array(ref.encode_ordinary(t or ""), "<u4")
        want[(i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in bpe_digests(odd).collect()) == want
    assert bpe_digests(none).count() == 0


def test_resynchronised_counts(odd, none, library):
    got = Counter(tuple(r)[:4] for r in token_counts(odd, chunk_bytes=4096, overlap=64).collect())
    want = Counter((i, len((t or "").encode()), len(library(t)), len(library(t)) > 2048) for i, t in odd_rows())
    assert got == want
    assert token_counts(none).count() == 0


@pytest.mark.parametrize("text", ["x" * 5000, "ab1'c,d" * 900, "it's 12 <|endoftext|>" * 300, "é" * 3000, "word " * 2000, "日本語" * 900 + " a" * 900, "!?" * 2000 + "letters" * 300])
def test_overlaps_widen_until_they_align(text):
    tok = memo_tokenizer().tok
    for chunk, overlap in ((300, 16), (1000, 8), (64, 64)):
        assert count_by_chunks(tok, text, chunk, overlap)[0] == len(tok.encode(text, add_special_tokens=False).ids)


def test_registered_counts_are_spliced(spark):
    """Over a hundred of the given documents are spliced; every count is the library's."""
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in resync.token_counts(docs).collect()}
    tok = memo_tokenizer().tok
    rows = docs.collect()
    assert sum(r.chunks > 1 for r in got.values()) > 100
    assert [r.doc_id for r in rows if got[r.doc_id].n_tokens != len(tok.encode(r.text or "", add_special_tokens=False).ids)] == []


def test_small_chunks_and_odd_texts():
    memo = memo_tokenizer()
    texts = [t or "" for _, t in odd_rows()] + ["Don't stop-me now; " * 300, "é" * 3_000 + " x", "a" * 500 + "!" + "b" * 700, "x <|endoftext|> y " * 90, "é å " * 200, "你好 " * 400]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(t) for t in raw])])
    for chunk, overlap in ((64, 24), (200, 60), (1000, 100)):
        n, chunks = resync.spliced(memo, np.frombuffer(b"".join(raw), np.uint8), off, chunk, overlap)
        done = 0
        for t, k, c in zip(texts, n.tolist(), chunks.tolist()):
            want = len(memo.tok.encode(t, add_special_tokens=False).ids)
            assert k in (-1, want)
            if k < 0:
                assert c > 1 and resync.count_by_chunks(memo.tok, t, chunk, overlap)[0] == want
            done += c > 1 and k >= 0
        assert done >= 4
