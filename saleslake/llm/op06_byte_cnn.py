"""Quality classifier: a byte-level convolutional network in numpy (operator 6).

The whole text is cut into overlapping chunks of ``CHUNK`` bytes.  In each
chunk learned filters run over embedded bytes (8 bytes wide, stride 4), and
learned filters over self-matches (does the byte equal the one ``lag`` bytes
before; shared by all lags, 32 bytes wide) catch repetition.  Every filter is
max-pooled over its chunk; the document's features are the largest and the
mean value over all its chunks, combined by a logistic layer into the
probability that ``quality`` is 1.

Training: gradient descent (Adam, fixed seed) on the driver, on a bounded
sample of labelled rows: at most ``TRAIN_ROWS`` of each label with whole texts
of up to ``TRAIN_TEXT`` bytes, those with the smallest hashes, one text a key
(the smallest, if a key repeats) and ``TRAIN_BYTES`` in all.  Rows whose
crc32(key as text) mod 5 is 0 never take part.  Only the text's bytes enter a
score.  Without labels of both kinds every score is the share of label 1 (0.5
if there are none), and ``learned`` is false.

Null texts count as empty; an empty text is scored by its (zero) features.
Null keys are not held out and not trained on.  Labels that are neither 0 nor
1 do not count; a key with several takes the smallest.  Repeated rows give
repeated results, an empty table an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslake.llm.common import arrow_map, query, table
from saleslake.llm.tokens import byte_groups, byte_view

CHUNK = 512
OVERLAP = 64
STRIDE = 4
WIDTH = 8
EMBED = 6
FILTERS = 24
LAGS = range(2, 25)
LAG_FILTERS = 2
LAG_BLOCKS = 8  # blocks of STRIDE bytes under a self-match filter
TRAIN_ROWS = 2500
TRAIN_TEXT = 65_536
TRAIN_BYTES = 64_000_000
STEPS = 500
BATCH = 32
THRESHOLD = 0.3


def chunks_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(chunks x CHUNK bytes, zero after a text's end; first chunk of each text); an empty text has one."""
    size = np.diff(off)
    count = np.maximum(1, -(-(size - OVERLAP) // (CHUNK - OVERLAP)))
    firsts = np.concatenate([[0], np.cumsum(count)])
    own = np.repeat(np.arange(len(size)), count)
    begin = off[own] + (np.arange(firsts[-1]) - firsts[own]) * (CHUNK - OVERLAP)
    at = begin[:, None] + np.arange(CHUNK)
    padded = np.append(raw, np.uint8(0))
    out = padded[np.minimum(at, len(raw))]
    out[at >= off[own + 1][:, None]] = 0
    return out, firsts


class ByteCnn:
    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        b = np.arange(256)
        kinds = [(b >= 65) & (b <= 90), (b >= 97) & (b <= 122), (b >= 48) & (b <= 57), (b == 32) | ((b >= 9) & (b <= 13)), (b > 32) & (b < 127) & ~np.isin(b, [*range(48, 58), *range(65, 91), *range(97, 123)]), b >= 128]
        self.embed = (np.array(kinds, np.float32).T + rng.normal(0, 0.3, (256, EMBED))).astype(np.float32)
        self.embed[0] = 0
        self.filters = rng.normal(0, 0.25, (WIDTH, EMBED, FILTERS)).astype(np.float32)
        self.bias = np.zeros(FILTERS, np.float32)
        self.lag_filters = np.abs(rng.normal(1 / LAG_BLOCKS, 0.2 / LAG_BLOCKS, (LAG_BLOCKS, LAG_FILTERS))).astype(np.float32)
        self.lag_bias = np.full(LAG_FILTERS, -0.4, np.float32)
        self.out = np.zeros(2 * (FILTERS + LAG_FILTERS), np.float32)
        self.shift = np.zeros(1, np.float32)
        self.learned = False

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.lag_filters, self.lag_bias, self.out, self.shift]

    def pooled(self, x: np.ndarray, places: bool = False):
        """Max-pooled filter values of each chunk; with ``places`` also where they were reached."""
        n, blocks = len(x), CHUNK // STRIDE
        flat = self.embed[x].reshape(n * blocks, STRIDE * EMBED)
        halves = np.concatenate([self.filters[:STRIDE].reshape(STRIDE * EMBED, -1), self.filters[STRIDE:].reshape(STRIDE * EMBED, -1)], 1)
        both = (flat @ halves).reshape(n, blocks, 2 * FILTERS)
        conv = both[:, :-1, :FILTERS] + both[:, 1:, FILTERS:]
        out = np.empty((n, FILTERS + LAG_FILTERS), np.float32)
        out[:, :FILTERS] = conv.max(1) + self.bias
        best = np.full((n, LAG_FILTERS), -np.inf, np.float32)
        where = np.zeros((n, LAG_FILTERS, 2), np.int64)
        spans = blocks - LAG_BLOCKS + 1
        for lag in LAGS:
            same = np.zeros((n, CHUNK), np.uint8)
            same[:, lag:] = (x[:, lag:] == x[:, :-lag]) & (x[:, lag:] > 0)
            counts = np.bitwise_count(same.view("<u4")).astype(np.float32) / STRIDE
            for f in range(LAG_FILTERS):
                value = sum(counts[:, k : k + spans] * self.lag_filters[k, f] for k in range(LAG_BLOCKS))
                top = value.max(1)
                if places:
                    more = top > best[:, f]
                    where[more, f, 0], where[more, f, 1] = lag, value.argmax(1)[more]
                best[:, f] = np.maximum(best[:, f], top)
        out[:, FILTERS:] = best + self.lag_bias
        np.maximum(out, 0, out=out)
        return (out, conv.argmax(1), where) if places else out

    def features(self, pooled: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Largest and mean value over the chunks of each text."""
        return np.concatenate([np.maximum.reduceat(pooled, firsts[:-1]), np.add.reduceat(pooled, firsts[:-1]) / np.diff(firsts)[:, None]], 1)

    def score(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        out = np.empty(len(off) - 1)
        for lo, hi in byte_groups(off, 1_000_000):
            x, firsts = chunks_of(raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo])
            pooled = np.concatenate([self.pooled(x[i : i + 512]) for i in range(0, len(x), 512)])
            out[lo:hi] = 1 / (1 + np.exp(-(self.features(pooled, firsts) @ self.out + self.shift[0]).astype(np.float64)))
        return out

    def gradients(self, raw: np.ndarray, off: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        x, firsts = chunks_of(raw, off)
        slices = [self.pooled(x[i : i + 512], places=True) for i in range(0, len(x), 512)]  # bounds the driver's memory
        pooled, at, where = (np.concatenate(part) for part in zip(*slices))
        z = self.features(pooled, firsts)
        p = 1 / (1 + np.exp(-(z @ self.out + self.shift[0])))
        d = ((p - y) / len(y)).astype(np.float32)
        half = FILTERS + LAG_FILTERS
        count = np.diff(firsts)
        own = np.repeat(np.arange(len(y)), count)
        d_pool = (d[:, None] * self.out[half:] / count[:, None])[own]
        top = pooled >= z[own, :half]
        d_pool += np.where(top, (d[:, None] * self.out[:half] / np.add.reduceat(top, firsts[:-1], dtype=np.int64))[own], 0)  # equal chunks share
        d_pool[pooled <= 0] = 0
        dc = d_pool[:, :FILTERS]
        span = (at * STRIDE)[:, :, None] + np.arange(WIDTH)
        patch = x[np.arange(len(x))[:, None, None], span]
        seen = self.embed[patch]  # chunk, filter, byte, embedding
        d_filters = np.einsum("cf,cfke->kef", dc, seen, optimize=True)
        d_embed = np.zeros_like(self.embed)
        np.add.at(d_embed, patch, dc[:, :, None, None] * self.filters.transpose(2, 0, 1)[None])
        d_embed[0] = 0
        d_lag = np.zeros_like(self.lag_filters)
        for f in range(LAG_FILTERS):
            lag, block = where[:, f, 0], where[:, f, 1]
            i = block[:, None] * STRIDE + np.arange(LAG_BLOCKS * STRIDE)
            j = i - lag[:, None]
            rows = np.arange(len(x))[:, None]
            same = (j >= 0) & (x[rows, i] == x[rows, np.maximum(j, 0)]) & (x[rows, i] > 0)
            d_lag[:, f] = d_pool[:, FILTERS + f] @ same.reshape(len(x), LAG_BLOCKS, STRIDE).mean(2)
        return [d_embed, d_filters, dc.sum(0), d_lag, d_pool[:, FILTERS:].sum(0), z.T @ d, np.array([d.sum()], np.float32)]

    def fit(self, texts: list[bytes], labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.02, seed: int = 11, odds: float = 1.0) -> "ByteCnn":
        """Batches are balanced; ``odds`` of label 1 in the population then shift the result."""
        rng = np.random.default_rng(seed)
        kinds = [np.flatnonzero(labels == k) for k in (0, 1)]
        if not len(kinds[0]) or not len(kinds[1]):
            self.out[:] = 0
            share = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-6, 1 - 1e-6))
            self.shift[0] = np.log(share / (1 - share))
            return self
        self.learned = True
        first, second = [[np.zeros_like(p, np.float64) for p in self.parts()] for _ in range(2)]
        for t in range(1, steps + 1):
            pick = np.concatenate([rng.choice(k, batch // 2) for k in kinds])
            data = [texts[i] for i in pick]
            raw, off = np.frombuffer(b"".join(data), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in data])])
            for p, g, m, v in zip(self.parts(), self.gradients(raw, off, labels[pick].astype(np.float32)), first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * min(1, 2 - 2 * t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
        self.shift[0] += np.log(odds)
        return self


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS, longest: int = TRAIN_TEXT, steps: int = STEPS, most: int = TRAIN_BYTES) -> ByteCnn:
    """Fit on at most ``rows`` documents of each label that are not held out."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & F.col("key").isNotNull())
    known = known.groupBy("key").agg(F.min("y").alias("y")).filter(~held_out(F.col("key"))).withColumn("h", F.xxhash64("key"))
    counts = {y: n for y, n in known.groupBy("y").count().collect()}  # two rows at most
    sample = known.filter("y = 0").orderBy("h", "key").limit(rows).union(known.filter("y = 1").orderBy("h", "key").limit(rows))
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter(F.octet_length("text") <= longest)
    # at most 2 * rows keys: a bounded broadcast, so the documents aren't shuffled; then one text a key, so that none pushes out others
    found = texts.join(F.broadcast(sample), "key").groupBy("h", "key", "y").agg(F.min("text").alias("text"))
    found = found.withColumn("so_far", F.sum(F.octet_length("text")).over(Window.orderBy("h", "key"))).filter(F.col("so_far") <= most)
    found = found.orderBy("h", "key").select("text", "y").toPandas()
    return ByteCnn().fit([t.encode() for t in found["text"]], found["y"].to_numpy(np.int64), steps, odds=(counts.get(1, 0) + 1) / (counts.get(0, 0) + 1))


def quality_scores(docs: DataFrame, model: ByteCnn, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """key, held_out, score, predicted of every row; with ``keep`` (row, score, predicted), row holding all columns."""

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, off = byte_view(batch.column(1))
        yield pa.record_batch([batch.column(0), pa.array(model.score(raw, off))], ["key", "score"])

    first = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if keep else F.col(key)
    rows = docs.select(first.alias("key"), F.col(text).alias("text"))
    out = arrow_map(rows, run, f"key {rows.schema['key'].dataType.simpleString()}, score double")
    out = out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    if keep:
        return out.withColumnRenamed("key", "row")
    return out.select(F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "score", "predicted")


@query("op6_byte_cnn_quality")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, train(docs, table(spark, sf_dir, "labels")))
