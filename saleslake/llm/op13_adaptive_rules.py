"""Quality rules with adaptive thresholds (operator 13).

1. Counts of every text, exact, in the scan (``rule_counts``).
2. A row that fails the base rules (too few words, or mostly repeated words)
   is out, and takes no part in the thresholds.
3. Of the others, four measures (symbols per word, repeated lines of all
   lines, repeated words of all words, characters per word) go to quantile
   sketches by language and source: logarithmic bins whose counts add up, so
   partial sketches of tasks, sources and languages merge in any order to the
   same sketch, and a quantile is within 1 % of the exact one.  The number of
   bins follows from the range of the measure (about 1,500), not from the
   rows; none is capped.
4. Thresholds are fences around the quartiles: outside the middle half by
   ``WIDE`` times its width (or a least width, where most texts are alike).
   A group of fewer than ``LEAST_ROWS`` rows uses the merged sketch of its
   language, one of few rows in all that of all rows.
5. The thresholds (a row for each language and source) are joined to the rows.

A hot source is added up before any shuffle, and the join's size decides
whether thresholds are sent to the rows; nothing is collected.

Null texts have no words; they fail the base rules.  A null language or
source is a group like any other.  Rows are independent but for thresholds:
repeated rows count as often as they stand there.  An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslake.llm.common import arrow_map, query, scratch, table, written
from saleslake.llm.tokens import IS_SPACE, byte_groups, byte_view
from saleslake.llm.words import Words

MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = b"#*$%&|<>"
WINDOW = 3
GAMMA = 1.02  # a bin holds values within this factor
SMALLEST = 1e-4  # values below count as zero
LEAST_ROWS = 200
WIDE = 3.0
# measure: (least width of the middle half, whether low values fail too)
MEASURES = {"symbols": (0.05, False), "repeated_lines": (0.15, False), "repeated_words": (0.15, False), "word_length": (0.35, True)}
GROUP_BYTES = 4_000_000

_IS_SYMBOL = np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(SYMBOLS, np.uint8))


def _per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[off[1:]] - sums[off[:-1]]


def repeated_lines(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By text: lines with a word, and how many of them equal an earlier one."""
    n = len(off) - 1
    breaks = raw == 10
    # every text ends a line, too; lines are numbered over all texts
    before = np.concatenate([[0], np.cumsum(breaks)]).astype(np.int64)
    by_text = before[off[1:]] - before[off[:-1]] + 1
    kept = raw[~breaks]
    places = np.flatnonzero(breaks)
    inner = places - np.arange(len(places))  # in ``kept``
    outer = off[1:] - before[off[1:]]
    # ends in order: those within a text before that of the text itself
    order = np.argsort(np.concatenate([np.searchsorted(off, places, "right") - 1, np.arange(n)]), kind="stable")
    ends = np.concatenate([inner, outer])[order].astype(np.int64)
    at = np.concatenate([[0], ends]).astype(np.int64)
    text = np.repeat(np.arange(n), by_text)
    full = _per_text(~IS_SPACE[kept], at) > 0
    lines = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(at), pa.py_buffer(kept)])
    ids = np.asarray(lines.dictionary_encode().indices, np.int64)
    key = (text * (len(ids) + 1) + ids)[full]
    n_lines = np.bincount(text[full], minlength=n)
    distinct = np.bincount(np.unique(key) // (len(ids) + 1), minlength=n)
    return n_lines.astype(np.int64), (n_lines - distinct).astype(np.int64)


def repeated_words(ids: np.ndarray, before: np.ndarray) -> np.ndarray:
    """By text: words within ``WINDOW`` words that the text holds more than once."""
    n = len(before) - 1
    text = np.repeat(np.arange(n), np.diff(before))
    at = np.flatnonzero(np.arange(len(ids)) + WINDOW <= before[1:][text])
    if not len(at):
        return np.zeros(n, np.int64)
    top = int(ids.max()) + 1
    key = text[at] * top + ids[at]
    for k in range(1, WINDOW):
        _, key, many = np.unique(key, return_inverse=True, return_counts=True)
        some = many[key] > 1  # only what repeats so far can repeat in whole
        at, key = at[some], key[some] * top + ids[at[some] + k]
    _, key, many = np.unique(key, return_inverse=True, return_counts=True)
    at = at[many[key] > 1]
    covered = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        covered[at + k] = True
    return _per_text(covered, before)


def rule_counts(df: DataFrame, key: str = "doc_id", text: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """key, the columns ``by``, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        raw, off = byte_view(batch.column(1))
        for lo, hi in byte_groups(off, GROUP_BYTES):
            own, at = raw[off[lo] : off[hi]], off[lo : hi + 1] - off[lo]
            words = Words(own, at)
            n_words = np.diff(words.before)
            lines, dup = repeated_lines(own, at)
            repeat = repeated_words(words.ids, words.before)
            chars = _per_text(~IS_SPACE[own] & ((own & 0xC0) != 0x80), at)
            failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEATED_PERCENT * n_words)
            cols = [n_words, chars, _per_text(_IS_SYMBOL[own], at), lines, dup, repeat, failed]
            rest = [batch.column(i).slice(lo, hi - lo) for i in (0, *range(2, batch.num_columns))]
            yield pa.record_batch(rest + [pa.array(c) for c in cols], names)

    names = ["key", *[f"by{i}" for i in range(len(by))], *counts, "base_failed"]
    kinds = [df.schema[c].dataType.simpleString() for c in (key, *by)]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, kinds)) + "".join(f", {c} long" for c in counts) + ", base_failed boolean"
    return arrow_map(df.select(key, text, *by), work, schema).withColumnsRenamed(dict(zip(names, (key, *by))))


# --- sketches ---------------------------------------------------------------------------


def measures() -> dict[str, Column]:
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {"symbols": ratio("n_symbols", "n_words"), "repeated_lines": ratio("n_dup_lines", "n_lines"),
            "repeated_words": ratio("n_repeat_words", "n_words"), "word_length": ratio("word_chars", "n_words")}


def bin_of(value: Column) -> Column:
    """The logarithmic bin of a value from 0; null for zero's own."""
    return F.when(value >= SMALLEST, F.ceil(F.log(value) / F.lit(math.log(GAMMA))))


def value_of(b: Column) -> Column:
    """The middle of a bin: within 1 % of each value in it."""
    return F.coalesce(F.lit(2.0) * F.pow(F.lit(GAMMA), b) / F.lit(GAMMA + 1), F.lit(0.0))


def sketches(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, measure, bin, n: partial sketches are added up in each task, then by group."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(v).cast("long").alias("bin")) for m, v in measures().items()]))
    return rows.select(*by, each.alias("m")).groupBy(*by, "m.measure", "m.bin").agg(F.count(F.lit(1)).alias("n"))


def merged(sketch: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketch.groupBy(*by, "measure", "bin").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, by: list[str]) -> DataFrame:
    """by, rows, and low_<measure>, high_<measure> of each group."""
    group = [*by, "measure"]
    # a window over the bins of one sketch
    upto = F.sum("n").over(Window.partitionBy(*group).orderBy(F.col("bin").asc_nulls_first()))
    total = F.sum("n").over(Window.partitionBy(*group))
    q = sketch.withColumns({"upto": upto, "total": total})
    at = lambda k: F.min(F.when(F.col("upto") * 4 >= F.col("total") * k, F.coalesce("bin", F.lit(-(1 << 40)))))
    value = lambda c: value_of(F.when(F.col(c) > -(1 << 40), F.col(c)))
    q = q.groupBy(*group).agg(F.max("total").alias("total"), at(1).alias("b1"), at(3).alias("b3"))
    q = q.select(*group, "total", value("b1").alias("q1"), value("b3").alias("q3"))
    least = F.create_map(*[F.lit(x) for m, (w, _) in MEASURES.items() for x in (m, w)])
    width = F.lit(WIDE) * F.greatest(F.col("q3") - F.col("q1"), least[F.col("measure")])
    q = q.select(*group, "total", (F.col("q1") - width).alias("low"), (F.col("q3") + width).alias("high"))
    one = lambda m, c: F.max(F.when(F.col("measure") == m, F.col(c))).alias(f"{c}_{m}")
    return q.groupBy(*by).agg(F.max("total").alias("rows"), *[one(m, c) for m in MEASURES for c in ("low", "high")])


def thresholds(counts: DataFrame, by: tuple[str, ...] = ("lang", "source"), least_rows: int = LEAST_ROWS) -> DataFrame:
    """The fences of every group of ``counts``, from the finest level (all of ``by``, fewer of them, none) that has rows enough."""
    spark = counts.sparkSession
    cols = [f"low_{m}" for m in MEASURES] + [f"high_{m}" for m in MEASURES]
    sketch = written(sketches(counts.where("NOT base_failed"), list(by)), scratch(spark, "rules-sketch"))
    out = counts.select(*by).distinct()
    levels = [fences(merged(sketch, list(by[:k])), list(by[:k])) for k in range(len(by), -1, -1)]
    for i, level in enumerate(levels):
        keys = list(by[: len(by) - i])
        last = i == len(levels) - 1
        own = F.struct(*cols) if last else F.when(F.col("rows") >= least_rows, F.struct(*cols))
        level = level.select(*[F.col(f"`{c}`").alias(f"_{j}") for j, c in enumerate(keys)], own.alias(f"f{i}"))
        same = F.lit(True)
        for j, c in enumerate(keys):
            same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"_{j}"))
        out = out.join(level, same, "left").drop(*[f"_{j}" for j in range(len(keys))])
    best = F.coalesce(*[F.col(f"f{i}") for i in range(len(levels))])
    return out.select(*by, best.alias("fence")).select(*by, "fence.*")


def adaptive_rules(df: DataFrame, key: str = "doc_id", text: str = "text", by: tuple[str, ...] = ("lang", "source"), least_rows: int = LEAST_ROWS) -> DataFrame:
    """``rule_counts`` and kept: rows that pass the base rules and lie within the fences of their group."""
    spark = df.sparkSession
    counts = rule_counts(df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), *[F.col(c).alias(f"_by{i}") for i, c in enumerate(by)]),
                         "_key", "_text", tuple(f"_by{i}" for i in range(len(by))))
    counts = written(counts, scratch(spark, "rules-counts"))
    own = tuple(f"_by{i}" for i in range(len(by)))
    fence = written(thresholds(counts, own, least_rows), scratch(spark, "rules-fences"))
    fence = fence.withColumnsRenamed({c: f"_f{i}" for i, c in enumerate(own)})
    same = F.lit(True)
    for i, c in enumerate(own):
        same = same & F.col(c).eqNullSafe(F.col(f"_f{i}"))
    rows = counts.join(fence, same, "left")
    ok = ~F.col("base_failed")
    for m, v in measures().items():
        ok = ok & (v <= F.col(f"high_{m}"))
        if MEASURES[m][1]:
            ok = ok & (v >= F.col(f"low_{m}"))
    rows = rows.withColumn("kept", F.coalesce(ok, F.lit(False))).drop(*[f"_f{i}" for i in range(len(by))])
    return rows.withColumnsRenamed({"_key": key, **dict(zip(own, by))})


@query("op13_adaptive_rules")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = adaptive_rules(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
