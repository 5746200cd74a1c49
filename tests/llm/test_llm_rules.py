"""Operator 13: counts against brute force, sketches against exact quantiles, verdicts against a plain version."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from saleslake.llm import op13_adaptive_rules as rules
from saleslake.llm.queries import QUERIES

from tests.conftest import SF_SMALL
from tests.llm.conftest import odd_rows

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    seen, lines, dup = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(3)}
    n, r = len(words), len(covered)
    return n, sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), lines, dup, r, n < 50 or 100 * r > 50 * n


def bin_of(v):
    return math.ceil(math.log(v) / math.log(rules.GAMMA)) if v >= rules.SMALLEST else None


def verdicts(rows, least_rows):
    """key -> kept, of (key, text, lang, source) rows."""
    measured = {}
    groups = defaultdict(lambda: defaultdict(list))
    for key, text, lang, source in rows:
        n, chars, symbols, lines, dup, repeat, failed = brute(text)
        m = {"symbols": symbols / max(n, 1), "repeated_lines": dup / max(lines, 1), "repeated_words": repeat / max(n, 1), "word_length": chars / max(n, 1)}
        measured[key] = (m, failed, lang, source)
        if not failed:
            for level in ((lang, source), (lang,), ()):
                for k, v in m.items():
                    groups[level][k].append(v)
    out = {}
    for key, (m, failed, lang, source) in measured.items():
        ok = not failed
        level = next((g for g in ((lang, source), (lang,)) if g in groups and len(groups[g]["symbols"]) >= least_rows), ())
        for k, v in m.items() if ok else ():
            bins = sorted((b is not None, b or 0) for b in map(bin_of, groups[level][k]))
            pick = lambda q: bins[math.ceil(q * len(bins) / 4) - 1]  # noqa: B023, E731
            q1, q3 = (2 * rules.GAMMA ** b / (rules.GAMMA + 1) if some else 0.0 for some, b in (pick(1), pick(3)))
            width = rules.WIDE * max(q3 - q1, rules.MEASURES[k][0])
            ok = ok and v <= q3 + width and (not rules.MEASURES[k][1] or v >= q1 - width)
        out[key] = ok
    return out


def test_query(spark):
    got = QUERIES["op13_adaptive_rules"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
    kept = verdicts(rows, rules.LEAST_ROWS)
    want = {k: (*b[:3], *b[4:], kept[k]) for k, t, _, _ in rows for b in [brute(t)]}
    assert {r[0]: tuple(r[1:]) for r in got.collect()} == want


@pytest.mark.parametrize("least_rows", [1, 20, 60])
def test_groups_of_several_sizes(spark, least_rows):
    sf = SF_SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 7 > 0, F.col("lang")))
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    got = {r.doc_id: r.kept for r in rules.adaptive_rules(docs, least_rows=least_rows).collect()}
    assert got == verdicts(rows, least_rows)


def test_labels(spark):
    """Good texts stay, and a good part of the bad ones that pass the base rules go."""
    sf = SF_SMALL.replace("0.001", "0.1")
    rows = rules.adaptive_rules(spark.read.parquet(f"{sf}/documents.parquet")).where("NOT base_failed")
    rows = rows.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = dict(map(tuple, rows))
    assert share[1] > 0.995 and share[0] < 0.25


def test_sketches_merge_to_quantiles(spark):
    rng = np.random.default_rng(4)
    values = np.concatenate([rng.lognormal(1, 2, 5_000), [0.0] * 300, [1.0] * 50])
    df = spark.createDataFrame([(i % 3, float(v)) for i, v in enumerate(values)], "g int, v double")
    parts = df.select("g", rules.bin_of(F.col("v")).alias("bin")).groupBy("g", "bin").agg(F.count("*").alias("n")).withColumn("measure", F.lit("symbols"))
    whole = {r.bin: r.n for r in rules.merged(parts, []).collect()}
    assert sum(whole.values()) == len(values) and whole[None] == (values < rules.SMALLEST).sum()
    got = rules.fences(rules.merged(parts, []), []).first()
    q1, q3 = np.sort(values)[[math.ceil(len(values) * q / 4) - 1 for q in (1, 3)]]
    width = rules.WIDE * (q3 - q1)
    assert got.rows == len(values)
    assert got.high_symbols == pytest.approx(q3 + width, rel=0.012)
    assert got.low_symbols == pytest.approx(q1 - width, rel=0.012)


def test_odd_rows(spark, odd, none):
    got = rules.adaptive_rules(odd)
    counts = [c for c in rules.rule_counts(odd).columns if c not in ("doc_id", "lang", "source")]
    assert sorted((str(r.doc_id), *[r[c] for c in counts]) for r in got.collect()) == sorted((str(k), *brute(t)) for k, t in odd_rows())
    assert rules.adaptive_rules(none).collect() == []
    bare = odd.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), "source")
    assert {r.kept for r in rules.adaptive_rules(bare).where("base_failed").collect()} == {False}
