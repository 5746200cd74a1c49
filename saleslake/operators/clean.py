"""Cleaning: all-string columns -> declared types, NULL on failure, thresholded.

C1 integers, C2 doubles, C3 dates (first format with <= 10 % failures),
C4 soft conversion, C5 whole-table clean, C6 policy gate.  Conversions are
built-in expressions guarded by a regex, so Spark never raises inside a
task and the same rule can be written in any SQL engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.functions.scalar import strip

# --- fixed values -------------------------------------------------------------
INT_PATTERN = r"^[+-]?[0-9]+$"
# The same for a text that has nothing to strip.
BARE_INT_PATTERN = r"\A[+-]?[0-9]+\z"
# A text of visible ASCII only: nothing to strip (a test that costs a third of the strip).
BARE_PATTERN = r"^[!-~]+\z"
NUM_PATTERN = r"^[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?$"
# Date formats tried in this order: (label in strftime form, Spark pattern).
# As with strptime, days, months and times may be written without a leading zero.
DATE_FORMATS = (
    ("%Y-%m-%d", "yyyy-M-d"),
    ("%d/%m/%Y", "d/M/yyyy"),
    ("%m/%d/%Y", "M/d/yyyy"),
    ("%Y%m%d", "yyyyMMdd"),
    ("%Y-%m-%d %H:%M:%S", "yyyy-M-d H:m:s"),
)
SOFT_DATE_FORMATS = DATE_FORMATS[:4]   # the soft path never tries date + time
# ------------------------------------------------------------------------------


class ConversionError(ValueError):
    """Raised when a column fails the conversion limit or has no date format."""


def int_of(s: Column, large: bool = False) -> Column:
    """C1 for stripped text: integers only (a blank is none); out-of-range -> NULL."""
    return F.when(s.rlike(INT_PATTERN), s.try_cast("decimal(38,0)" if large else "bigint"))


def double_of(s: Column) -> Column:
    """C2 for stripped text: decimal/scientific numbers only."""
    return F.when(s.rlike(NUM_PATTERN), s.try_cast("double"))


def decimal_of(s: Column, dtype) -> Column:
    """C2 for exact types: the text goes straight to the declared decimal, digits and all."""
    return F.when(s.rlike(NUM_PATTERN), s.try_cast(dtype))


def int_like(c: Column) -> Column:
    """C1, as ``int_of`` for the stripped text: what is an integer as it stands is neither stripped nor matched again."""
    return F.when(c.rlike(BARE_INT_PATTERN), c.try_cast("bigint")).otherwise(int_of(strip(c)))


def is_double(c: Column) -> Column:
    """Whether ``double_of`` has a value for the stripped text: it has one for every text of the pattern.

    What matches before the strip, matches after it: ``$`` passes over line
    ends only, and they are white space.
    """
    return c.rlike(NUM_PATTERN) | strip(c).rlike(NUM_PATTERN)


def to_int(c: Column, large: bool = False) -> Column:
    """Strip, blank -> NULL, integer text only; out-of-range -> NULL."""
    return int_of(strip(c), large)


def to_double(c: Column) -> Column:
    """Strip, blank -> NULL, decimal/scientific text only."""
    return double_of(strip(c))


def to_decimal(c: Column, dtype) -> Column:
    """C2 for exact types, with the strip."""
    return decimal_of(strip(c), dtype)


def stripped(df: DataFrame, texts: dict[str, Column], keep: list[Column]) -> DataFrame:
    """``keep`` and the stripped texts, by name.

    A projection of its own: what is made from a stripped text uses it more
    than once, so the optimizer leaves the projection in place and every text
    is made and stripped once.  Texts without anything to strip are passed on.
    """
    texts = {n: c.cast("string") for n, c in texts.items()}
    return df.select(*keep, *[F.when(c.rlike(BARE_PATTERN), c).otherwise(strip(c)).alias(n) for n, c in texts.items()])


def shape_regex(pattern: str) -> str:
    """A loose regex that every string the datetime ``pattern`` can parse matches.

    Used as a guard so that obvious non-dates never reach the parser (a failed
    parse costs an exception on the JVM; a regex miss does not).
    """
    out, i = "^", 0
    while i < len(pattern):
        ch = pattern[i]
        j = i
        while j < len(pattern) and pattern[j] == ch:
            j += 1
        run = j - i
        if ch == "y":
            out += r"\d{%d,}" % run
        elif ch.isalpha():
            out += r"\d{1,%d}" % max(run, 2)
        else:
            out += "\\" + ch if not ch.isalnum() else ch
        i = j
    return out + "$"


def to_date(c: Column, pattern: str, with_time: bool = False) -> Column:
    """C3 for one format.  No strip, as in the reference: blanks fail."""
    parsed = (F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz") if with_time
              else F.try_to_date(c, pattern))
    return F.when(c.rlike(shape_regex(pattern)), parsed)


def failed(raw: Column, converted: Column) -> Column:
    """Aggregate: values that were not NULL before and are NULL after."""
    return F.count_if(raw.isNotNull() & converted.isNull())


def over_limit(failures: Column, total: Column) -> Column:
    """More than 10 % of all rows failed (integer arithmetic, no float edge)."""
    return failures * 10 > total


def first_fitting(values: list[Column], fail_counts: list[Column], total: Column) -> Column:
    """The value of the first format with failures <= 10 % of rows, else NULL."""
    return F.coalesce(*[F.when(f * 10 <= total, v) for f, v in zip(fail_counts, values)])


def converted_date(raw: Column, choice: int, with_time: bool = False, formats=DATE_FORMATS) -> Column:
    return to_date(raw, formats[choice][1], with_time)


def failure_rates(df: DataFrame, int_cols=(), double_cols=(), date_cols=()) -> DataFrame:
    """One aggregation pass -> one row per column with n, nulls, failures, rate.

    Date columns report the failures of their chosen format (C3); when none
    fits, every value that is not NULL has failed (as in ``profile``).
    """
    raw = lambda c: F.col(f"`{c}`")
    numbers = {**{f"_i{i}": raw(c) for i, c in enumerate(int_cols)}, **{f"_d{i}": raw(c) for i, c in enumerate(double_cols)}}
    df = stripped(df, numbers, [raw(c).alias(f"_t{i}") for i, c in enumerate(date_cols)])
    aggs = [F.count(F.lit(1)).alias("n")]
    for kind, cols, conv in (("i", int_cols, int_of), ("d", double_cols, double_of)):
        for i, _ in enumerate(cols):
            s = F.col(f"_{kind}{i}")
            aggs += [F.count_if(s.isNull()).alias(f"z{i}_{kind}"), failed(s, conv(s)).alias(f"f{i}_{kind}")]
    for i, _ in enumerate(date_cols):
        t = F.col(f"_t{i}")
        aggs.append(F.count_if(t.isNull()).alias(f"z{i}_t"))
        aggs += [failed(t, to_date(t, p)).alias(f"f{i}_t{k}") for k, (_, p) in enumerate(DATE_FORMATS)]
    one = df.agg(*aggs)
    structs = []
    for i, c in enumerate(int_cols):
        structs.append(_rate_struct(c, "INTEGER", F.col(f"z{i}_i"), F.col(f"f{i}_i"), F.lit(None).cast("string")))
    for i, c in enumerate(double_cols):
        structs.append(_rate_struct(c, "DOUBLE", F.col(f"z{i}_d"), F.col(f"f{i}_d"), F.lit(None).cast("string")))
    for i, c in enumerate(date_cols):
        fails = [F.col(f"f{i}_t{k}") for k in range(len(DATE_FORMATS))]
        fmt = first_fitting([F.lit(lbl) for lbl, _ in DATE_FORMATS], fails, F.col("n"))
        chosen_fail = F.coalesce(first_fitting(fails, fails, F.col("n")), F.col("n") - F.col(f"z{i}_t"))
        structs.append(_rate_struct(c, "DATE", F.col(f"z{i}_t"), chosen_fail, fmt))
    rows = one.select(F.col("n"), F.inline(F.array(*structs)))
    return rows.select(
        "column_name", "target", "n", "nulls", "failed", "date_format",
        (F.col("failed").cast("double") * 100.0 / F.col("n").cast("double")).alias("failed_pct"),
        over_limit(F.col("failed"), F.col("n")).alias("over_limit"),
    )


def _rate_struct(name: str, target: str, nulls: Column, fails: Column, fmt: Column) -> Column:
    return F.struct(
        F.lit(name).alias("column_name"), F.lit(target).alias("target"),
        nulls.alias("nulls"), fails.alias("failed"), fmt.alias("date_format"),
    )


def soft_convert_plan(df: DataFrame, int_cols=(), double_cols=(), date_cols=()) -> DataFrame:
    """C4: per column, convert or keep as string.

    Numbers convert only when no new NULL appears; dates take the first of
    four formats with <= 10 % failures, else stay strings.
    """
    n = F.count(F.lit(1))
    aggs = [n.alias("n")]
    for i, c in enumerate(int_cols):
        aggs.append(failed(F.col(c), to_int(F.col(c))).alias(f"i{i}"))
    for i, c in enumerate(double_cols):
        aggs.append(failed(F.col(c), to_double(F.col(c))).alias(f"d{i}"))
    for i, c in enumerate(date_cols):
        aggs += [failed(F.col(c), to_date(F.col(c), p)).alias(f"t{i}_{k}") for k, (_, p) in enumerate(SOFT_DATE_FORMATS)]
    one = df.agg(*aggs)
    structs = []
    for i, c in enumerate(int_cols):
        f = F.col(f"i{i}")
        structs.append(_soft_struct(c, "INTEGER", f, F.when(f == 0, "converted").otherwise("kept_string"), F.lit(None).cast("string")))
    for i, c in enumerate(double_cols):
        f = F.col(f"d{i}")
        structs.append(_soft_struct(c, "DOUBLE", f, F.when(f == 0, "converted").otherwise("kept_string"), F.lit(None).cast("string")))
    for i, c in enumerate(date_cols):
        fails = [F.col(f"t{i}_{k}") for k in range(len(SOFT_DATE_FORMATS))]
        fmt = first_fitting([F.lit(lbl) for lbl, _ in SOFT_DATE_FORMATS], fails, F.col("n"))
        f = first_fitting(fails, fails, F.col("n"))
        structs.append(_soft_struct(c, "DATE", f, F.when(fmt.isNotNull(), "converted").otherwise("kept_string"), fmt))
    return one.select(F.inline(F.array(*structs)))


def soft_convert(df: DataFrame, int_cols=(), double_cols=(), date_cols=()) -> DataFrame:
    """C4 applied: each column converted, or kept as text, as ``soft_convert_plan`` decides (one row a column is collected)."""
    cols = {}
    for r in soft_convert_plan(df, int_cols, double_cols, date_cols).collect():
        c = F.col(f"`{r['column_name']}`")
        if r["outcome"] != "converted":
            continue
        if r["target"] == "DATE":
            cols[r["column_name"]] = to_date(c, dict(SOFT_DATE_FORMATS)[r["date_format"]])
        else:
            cols[r["column_name"]] = to_int(c) if r["target"] == "INTEGER" else to_double(c)
    return df.select(*[cols.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def _soft_struct(name, target, fails, outcome, fmt) -> Column:
    return F.struct(
        F.lit(name).alias("column_name"), F.lit(target).alias("target"), fails.alias("failed"),
        outcome.alias("outcome"), fmt.alias("date_format"),
    )


def choose_date_formats(df: DataFrame, cols, formats=DATE_FORMATS) -> dict[str, tuple[str, str] | None]:
    """C3 decision: one aggregation, then the first format per column within the limit.

    Collects one row of ``len(cols) * len(formats)`` counts to the driver.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        aggs += [failed(F.col(c), to_date(F.col(c), p)).alias(f"f{i}_{k}") for k, (_, p) in enumerate(formats)]
    row = df.agg(*aggs).first()
    out: dict[str, tuple[str, str] | None] = {}
    for i, c in enumerate(cols):
        out[c] = next((formats[k] for k in range(len(formats)) if row[f"f{i}_{k}"] * 10 <= row["n"]), None)
    return out
