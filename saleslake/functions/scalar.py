"""Scalar column functions (X1, X5-X7, X9-X11).  All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------
# Whitespace removed by a Python-style strip(): ASCII whitespace, the
# information separators 0x1C-0x1F, NEL and every Unicode separator.
WS_CHARS = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# E-mail -> path id replacements, applied in this order after strip + lower.
EMAIL_REPLACEMENTS = (("@", "_at_"), (".", "_dot_"), ("-", "_"), (" ", "_"))
# Anything that is not a letter, a digit or "_" is dropped from a path id.
NOT_ID_CHAR = r"[^\p{L}\p{N}_]"
# ------------------------------------------------------------------------------


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace (Unicode-aware, no regex)."""
    return F.btrim(c, F.lit(WS_CHARS))


def blank_to_null(c: Column) -> Column:
    """Strip, then ``""`` -> NULL."""
    return F.nullif(strip(c), F.lit(""))


def email_path_id(c: Column) -> Column:
    """E-mail -> path id.  NULL or blank gives ``""``."""
    s = F.lower(strip(c))
    for old, new in EMAIL_REPLACEMENTS:
        s = F.replace(s, F.lit(old), F.lit(new))
    return F.coalesce(F.regexp_replace(s, NOT_ID_CHAR, ""), F.lit(""))


def varchar_limit(type_text: Column) -> Column:
    """``VARCHAR(n)`` -> n, else NULL."""
    n = F.regexp_extract(F.upper(type_text), r"VARCHAR\((\d+)\)", 1)
    return F.when(n != "", n.cast("int"))


def base_type(type_text: Column) -> Column:
    """Text before ``(``, upper-case, trimmed."""
    return F.upper(F.trim(F.split_part(type_text, F.lit("("), F.lit(1))))


def char_length(c: Column) -> Column:
    """Character count of the value as text."""
    return F.length(c.cast("string"))


def _half_up_div(n: Column, d: int) -> Column:
    """round(n / d) half-up for non-negative integer n, in integer arithmetic."""
    num = n * 2 + F.lit(d)
    # (num - num % m) / m is exact in double for counts below 2^53.
    return ((num - num % F.lit(2 * d)) / F.lit(2 * d)).cast("long")


def _fixed(units: Column, decimals: int) -> Column:
    """Render an integer count of 10^-decimals units as ``a.b``."""
    scale = 10**decimals
    whole = F.floor(units / F.lit(scale)).cast("long")
    frac = F.lpad((units % F.lit(scale)).cast("string"), decimals, "0")
    return F.concat(whole.cast("string"), F.lit("."), frac)


def human_count(n: Column) -> Column:
    """``999``, ``12.3K``, ``4.5 lakh``, ``1.23 crore`` (half-up on the exact value)."""
    return (
        F.when(n < 1000, n.cast("string"))
        .when(n < 100000, F.concat(_fixed(_half_up_div(n, 100), 1), F.lit("K")))
        .when(n < 10000000, F.concat(_fixed(_half_up_div(n, 10000), 1), F.lit(" lakh")))
        .otherwise(F.concat(_fixed(_half_up_div(n, 100000), 2), F.lit(" crore")))
    )


def human_bytes(b: Column) -> Column:
    """``512 B``, ``1.50 KB``, ``2.25 MB``, ``3.00 GB`` (half-up on the exact value)."""
    kb, mb, gb = 1024, 1024**2, 1024**3
    return (
        F.when(b < kb, F.concat(b.cast("string"), F.lit(" B")))
        .when(b < mb, F.concat(_fixed(_half_up_div(b * 100, kb), 2), F.lit(" KB")))
        .when(b < gb, F.concat(_fixed(_half_up_div(b * 100, mb), 2), F.lit(" MB")))
        .otherwise(F.concat(_fixed(_half_up_div(b * 100, gb), 2), F.lit(" GB")))
    )
