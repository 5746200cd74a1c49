"""DuckDB building blocks for the oracle SQL (hand-written, independent of Spark)."""

from __future__ import annotations

from saleslake.functions.scalar import WS_CHARS

_WS_SQL = WS_CHARS.replace("'", "''")


def d_strip(x: str) -> str:
    return f"trim({x}, '{_WS_SQL}')"


def d_email_id(x: str) -> str:
    s = f"lower({d_strip(x)})"
    s = f"replace(replace(replace(replace({s}, '@', '_at_'), '.', '_dot_'), '-', '_'), ' ', '_')"
    return f"coalesce(regexp_replace({s}, '[^\\p{{L}}\\p{{N}}_]', '', 'g'), '')"


INT_RE = "[+-]?[0-9]+"
NUM_RE = "[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?"
DUCK_DATE_FORMATS = ("%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y", "%Y%m%d", "%Y-%m-%d %H:%M:%S")


def d_blank_null(x: str) -> str:
    return f"NULLIF({d_strip(x)}, '')"


def d_to_int(x: str, typ: str = "BIGINT") -> str:
    s = d_blank_null(x)
    return f"(CASE WHEN regexp_full_match({s}, '{INT_RE}') THEN TRY_CAST({s} AS {typ}) END)"


def d_to_double(x: str) -> str:
    s = d_blank_null(x)
    return f"(CASE WHEN regexp_full_match({s}, '{NUM_RE}') THEN TRY_CAST({s} AS DOUBLE) END)"


def d_to_date(x: str, fmt: str) -> str:
    return f"CAST(try_strptime({x}, '{fmt}') AS DATE)"


def d_failed(x: str, conv: str) -> str:
    return f"count(*) FILTER (WHERE {x} IS NOT NULL AND {conv} IS NULL)"


def d_choice(fails: list[str], n: str = "n") -> str:
    """1-based index of the first format with fails*10 <= n, else NULL."""
    whens = " ".join(f"WHEN {f} * 10 <= {n} THEN {i + 1}" for i, f in enumerate(fails))
    return f"(CASE {whens} END)"
