"""Projection and schema operators.

Column names and types are metadata: the decisions below run on the driver
over ``df.columns`` / ``df.schema`` (a few hundred names at most) and end in
one ``select`` / ``withColumnsRenamed`` that Catalyst folds into the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.functions.naming import NAME_NOISE, lookup_key, reserved_renames
from saleslake.spec import INT_FAMILIES, TableSpec, family, spark_type

_STRING_TYPES = (T.StringType, T.VarcharType, T.CharType)


def data_family(dt: T.DataType) -> str:
    """SQL family of a Spark data type."""
    if isinstance(dt, _STRING_TYPES):
        return "VARCHAR"
    return {
        T.ByteType: "TINYINT", T.ShortType: "SMALLINT", T.IntegerType: "INT", T.LongType: "BIGINT",
        T.FloatType: "FLOAT", T.DoubleType: "DOUBLE", T.DecimalType: "DECIMAL", T.BooleanType: "BOOLEAN",
        T.DateType: "DATE", T.TimestampType: "DATETIME", T.TimestampNTZType: "DATETIME",
    }.get(type(dt), type(dt).__name__.upper())


# --- fixed values: how well data of a kind suits a declared kind (P8) ----------
MATCH_SCORES = {
    ("text", "text"): 100, ("text", "integer"): -50, ("text", "other"): 10,
    ("number", "number"): 100, ("number", "other"): 10,
}
# ------------------------------------------------------------------------------


def _match_score(is_string: bool, fam: str) -> int:
    if is_string:
        return MATCH_SCORES["text", "text" if fam == "VARCHAR" else "integer" if fam in INT_FAMILIES else "other"]
    return MATCH_SCORES["number", "number" if fam in INT_FAMILIES + ("FLOAT", "DOUBLE") else "other"]


def best_match(name: str, is_string: bool, spec: TableSpec) -> str | None:
    """The column that the incoming name abbreviates, best type first, then spec order.

    A column may come under any prefix of its aliases (``TableSpec.aliases``).
    """
    wanted = re.sub(NAME_NOISE, "", name.lower().strip().strip('"').strip("'"))
    fits = [c for c in spec.columns if wanted and any(a.startswith(wanted) for a in spec.aliases(c))]
    return max(fits, key=lambda c: _match_score(is_string, c.family)).name if fits else None


def resolve_columns(df: DataFrame, spec: TableSpec, fuzzy: bool = True) -> dict[str, str]:
    """Incoming column -> spec column.

    Order of rules (first hit wins): exact incoming header, exact column name
    (case-insensitive), normalised key (reserved words get ``_raw``), then
    the P8 prefix match.  A target is used once; a target that already
    exists as a column is never renamed onto.
    """
    headers = spec.header_map()
    headers_ci = {h.lower(): n for h, n in headers.items()}
    names_ci = {n.lower(): n for n in spec.names}
    keys = spec.key_map()
    existing = set(df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    out: dict[str, str] = {}
    used: set[str] = set()
    for col in df.columns:
        target = (
            headers.get(col)
            or headers_ci.get(col.lower())
            or names_ci.get(col.lower())
            or keys.get(lookup_key(col))
        )
        if target is None and fuzzy:
            target = best_match(col, isinstance(types[col], _STRING_TYPES), spec)
        if target is None or target in used:
            continue
        if target != col and target in existing:
            continue
        used.add(target)
        out[col] = target
    return out


def rename_to_spec(df: DataFrame, spec: TableSpec, fuzzy: bool = True) -> DataFrame:
    """Rename mapped columns; unmapped columns keep their (reserved-safe) names."""
    mapping = {k: v for k, v in resolve_columns(df, spec, fuzzy).items() if k != v}
    df = df.withColumnsRenamed(mapping) if mapping else df
    mapped = set(mapping.values()) | set(spec.names)
    extra = reserved_renames([c for c in df.columns if c not in mapped])
    return df.withColumnsRenamed(extra) if extra else df


def schema_diff(df: DataFrame, spec: TableSpec) -> tuple[list[str], list[str]]:
    """(columns only in data, columns only in the table), case-insensitive."""
    have = {c.lower(): c for c in df.columns}
    want = {c.lower(): c for c in spec.names}
    return sorted(have[k] for k in have.keys() - want.keys()), sorted(want[k] for k in want.keys() - have.keys())


def select_table_order(df: DataFrame, spec: TableSpec, fill_missing: bool = False) -> DataFrame:
    """Case-insensitive select in the table's column order.

    With ``fill_missing`` absent columns become typed NULLs so that every
    written file has the full table schema.
    """
    have = {c.lower(): c for c in df.columns}
    cols = []
    for c in spec.columns:
        actual = have.get(c.name.lower())
        if actual is not None:
            cols.append(F.col(f"`{actual}`").alias(c.name))
        elif fill_missing:
            cols.append(F.lit(None).cast(spark_type(c.type)).alias(c.name))
    return df.select(*cols)


def compatible(data_fam: str, table_fam: str) -> bool:
    """P10 rule: equal; any integer ~ any integer; DOUBLE ~ FLOAT/DOUBLE."""
    if data_fam == table_fam:
        return True
    if data_fam in INT_FAMILIES and table_fam in INT_FAMILIES:
        return True
    return data_fam in ("FLOAT", "DOUBLE") and table_fam in ("FLOAT", "DOUBLE")


def type_mismatches(df: DataFrame, spec: TableSpec, unknown_is_mismatch: bool = False) -> list[tuple[str, str, str]]:
    """P10: ``(column, data family, table family)`` for every incompatible column."""
    out = []
    for f in df.schema.fields:
        c = spec.column(f.name)
        if c is None:
            if unknown_is_mismatch:
                out.append((f.name, data_family(f.dataType), "MISSING"))
            continue
        d = data_family(f.dataType)
        if not compatible(d, family(c.type)):
            out.append((f.name, d, family(c.type)))
    return out


def check_types(df: DataFrame, spec: TableSpec) -> None:
    """P10 gate: raise with the full list of mismatches."""
    bad = type_mismatches(df, spec)
    if bad:
        raise TypeError("type mismatch: " + ", ".join(f"{c} ({d} vs {t})" for c, d, t in bad))


def check_mapping(mapping: dict[str, str], spec: TableSpec) -> list[str]:
    """Mapped target columns that the table does not have (empty = valid)."""
    names = {n.lower() for n in spec.names}
    return sorted({t for t in mapping.values() if t.lower() not in names})
