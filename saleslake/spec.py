"""Table specs: declared columns, SQL type families, the upgrade table, mappings.

A ``TableSpec`` holds the declared SQL type text of every column (e.g.
``VARCHAR(118)``, ``SMALLINT``), the incoming-header mapping, keys and a
bucket hint.  The Spark schema is derived from it; VARCHAR limits travel in
``StructField`` metadata so that widening stays soft.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace
from pathlib import Path

from pyspark.sql import types as T

from saleslake.functions.naming import lookup_key

# --- fixed values -------------------------------------------------------------
# Integer families and their ranges (LARGEINT is unbounded here).
INT_RANGES = {
    "TINYINT": (-128, 127),
    "SMALLINT": (-32768, 32767),
    "INT": (-2147483648, 2147483647),
    "BIGINT": (-9223372036854775808, 9223372036854775807),
    "LARGEINT": (None, None),
}
INT_FAMILIES = ("TINYINT", "SMALLINT", "INT", "BIGINT", "LARGEINT")
# Allowed widenings, in the order they are tried.
ALLOWED_UPGRADES = {
    "FLOAT": ("DOUBLE", "DECIMAL"),
    "DOUBLE": ("DECIMAL",),
    "DECIMAL": ("DECIMAL",),
    "TINYINT": ("SMALLINT", "INT", "BIGINT", "LARGEINT", "FLOAT", "DOUBLE"),
    "SMALLINT": ("INT", "BIGINT", "LARGEINT", "FLOAT", "DOUBLE"),
    "INT": ("BIGINT", "LARGEINT", "FLOAT", "DOUBLE"),
    "BIGINT": ("LARGEINT", "DOUBLE"),
    "DATE": ("DATETIME",),
}
VARCHAR_WIDEN_FACTOR = (6, 5)   # recommended = max * 6 / 5 (a 20 % buffer)
VARCHAR_CAP = 5000
FAILURE_LIMIT = (1, 10)         # at most 10 % of rows may fail a conversion
# ------------------------------------------------------------------------------

_ALIASES = {"INTEGER": "INT", "STRING": "VARCHAR", "TEXT": "VARCHAR", "CHAR": "VARCHAR",
            "TIMESTAMP": "DATETIME", "BOOL": "BOOLEAN", "REAL": "FLOAT", "NUMERIC": "DECIMAL"}


def family(type_text: str) -> str:
    """Base type family of a SQL type text (exact names, not substrings)."""
    base = type_text.strip().upper().split("(")[0].strip()
    return _ALIASES.get(base, base)


def varchar_limit(type_text: str) -> int | None:
    m = re.search(r"VARCHAR\s*\((\d+)\)", type_text.upper())
    return int(m.group(1)) if m else None


def is_allowed_upgrade(source: str, target: str) -> bool:
    """P11."""
    s, t = family(source), family(target)
    return t in ALLOWED_UPGRADES.get(s, ())


def spark_type(type_text: str) -> T.DataType:
    f = family(type_text)
    if f == "DECIMAL":
        m = re.search(r"\((\d+)\s*,\s*(\d+)\)", type_text)
        return T.DecimalType(int(m.group(1)), int(m.group(2))) if m else T.DecimalType(38, 9)
    return {
        "TINYINT": T.ByteType(), "SMALLINT": T.ShortType(), "INT": T.IntegerType(),
        "BIGINT": T.LongType(), "LARGEINT": T.DecimalType(38, 0), "FLOAT": T.FloatType(),
        "DOUBLE": T.DoubleType(), "VARCHAR": T.StringType(), "BOOLEAN": T.BooleanType(),
        "DATE": T.DateType(), "DATETIME": T.TimestampNTZType(),
    }.get(f, T.StringType())


@dataclass(frozen=True)
class Column:
    name: str
    type: str                     # declared SQL type text, e.g. "VARCHAR(118)"
    header: str | None = None     # incoming header when it differs from the default
    nullable: bool = True
    comment: str = ""

    @property
    def family(self) -> str:
        return family(self.type)

    @property
    def limit(self) -> int | None:
        return varchar_limit(self.type)

    def incoming(self) -> str:
        return self.header if self.header is not None else self.name.replace("_", "")


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: tuple[Column, ...]
    keys: tuple[str, ...] = ()
    buckets: int = 10
    order: int = 0
    kind: str = "TABLE"
    comment: str = ""
    partition_by: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()      # name prefixes that incoming headers may leave out
    extra: dict = field(default_factory=dict)

    def column(self, name: str) -> Column | None:
        low = name.lower()
        for c in self.columns:
            if c.name.lower() == low:
                return c
        return None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def schema(self) -> T.StructType:
        fields = []
        for c in self.columns:
            meta = {"sql_type": c.type}
            if c.limit is not None:
                meta["varchar"] = c.limit
            if c.comment:
                meta["comment"] = c.comment
            fields.append(T.StructField(c.name, spark_type(c.type), c.nullable, meta))
        return T.StructType(fields)

    def aliases(self, c: Column) -> list[str]:
        """Normalised names of a column, with and without the table's prefixes."""
        from saleslake.functions.naming import lookup_key

        key = lookup_key(c.name)
        return [key, *(key[len(p):] for p in self.prefixes if key.startswith(p))]

    def header_map(self) -> dict[str, str]:
        """Incoming header -> column name (exact headers)."""
        return {c.incoming(): c.name for c in self.columns}

    def key_map(self) -> dict[str, str]:
        """Normalised lookup key -> column name."""
        out: dict[str, str] = {}
        for c in self.columns:
            out.setdefault(lookup_key(c.incoming()), c.name)
            out.setdefault(lookup_key(c.name), c.name)
        return out

    def with_types(self, changes: dict[str, str]) -> "TableSpec":
        """A new spec with some declared types replaced (never edits files)."""
        cols = tuple(replace(c, type=changes.get(c.name, c.type)) for c in self.columns)
        return replace(self, columns=cols)


def parse_columns(text: str) -> tuple[Column, ...]:
    """Compact spec text: ``name:TYPE[!][<-"header"]`` separated by commas/newlines."""
    out = []
    for item in re.split(r",\s*(?![^(]*\))|\n", text.strip()):
        item = item.strip()
        if not item:
            continue
        m = re.fullmatch(r'(\w+):([A-Za-z]+(?:\(\d+(?:,\s*\d+)?\))?)(!)?(?:<-"([^"]*)")?', item)
        if not m:
            raise ValueError(f"bad column spec: {item!r}")
        out.append(Column(m.group(1), m.group(2).upper(), m.group(4), nullable=m.group(3) is None))
    return tuple(out)


def spec_from_mapping(name: str, mapping: dict, keys=(), buckets=10, order=0) -> TableSpec:
    """A spec from a mapping document ``{header: {db_column, data_type, ...}}``."""
    cols = []
    for header, info in mapping.items():
        dtype = info.get("data_type", "VARCHAR")
        if family(dtype) == "VARCHAR" and info.get("max_string_length") and "(" not in dtype:
            dtype = f"VARCHAR({info['max_string_length']})"
        col = info.get("db_column", header)
        cols.append(Column(col, dtype.upper(), None if header == col.replace("_", "") else header))
    return TableSpec(name, tuple(cols), tuple(keys), buckets, order)


def load_mappings(directory: str | Path) -> tuple[dict[str, TableSpec], list[str]]:
    """Every ``*.json`` mapping in a folder -> spec.

    Returns ``(specs, skipped)``; files that cannot be read are reported, not fatal.
    """
    from saleslake.functions.naming import table_from_stem

    specs: dict[str, TableSpec] = {}
    skipped: list[str] = []
    for i, p in enumerate(sorted(Path(directory).glob("*.json"))):
        try:
            doc = json.loads(p.read_text())
        except (OSError, json.JSONDecodeError):
            skipped.append(p.name)
            continue
        stem = re.sub(r"^\d+_", "", p.stem)
        table = table_from_stem(stem)
        specs[table] = spec_from_mapping(table, doc, order=i + 1)
    return specs, skipped


def load_order(specs: dict[str, TableSpec]) -> list[TableSpec]:
    """O1: specs by ``order``, facts last."""
    return sorted(specs.values(), key=lambda s: (s.name.startswith("fact_"), s.order, s.name))


# --- built-in specs (the small reference tables) -------------------------------

DIM_SALES_GROUP = TableSpec(
    "dim_sales_group",
    parse_columns("division:VARCHAR(50)!, sales_group:SMALLINT!, vertical:VARCHAR(50)!"),
    keys=("sales_group",), order=5,
)
RLS_MASTER = TableSpec(
    "rls_master",
    parse_columns(
        "cluster:VARCHAR(200), division:VARCHAR(50), email_id:VARCHAR(200), hierarchy_path:VARCHAR(2000), "
        "sales_group:SMALLINT, sh_2:VARCHAR(200), sh_3:VARCHAR(200), sh_4:VARCHAR(200), "
        "sh_5:VARCHAR(200), sh_6:VARCHAR(200), sh_7:VARCHAR(200), vertical:VARCHAR(50)"
    ),
    keys=("email_id",), order=9,
)
DIM_MATERIAL_MAPPING = TableSpec(
    "dim_material_mapping",
    parse_columns(
        "brand:VARCHAR(118), final_classification:VARCHAR(118), material_code:VARCHAR(118), "
        "parent_division_code:VARCHAR(118), parent_division_name:VARCHAR(118), "
        "product_group_1_description:VARCHAR(140), product_group_2_description:VARCHAR(140), "
        "product_group_3_description:VARCHAR(140), vertical:VARCHAR(50), material_code_sg_key:VARCHAR(118)"
    ),
    keys=("material_code",), order=1,
)
BUILTIN_SPECS = {s.name: s for s in (DIM_MATERIAL_MAPPING, DIM_SALES_GROUP, RLS_MASTER)}
