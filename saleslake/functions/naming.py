"""Name rules: column-name normalisation, reserved words, file-name routing.

Column names are metadata, so the ``*_name`` helpers are plain Python over
``df.columns``.  File names are data (one row per file in a listing), so the
routing rules are Column expressions that run inside the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's for the same routing) ---------
# Words that get the "_raw" suffix when a column is named exactly like one of
# them (case-insensitive).  Listed in the reference's order.
RESERVED_WORDS = frozenset(
    """
    ADD ALL ALTER ANALYZE AND ARRAY AS ASC BETWEEN BIGINT BITMAP BOTH BY CASE CHAR
    CHARACTER CHECK COLLATE COLUMN COMPACTION CONVERT CREATE CROSS CUBE CURRENT_DATE
    CURRENT_TIME CURRENT_TIMESTAMP CURRENT_USER CURRENT_ROLE DIV DATABASE DATABASES
    DECIMAL DECIMALV2 DECIMAL32 DECIMAL64 DECIMAL128 DEFAULT DELETE DENSE_RANK DESC DESCRIBE DISTINCT DOUBLE DROP DUAL DEFERRED
    ELSE EXCEPT EXCLUDE EXISTS EXPLAIN FALSE FIRST_VALUE FLOAT FOR FORCE FROM FULL
    FUNCTION GRANT GROUP GROUPS GROUPING GROUPING_ID HAVING HLL HOST IF IGNORE IN INDEX
    INFILE INNER INSERT INT INTEGER INTERSECT INTO IS IMMEDIATE JOIN JSON KEY KEYS KILL
    LAG LARGEINT LAST_VALUE LATERAL LEAD LEFT LIKE LIMIT LOAD LOCALTIME LOCALTIMESTAMP
    MAXVALUE MINUS MOD NTILE NOT NULL ON OR ORDER OUTER OUTFILE OVER PARTITION PERCENTILE
    PRIMARY PROCEDURE QUALIFY RANGE RANK READ REGEXP RELEASE RENAME REPLACE REVOKE RIGHT
    RLIKE ROW ROWS ROW_NUMBER SCHEMA SCHEMAS SELECT SET SET_VAR SHOW SMALLINT SYSTEM
    TABLE TERMINATED TEXT THEN TINYINT TO TRUE UNION UNIQUE UNSIGNED UPDATE USE USING
    VALUES VARCHAR WHEN WHERE WITH
    """.split()
)
RESERVED_SUFFIX = "_raw"

# File-name prefix -> table name.
FILE_PREFIX_TO_TABLE = {
    "DimCustomerMaster": "dim_customer_master",
    "DimDealerMaster": "dim_dealer_master",
    "DimHierarchy": "dim_hierarchy",
    "DimMaterial": "dim_material",
    "DimMaterialMapping": "dim_material_mapping",
    "DimSalesGroup": "dim_sales_group",
    "FactInvoiceDetails": "fact_invoice_details",
    "FactInvoiceSecondary": "fact_invoice_secondary",
    "RlsMaster": "rls_master",
}
# Fact file names keep one or two numeric groups before the next "_".
FACT_DATASET_PATTERN = r"^((?:FactInvoiceDetails|FactInvoiceSecondary)(?:_\d+){1,2})_"
DEALER_SHORT_NAME = "dimdealer"
DEALER_DATASET = "DimDealerMaster"
# Characters removed when comparing column names.
NAME_NOISE = r"[\s_/%\-]"
# ---------------------------------------------------------------------------


def is_reserved(name: str) -> bool:
    return name.upper() in RESERVED_WORDS


def safe_name(name: str, suffix: str = RESERVED_SUFFIX) -> str:
    """P5: add the suffix to a name that is exactly a reserved word."""
    return f"{name}{suffix}" if is_reserved(name) else name


def reserved_renames(columns: list[str], suffix: str = RESERVED_SUFFIX) -> dict[str, str]:
    """P5 over a frame's columns: ``{old: new}`` for every reserved name."""
    return {c: safe_name(c, suffix) for c in columns if is_reserved(c)}


def _unquote(name: str) -> str:
    return name.strip().strip('"').strip("'")


def normalize_name(name: str) -> str:
    """Strip quotes, drop whitespace and ``_ / % -``, lower-case."""
    return re.sub(NAME_NOISE, "", _unquote(name)).lower()


def lookup_key(name: str) -> str:
    """P4+P5: the normalised key, with ``_raw`` when the bare name is reserved."""
    key = re.sub(NAME_NOISE, "", _unquote(name).lower())
    return key + RESERVED_SUFFIX if is_reserved(_unquote(name)) else key


def snake_case(name: str) -> str:
    """X4 on a Python string."""
    s = re.sub(r"(.)([A-Z][a-z]+)", r"\1_\2", name)
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s).lower()


# --- Column forms (run on executors over file listings) ----------------------


def col_normalize_name(c: Column) -> Column:
    """P4 as a column expression (for name lists held as frames)."""
    unq = F.regexp_replace(F.trim(c), r"^[\"']+|[\"']+$", "")
    return F.lower(F.regexp_replace(unq, NAME_NOISE, ""))


def col_snake_case(c: Column) -> Column:
    """PascalCase -> snake_case with the same two rewrites."""
    s = F.regexp_replace(c, r"(.)([A-Z][a-z]+)", "$1_$2")
    return F.lower(F.regexp_replace(s, r"([a-z0-9])([A-Z])", "$1_$2"))


def col_file_stem(path: Column) -> Column:
    """Base name without directory and without the last extension.

    ``x.csv.gz`` -> ``x.csv`` (the gzip step strips ``.gz`` first; the stem of
    that name is then ``x``), so use :func:`col_csv_stem` for raw files.
    """
    base = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(base, r"\.[^.]*$", "")


def col_csv_stem(path: Column) -> Column:
    """S2 naming: drop ``.gz`` then ``.csv`` (``X_901_1.csv.gz`` -> ``X_901_1``)."""
    base = F.regexp_extract(path, r"([^/]+)$", 1)
    return F.regexp_replace(F.regexp_replace(base, r"(?i)\.gz$", ""), r"(?i)\.csv$", "")


def col_table_from_stem(stem: Column) -> Column:
    """Longest matching prefix wins, else snake_case of the stem."""
    expr = col_snake_case(stem)
    # Build the chain so that longer prefixes are tested first.
    for prefix in sorted(FILE_PREFIX_TO_TABLE, key=len):
        expr = F.when(stem.startswith(prefix), F.lit(FILE_PREFIX_TO_TABLE[prefix])).otherwise(expr)
    return expr


def table_from_stem(stem: str) -> str:
    """P12 on a Python string (same rule as :func:`col_table_from_stem`)."""
    hits = [p for p in FILE_PREFIX_TO_TABLE if stem.startswith(p)]
    if hits:
        return FILE_PREFIX_TO_TABLE[max(hits, key=len)]
    return snake_case(stem)


def col_dataset_name(stem: Column) -> Column:
    """Fact files keep 1-2 numeric groups; others keep the text before ``_``."""
    fact = F.regexp_extract(stem, FACT_DATASET_PATTERN, 1)
    is_fact = stem.contains("FactInvoiceDetails") | stem.contains("FactInvoiceSecondary")
    head = F.regexp_replace(stem, r"_.*", "")
    name = F.when(is_fact & (fact != ""), fact).otherwise(head)
    return F.when(F.lower(name) == DEALER_SHORT_NAME, F.lit(DEALER_DATASET)).otherwise(name)


def dataset_from_stem(stem: str) -> str:
    """P13 on a Python string (same rule as :func:`col_dataset_name`)."""
    fact = re.match(FACT_DATASET_PATTERN, stem)
    name = fact[1] if fact else stem.split("_", 1)[0]
    return DEALER_DATASET if name.lower() == DEALER_SHORT_NAME else name


def groups_from_dataset(dataset: str) -> list[str]:
    """P14 on a dataset name: the sales groups whose rows the file replaces."""
    return dataset.split("_")[1:]


def col_groups_from_stem(stem: Column) -> Column:
    """Sales groups named in a file stem (``X_1_2`` -> ``[1, 2]`` as strings)."""
    parts = F.split(stem, "_")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))
