"""The load of one landed file, from CSV to its table.

S1 checked CSV read (by header, ragged rows aside) -> P12-P14 routing ->
F1/F2 date floor by kind -> K1 staged Parquet -> S6 -> P1 + C5 + C6 (rename,
clean, widen) -> P10 gate -> P7 table order -> K4 tolerance -> K5 for
dimensions, K6/K7/K8/K9 for facts.  Everything is checked before the target
changes, and the target changes by one published version.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.functions.naming import dataset_from_stem, groups_from_dataset, table_from_stem
from saleslake.operators import filters as FL
from saleslake.operators import load as L
from saleslake.operators import table as TB
from saleslake.operators.profile import clean_table
from saleslake.operators.project import check_types, select_table_order
from saleslake.session import scratch_path
from saleslake.sources.files import read_csv_checked
from saleslake.spec import TableSpec

# --- fixed values: the date column whose floor a file of each kind must pass ---
DATE_COLUMNS = {"fact_invoice_secondary": "invoicedate", "fact_invoice_details": "postingdate"}
# ------------------------------------------------------------------------------


@dataclass
class PipelineResult:
    table: str
    dataset: str
    mode: str                # refresh, replace_groups, replace_dd, replace_expanded or append
    spec: TableSpec          # the spec actually written (widened where the data asked)
    profile: DataFrame
    status: DataFrame        # K4, one row for the file
    rejected: DataFrame      # typed rows that were filtered, with ``reason``
    ragged: DataFrame        # CSV records that do not fit their header
    affected: list = field(default_factory=list)


def load_file(spark: SparkSession, landed: str, file_stem: str, spec: TableSpec, target_root: str, dd: bool = False,
              floor: int | None = None, columns: list[str] | None = None) -> PipelineResult:
    """Load the landed CSV (a file or folder) named ``file_stem`` into its table.

    ``dd``: the file holds the ``DD`` rows of all groups (K7).  A file of a
    fact without groups in its name is appended (K9).  A file without rows
    changes nothing but, for a dimension, empties it.
    """
    table = table_from_stem(file_stem)
    dataset = dataset_from_stem(file_stem)
    groups = groups_from_dataset(dataset)
    names = columns or [c.incoming() for c in spec.columns]
    raw, ragged = read_csv_checked(spark, landed, names)
    raw = raw.drop("source_file")
    date_col = DATE_COLUMNS.get(table)
    if date_col:
        default = FL.SECONDARY_DATE_FLOOR if table == "fact_invoice_secondary" else FL.DETAILS_DATE_FLOOR
        raw = FL.date_floor(raw, date_col, default if floor is None else floor)
        raw = raw.withColumn(date_col, F.col(date_col).cast("string"))
    staged = scratch_path(spark, "raw_parquet")
    L.write_parquet(raw, staged)
    back = spark.read.option("recursiveFileLookup", "true").schema(raw.schema).parquet(staged)
    typed, prof = clean_table(back, spec, policy="widen")
    widened = {r["column_name"]: r["proposed"] for r in prof.collect() if r["numeric_overflow"] and r["proposed"]}
    out_spec = spec.with_types(widened)
    check_types(typed, out_spec)
    ordered = select_table_order(typed, out_spec, fill_missing=True)
    res = L.tolerant_load(ordered.withColumn("_file", F.lit(file_stem)), out_spec, "_file")
    failed = res.status.where("status = 'Failed'").collect()
    if failed:
        raise L.LoadError(f"{file_stem}: {failed[0]['filtered']} of {failed[0]['total']} rows filtered")
    new = select_table_order(res.loaded, out_spec)
    out = PipelineResult(table, dataset, "", out_spec, prof, res.status, res.rejected.drop("_file"), ragged)
    if not table.startswith("fact_"):
        out.mode = "refresh"
        L.publish_version(new, target_root)
    elif dd:
        out.mode, out.affected = "replace_dd", L.replace_dd(spark, target_root, new)
    elif not groups:
        out.mode, out.affected = "append", TB.append(new, target_root)
    elif table == "fact_invoice_details":
        out.mode, out.affected = "replace_expanded", L.replace_groups_expanded(spark, target_root, new, groups)
    else:
        out.mode, out.affected = "replace_groups", L.replace_groups_not_dd(spark, target_root, new, groups)
    return out
