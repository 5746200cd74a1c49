"""A profile that is kept beside a published table.

A data folder never changes, so what the profile measures of it (rows, NULLs,
failed conversions, extremes) is computed once and kept.  ``refresh_profile``
reads only the folders that a load added; ``kept_profile`` merges the measures
of the folders that a version consists of, and reads no rows of the table.

The measures are a published table of their own, one row per folder, column
number and declared type, so renamed columns keep theirs, a column that is
dropped and added again starts anew, and a changed declaration is measured
for the columns it concerns only.  Nothing is ever replaced there: measures of
folders that a version no longer has are not counted, nor are those that two
refreshes at the same time both wrote.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.operators import profile as P
from saleslake.operators import table as TB
from saleslake.spec import TableSpec

FOLDER = "folder__"
FAILS = len(P.DATE_FORMATS)
#: ``slot`` spreads the folders; column, declared, data: what was measured of which column.
MEASURES = ("slot int, folder string, column_id int, declared string, data string, n long, nulls long, "
            "fails array<long>, min_val decimal(38,0), max_val decimal(38,0), max_len int, has_time boolean")
_PARTS = (("mn", "min_val", "decimal(38,0)"), ("mx", "max_val", "decimal(38,0)"), ("ml", "max_len", "int"), ("ht", "has_time", "boolean"))


def _columns(m: TB.Manifest, spec: TableSpec, spark: SparkSession) -> list[tuple[int, tuple]]:
    """(number, plan entry) of every declared column that the version has."""
    ids = dict(zip(m.schema.names, m.ids))
    return [(ids[actual], (c, actual, d, kind)) for c, actual, d, kind in P._plan(spark.createDataFrame([], m.schema), spec)]


def _sort(entry: tuple) -> tuple[str, str]:
    """What decides how a column is measured: its declared type, and whether its values are text."""
    c, _, d, kind = entry
    return (c.type if kind == "decimal" else c.family), kind or ("VARCHAR" if d == "VARCHAR" else "value")


def _measure(rows: DataFrame, columns: list[tuple[int, tuple]]) -> DataFrame:
    """The measures of some columns by folder: one aggregation for each group of columns."""
    out = []
    for at in range(0, len(columns), P.PROFILE_GROUP):
        group = columns[at : at + P.PROFILE_GROUP]
        plan = [entry for _, entry in group]
        structs = []
        for i, (number, entry) in enumerate(group):
            have = P.measures(plan, i)
            declared, data = _sort(entry)
            fails = [F.col(f"f{i}_{k}") if f"f{i}_{k}" in have else F.lit(0).cast("long") for k in range(FAILS)]
            parts = [(F.col(f"{p}{i}") if f"{p}{i}" in have else F.lit(None)).cast(kind).alias(name) for p, name, kind in _PARTS]
            structs.append(F.struct(F.lit(number).alias("column_id"), F.lit(declared).alias("declared"), F.lit(data).alias("data"),
                                    F.col("n"), F.col(f"z{i}").alias("nulls"), F.array(*fails).alias("fails"), *parts))
        wide = P.measured(rows, plan, [FOLDER])
        out.append(wide.select(F.pmod(F.xxhash64(FOLDER), F.lit(16)).cast("int").alias("slot"), F.col(FOLDER).alias("folder"), F.inline(F.array(*structs))))
    return reduce(DataFrame.unionByName, out)


def _asked(spark: SparkSession, m: TB.Manifest, columns: list) -> DataFrame:
    """folder, column_id, declared, data of everything that the version's profile is made of."""
    folders = spark.createDataFrame([(f,) for f in sorted(m.folders())], "folder string")
    sorts = F.array(*[F.struct(F.lit(n).alias("column_id"), F.lit(_sort(e)[0]).alias("declared"), F.lit(_sort(e)[1]).alias("data")) for n, e in columns])
    return folders.select("folder", F.inline(sorts))


_KEY = ["folder", "column_id", "declared", "data"]


def refresh_profile(spark: SparkSession, root: str, at: str, spec: TableSpec) -> int:
    """Measure what the latest version of the table at ``root`` has and the profile at ``at`` lacks; returns that version.

    Folders that lack the same columns are read together, with those columns
    only.  A refresh that dies publishes nothing; one that is repeated finds
    nothing to do.
    """
    m = TB.manifest(spark, root)
    columns = _columns(m, spec, spark)
    if not TB.versions(spark, at):
        TB.create(spark.createDataFrame([], MEASURES), at, "slot")
    if not columns or not m.parts:
        return m.version
    lacking = _asked(spark, m, columns).join(TB.read_table(spark, at).select(*_KEY), _KEY, "left_anti")
    lacking = lacking.groupBy("folder").agg(F.sort_array(F.collect_set("column_id")).alias("ids"))
    # metadata: at most one row for each folder of the manifest
    todo: dict[tuple, list[str]] = {}
    for folder, ids in lacking.collect():
        todo.setdefault(tuple(ids), []).append(folder)
    if todo:
        new = [_measure(TB.read_folders(spark, root, sorted(folders), m, FOLDER), [c for c in columns if c[0] in ids]) for ids, folders in sorted(todo.items())]
        TB.append(reduce(DataFrame.unionByName, new), at)
    return m.version


def kept_profile(spark: SparkSession, root: str, at: str, spec: TableSpec, version: int | None = None) -> DataFrame:
    """The profile of a version of the table (``profile.profile`` of its rows) from the measures at ``at``.

    Fails if the measures of a folder are missing: refresh first.
    """
    m = TB.manifest(spark, root, version)
    columns = _columns(m, spec, spark)
    if not m.parts or not columns:
        return P.profile(TB.read_table(spark, root, version=m.version), spec)
    held = TB.read_table(spark, at).join(_asked(spark, m, columns), _KEY, "left_semi").dropDuplicates(_KEY)
    merged = held.groupBy("column_id").agg(
        F.count(F.lit(1)).alias("folders"), F.sum("n").alias("n"), F.sum("nulls").alias("z"),
        *[F.sum(F.col("fails")[k]).alias(f"f_{k}") for k in range(FAILS)],
        F.min("min_val").alias("mn"), F.max("max_val").alias("mx"), F.max("max_len").alias("ml"), F.bool_or("has_time").alias("ht"))
    rows = merged.collect()  # one row per declared column
    whole = {r["column_id"] for r in rows if r["folders"] == len(m.folders())}
    if any(number not in whole for number, _ in columns):
        raise TB.LoadError(f"the profile at {at} lacks folders of version {m.version} of {root}: refresh it")
    local = spark.createDataFrame(rows, merged.schema)
    out = []
    for first in range(0, len(columns), P.PROFILE_GROUP):
        group = columns[first : first + P.PROFILE_GROUP]
        plan = [entry for _, entry in group]
        # z3, f3_0, mn3 ... of the group's columns side by side, as ``measured`` has them
        aggs = [F.max(F.when(F.col("column_id") == number, F.col(name.replace(str(i), "", 1)))).alias(name)
                for i, (number, _) in enumerate(group) for name in P.measures(plan, i)]
        out.append(P.judged(local.agg(F.max("n").alias("n"), *aggs), plan))
    return P._finish(reduce(DataFrame.unionByName, out))
