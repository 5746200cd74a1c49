"""File sources: Parquet, all-string CSV (plain or gzip), listings, missing files.

S1 CSV scan with every column as string, S2 gzip CSV, S3/S5 object listing,
S4/J1 missing-only pick-up, S6 recursive Parquet scan.
"""

from __future__ import annotations

import csv
import datetime
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.functions.naming import col_csv_stem, col_dataset_name
from saleslake.session import hadoop_fs


def read_parquet(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Parquet scan (recursive discovery when asked)."""
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    return reader.parquet(path)


def csv_reader(spark: SparkSession, sep: str = ",", header: bool = True, multi_line: bool = False):
    """The reader behind S1/S2/S8: no inference, quotes kept.

    Files are split over tasks.  ``multi_line`` keeps line breaks inside
    quotes, at the price of one task per file.  A given schema must have the
    names and the order of each file's header, else the read fails.
    """
    return (
        spark.read.option("header", header)
        .option("inferSchema", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .option("sep", sep)
        .option("enforceSchema", not header)
        .option("mode", "PERMISSIVE")
    )


CORRUPT = "_corrupt_record"


def csv_headers(spark: SparkSession, path: str) -> DataFrame:
    """``(header, files)``: the files under ``path`` (or that file) by their first line that is not blank.

    Tasks read the lines as text and keep the first of each file; files are
    read whole for it, as Spark has no reader of first lines.  A file of blank
    lines only has no header and is left out, as is an empty one.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    # the split that begins a file is read by one task, in the order of its lines
    first = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
                         F.monotonically_increasing_id().alias("line"))
    first = first.where((F.col("at") == 0) & F.col("value").rlike(r"[^\x00-\x20]")).groupBy("file").agg(F.min_by("value", "line").alias("header"))
    name = F.url_decode(F.replace("file", F.lit("+"), F.lit("%2B")))  # a URI: a plus sign is itself
    return first.groupBy("header").agg(F.array_sort(F.collect_list(name)).alias("files"))


def read_csv_checked(spark: SparkSession, path: str, columns: list[str], sep: str = ",", multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """S1/S2 for files of many senders: (rows, ragged rows).

    Every file is read by its own header, so files that order their columns
    differently meet by name; a column that a file lacks is NULL, one that no
    table column is named after is dropped.  A row with more or fewer cells
    than its header goes to the second frame (``record``, ``source_file``)
    instead of being cut or padded.  Empty files have no rows.  The driver gets
    the layouts and the names of their files, which Spark's reader is told.
    """
    good, bad = [], []
    for line, files in csv_headers(spark, path).orderBy("header").collect():  # one row for each layout
        header = next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
        df = (csv_reader(spark, sep, True, multi_line).option("enforceSchema", True)
              .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).schema(schema).csv(files))
        src = F.col("_metadata.file_path").alias("source_file")
        have = set(header)
        cells = [(F.col(f"`{c}`") if c in have else F.lit(None).cast("string")).alias(c) for c in columns]
        # judged together with a data column: Spark refuses queries of the corrupt record alone
        first = F.col(f"`{header[0]}`")
        ragged = F.length(F.concat_ws("", CORRUPT, first)) > F.coalesce(F.length(first), F.lit(0))
        good.append(df.where(~ragged).select(*cells, src))
        bad.append(df.where(ragged).select(F.col(CORRUPT).alias("record"), src))
    if not good:
        return (spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*columns, "source_file"])),
                spark.createDataFrame([], "record string, source_file string"))
    return reduce(DataFrame.unionByName, good), reduce(DataFrame.unionByName, bad)


def read_csv_all_string(spark: SparkSession, path: str, columns: list[str] | None = None, sep: str = ",",
                        header: bool = True, with_source: bool = False, multi_line: bool = False) -> DataFrame:
    """Every column as string.  ``.gz`` files are decompressed by the reader.

    With ``columns`` the schema is fixed up front (no header pass over the
    data); otherwise column names come from the header row and every type is
    string because inference is off.  ``with_source`` adds the source file,
    its stem (``x.csv.gz`` -> ``x``) and the dataset name (P13).
    """
    reader = csv_reader(spark, sep, header, multi_line)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    df = reader.csv(path)
    if with_source:
        src = F.col("_metadata.file_path")
        df = df.select("*", src.alias("source_file"), col_csv_stem(src).alias("source_stem"))
        df = df.withColumn("dataset", col_dataset_name(F.col("source_stem")))
    return df


LISTING = "path string, name string, length long, modified timestamp"


def file_listing(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """``(path, name, length, modified)`` for every file under ``root``, sorted by path.

    Spark lists the folders (many of them by a job of its own) and tasks make
    the rows; no file is opened.  Spark's file sources leave out empty files,
    which F6 wants to see: these, the names that the source holds without a
    row, are the only ones the driver asks for.  Names (of folders, too) that
    start with ``_`` or ``.`` are left out.
    """
    source = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    source = (source.option("pathGlobFilter", glob) if glob else source).load(root)
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    found = source.select("path", name, "length", F.col("modificationTime").alias("modified"))
    names = [(re.sub("^file:/+", "file:/", unquote(f)),) for f in source.inputFiles()]
    empty = spark.createDataFrame(names, "path string").join(found, "path", "left_anti").collect()
    fs, _ = hadoop_fs(spark, root)
    rows = []
    for (path,) in empty:
        f = fs.getFileStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))
        rows.append((path, f.getPath().getName(), f.getLen(), datetime.datetime.fromtimestamp(f.getModificationTime() / 1000)))
    return found.unionByName(spark.createDataFrame(rows, LISTING)).orderBy("path")


def missing_outputs(sources: DataFrame, targets: DataFrame, key: str = "name") -> DataFrame:
    """Sources whose output (same ``key``) does not exist yet (left anti join)."""
    return sources.join(targets.select(key).distinct(), key, "left_anti")


def transfer_summary(listing: DataFrame) -> DataFrame:
    """Number of files, of successful (not empty) files, total bytes and empty files of a listing."""
    return listing.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("length") > 0).alias("succeeded"),
        F.sum("length").alias("total_bytes"),
        F.count_if(F.col("length") == 0).alias("empty_files"),
    )


def compression_ratio(raw_listing: DataFrame, packed_listing: DataFrame) -> DataFrame:
    """``(1 - packed / raw) * 100`` from two listings' total sizes (one aggregation)."""
    both = raw_listing.select("length", F.lit(False).alias("_packed")).unionByName(
        packed_listing.select("length", F.lit(True).alias("_packed")))
    agg = both.agg(
        F.sum(F.when(~F.col("_packed"), F.col("length"))).alias("raw_bytes"),
        F.sum(F.when(F.col("_packed"), F.col("length"))).alias("packed_bytes"),
    )
    return agg.select("raw_bytes", "packed_bytes",
                      ((F.lit(1.0) - F.col("packed_bytes") / F.col("raw_bytes")) * 100).alias("reduction_pct"))
