"""The corpus pipeline: five of the operators of ``saleslake.llm``, each stage written and read again.

Every stage is a function of (spark, docs, sf_dir) and works on all rows that
the stage before it kept; all but the last return the columns of ``documents``.
Rows travel in a struct beside a number of their own, so columns may have any
names, and rows that repeat a doc_id (or have none) stay apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.llm.common import scratch, table, written
from saleslake.llm.op04_pack import pack
from saleslake.llm.op05_simhash_tiles import near_dedup
from saleslake.llm.op06_byte_cnn import quality_scores, train
from saleslake.llm.op07_pii_surrogates import session_key, surrogates
from saleslake.llm.op08_grace_dedup import exact_dedup


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """uid, row (all columns), text; written, so that every use sees the same numbers."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return written(docs.select(F.monotonically_increasing_id().alias("uid"), row.alias("row")), scratch(docs.sparkSession, name))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte-level network, trained on the labels of these documents, does not reject.

    Labels of one kind teach nothing, so then every document stays.
    """
    model = train(docs, table(spark, sf_dir, "labels"))
    if not model.learned:
        return docs
    scored = quality_scores(docs, model, keep=True)
    return scored.filter("predicted = 1").select("row.*")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal up to white space, the one with the smallest doc_id."""
    rows = _numbered(docs, "pipeline-exact")
    found = exact_dedup(rows.select("uid", "row.doc_id", "row.text"), uid="uid")
    dropped = found.filter(~F.col("kept")).select("uid")
    return rows.join(dropped, "uid", "left_anti").select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that SimHash links, one document: the one with the smallest doc_id."""
    rows = _numbered(docs, "pipeline-near")
    # the smallest (doc_id, number) of a component stays; rows without a doc_id come last
    key = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("id"), F.col("uid").alias("uid"))
    found = near_dedup(rows.select(key.alias("key"), F.col("row.text").alias("text")), key="key")
    dropped = found.filter(F.col("key") != F.col("component_id")).select("key.uid")
    return rows.join(dropped, "uid", "left_anti").select("row.*")


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates; n_chars follows the text."""
    done = surrogates(docs, session_key(spark)).select("row.*")
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens with their places in the sequences."""
    return pack(docs)


STAGES = [("quality", quality), ("exact_copies", exact_copies), ("near_copies", near_copies), ("pii", pii), ("packing", packing)]

#: A trained model and tokenizers are not expressible in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
