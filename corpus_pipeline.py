"""Cleaning of a document collection in stages, each written as Parquet and read again.

Every stage takes all that the one before kept. Quality rules drop what they reject; exact dedup keeps one
row per normalised text, the longest, then that with the smallest id; SimHash near-dedup keeps the row with the
smallest id of each linked group; private terms rewrites texts; best-fit packing lays the rest out in sequences.
Both dedup stages number rows and choose by that number, so ids may repeat or be missing.

Defined results: a null text counts as empty and is rejected by the quality rules; rows that share an id, or
have none, are kept or dropped by their texts alone; a null id ranks behind all others, and of equal ids
the row numbered first; an empty table leaves every stage empty; columns beyond those of the documents
table go along unchanged until the last stage.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.llm import exact_dedup, packing, private_terms, quality_rules, simhash
from sheafmill.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_rules.keep_good(docs, quality_rules.fit(docs, labels))


ROW, GROUP = "_pipeline_row", "_pipeline_group"


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` with a number for each row that every later scan gives it again.

    Rows of a Parquet table are known by file and place in it, however a scan cuts the files; nothing is
    written for that. Rows from elsewhere are numbered in a written table.
    """
    try:
        files = docs.select("_metadata.file_path", "_metadata.row_index").select("file_path").distinct()
    except AnalysisException:
        return materialise(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")
    names = sorted(r[0] for r in files.collect())  # one row per file
    numbers = docs.sparkSession.createDataFrame(list(enumerate(names)), "_pipeline_no long, _pipeline_file string")
    placed = docs.select(
        "*", F.col("_metadata.file_path").alias("_pipeline_file"), F.col("_metadata.row_index").alias("_pipeline_at")
    ).join(F.broadcast(numbers), "_pipeline_file")
    row = F.shiftleft("_pipeline_no", 40) + F.col("_pipeline_at")
    return placed.select(*[placed[c] for c in docs.columns], row.alias(ROW))


def as_documents(rows: DataFrame) -> DataFrame:
    """Rows for an operator, their number in place of the id."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def one_of_each(rows: DataFrame, groups: DataFrame, *order: Column) -> DataFrame:
    """The first row of each group by `order`, then id, then number; `groups` has ROW and GROUP."""
    facts = rows.select(F.col(ROW), F.struct(*order, F.col("doc_id").isNull(), "doc_id", ROW).alias("place"))
    best = facts.join(groups, ROW).groupBy(GROUP).agg(F.min("place").alias("place"))
    kept = materialise(best.select(F.col(f"place.{ROW}").alias(ROW)), "pipeline-kept")
    # a merge at every size: how a small table is joined says nothing about a large one
    return rows.join(kept.hint("merge"), ROW, "left_semi").drop(ROW)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    groups = exact_dedup.exact_dedup(as_documents(rows))
    own = groups.select(F.col("doc_id").alias(ROW), F.col("text_sha256").alias(GROUP))
    return one_of_each(rows, own, -F.char_length(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs)
    groups = simhash.near_duplicates(as_documents(rows))
    return one_of_each(rows, groups.select(F.col("doc_id").alias(ROW), F.col("component_id").alias(GROUP)))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private_terms.sanitise(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("private_terms", private),
    ("best_fit_packing", pack),
]
#: Scoring by a trained model has no SQL form; a test compares run() with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; rows as from packing.pack_documents()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
