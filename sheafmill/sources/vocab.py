"""The vocabulary on disk: Parquet tables, and one JSON object for other programs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.operators.tokenizer import Vocabulary
from sheafmill.sources import versions


def write_vocab(spark: SparkSession, vocab: Vocabulary, path: str, mode: str = "skip") -> bool:
    """Write tables `vocab` and `merges` as one version; `skip` leaves a finished vocabulary alone."""
    if mode not in ("skip", "reset"):
        raise ValueError("mode must be 'skip' or 'reset'")
    if mode == "skip" and has_vocab(spark, path):
        return False

    def write(folder: str) -> None:
        vocab.merges_frame(spark).coalesce(1).write.parquet(f"{folder}/merges")
        vocab.vocab_frame(spark).coalesce(1).write.parquet(f"{folder}/vocab")

    versions.replace(spark, path, write)
    return True


def has_vocab(spark: SparkSession, path: str) -> bool:
    return versions.current(spark, path) is not None


def read_vocab_frame(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{versions.need_current(spark, path)}/vocab")


def read_vocab(spark: SparkSession, path: str) -> Vocabulary:
    folder = versions.need_current(spark, path)
    return Vocabulary.from_frames(spark.read.parquet(f"{folder}/vocab"), spark.read.parquet(f"{folder}/merges"))


def vocab_json(vocab: DataFrame) -> DataFrame:
    """One row: the vocabulary as a JSON object from token text to id, with the BOS id beside it.

    Different byte tokens can look alike once decoded alone; the smallest id is kept for a text.
    The table has at most `vocab_size` rows, so one row can hold it.
    """
    text = F.make_valid_utf8(F.col("token").cast("string"))
    entries = vocab.groupBy(text.alias("token")).agg(F.min("token_id").alias("id"))
    first = vocab.agg(F.min(F.when(F.col("is_special"), F.col("token_id"))).alias("bos_id"))
    table = entries.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("token", "id")))).alias("vocab")
    )
    return table.crossJoin(first).select(F.to_json(F.struct("vocab", "bos_id")).alias("value"))


def export_vocab_json(vocab: DataFrame, path: str) -> None:
    vocab_json(vocab).write.mode("overwrite").text(path)
