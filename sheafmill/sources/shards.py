"""The sharded corpus: Parquet partitioned by split and shard."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.session import path_exists
from sheafmill.sources import versions

SHARD_SCHEMA = "text string, shuffle_key string, pos long, split string, shard int"


def is_complete(spark: SparkSession, path: str) -> bool:
    """A write came to its end and both splits are there."""
    folder = versions.current(spark, path)
    return folder is not None and all(path_exists(spark, f"{folder}/split={s}") for s in ("train", "val"))


def write_shards(sharded: DataFrame, path: str, mode: str = "skip") -> bool:
    """Write one file per shard; `skip` leaves a complete corpus alone, `reset` replaces it.

    Returns whether anything was written. A corpus whose rows all fell into the held-out split
    is refused, for there would be nothing to train on; the one before stays.
    """
    spark = sharded.sparkSession
    if mode not in ("skip", "reset"):
        raise ValueError("mode must be 'skip' or 'reset'")
    if mode == "skip" and is_complete(spark, path):
        return False

    def write(folder: str) -> None:
        (
            sharded.repartition("split", "shard").sortWithinPartitions("split", "shard", "pos")
            .write.partitionBy("split", "shard").parquet(folder)
        )
        if not path_exists(spark, f"{folder}/split=train"):
            raise ValueError("no training rows: the corpus is no larger than the held-out split")

    versions.replace(spark, path, write)
    return True


def read_shards(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """The corpus, or one split of it; other splits are not even listed."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(versions.need_current(spark, path))
    return shards if split is None else shards.where(F.col("split") == split)


def list_shards(spark: SparkSession, path: str) -> DataFrame:
    """Shards in order with their row counts."""
    return (
        read_shards(spark, path).groupBy("split", "shard").agg(F.count(F.lit(1)).alias("n"))
        .orderBy("split", "shard")
    )


def load_documents(
    spark: SparkSession, path: str, max_rows: int | None = None, shard_rows: int = fixed.SHARD_ROWS
) -> DataFrame:
    """Training documents; with `max_rows` the first ones in shard order.

    Positions are dense, so the cap is a filter; shards behind it are pruned.
    """
    train = read_shards(spark, path, "train")
    if max_rows is None:
        return train
    return train.where((F.col("shard") <= -(-max_rows // shard_rows)) & (F.col("pos") < max_rows))
