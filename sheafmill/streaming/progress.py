"""Best value and outcome counts per run while experiments are still being logged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sheafmill.operators.experiments import RUN, is_status
from sheafmill.sources import versions


def live_progress(results: DataFrame) -> DataFrame:
    """The running aggregate of a stream of log rows; its state is one row per run."""
    return results.groupBy(RUN).agg(
        F.count(F.lit(1)).alias("n_experiments"),
        F.count_if(is_status("KEEP")).alias("n_keep"),
        F.count_if(is_status("DISCARD")).alias("n_discard"),
        F.count_if(is_status("CRASH")).alias("n_crash"),
        F.min(F.when(is_status("KEEP"), F.col("val_bpb"))).alias("best_bpb"),
    )


def progress_stream(progress: DataFrame, table: str, checkpoint: str) -> DataStreamWriter:
    """Keep a table of all runs up to date, a version for each batch; call `start` on the result."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        versions.replace(batch.sparkSession, table, batch.write.parquet)

    return (
        progress.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
        .foreachBatch(replace)
    )


def read_progress(spark: SparkSession, table: str) -> DataFrame:
    """The table as of the last finished batch."""
    return spark.read.parquet(versions.need_current(spark, table))
