"""Numbers scraped from the text that training runs print."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.functions import text as tx

_NUMBERS = {
    "val_bpb": "double", "training_seconds": "double", "total_seconds": "double", "peak_vram_mb": "double",
    "mfu_percent": "double", "total_tokens_M": "double", "num_steps": "long", "num_params_M": "double",
    "depth": "long", "train_batch_size": "long", "eval_batch_size": "long",
}


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of log files with their run; a carriage return ends a line as a line feed does."""
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("run_tag"), "value",
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("line"),
    )


def parse_summaries(lines: DataFrame) -> DataFrame:
    """One row per run from its `key: value` lines; a run that printed none has only NULLs.

    `lines` has run_tag, value and line, which orders the lines of a run: of a key that is printed
    again the last value counts. Runs and values come from one pass and one grouping.
    """
    pattern = rf"^({'|'.join(fixed.SUMMARY_KEYS)}):\s+(.*)$"
    cut = lines.select(
        "run_tag", "line",
        F.regexp_extract("value", pattern, 1).alias("key"),
        tx.strip(F.regexp_extract("value", pattern, 2)).alias("text"),
    )
    last = [
        F.max(F.when(F.col("key") == k, F.struct("line", "text")))["text"].alias(k) for k in fixed.SUMMARY_KEYS
    ]
    typed = [
        F.col(k).try_cast(_NUMBERS[k]).alias(k) if k in _NUMBERS else F.col(k) for k in fixed.SUMMARY_KEYS
    ]
    return cut.groupBy("run_tag").agg(*last).select("run_tag", *typed)


def parse_steps(lines: DataFrame) -> DataFrame:
    """One row per progress line; `mfu: n/a` is NULL.

    A line is matched once and cut once; its fields then have fixed names in front of them.
    """
    found = lines.where(F.col("value").rlike(fixed.STEP_PATTERN))
    start = F.regexp_instr("value", F.lit(fixed.STEP_PATTERN))
    fields = F.split(F.substring("value", start, F.length("value")), " \\| ")
    cut = tx.once(found, {"_f": fields})

    def field(i: int, name: str, unit: str = "") -> Column:
        return F.substring_index(F.substr(F.col("_f")[i], F.lit(len(name) + 1)), unit or " ", 1)

    return cut.select(
        "run_tag",
        field(0, "step ").cast("long").alias("step"),
        F.substring_index(F.substring_index(F.col("_f")[0], "(", -1), "%", 1).cast("double").alias("pct_done"),
        field(1, "loss: ").try_cast("double").alias("loss"),
        field(2, "lrm: ").cast("double").alias("lrm"),
        field(3, "dt: ", "ms").cast("int").alias("dt_ms"),
        F.replace(field(4, "tok/sec: "), F.lit(","), F.lit("")).cast("long").alias("tok_per_sec"),
        field(5, "mfu: ", "%").try_cast("double").alias("mfu"),
        field(6, "epoch: ").cast("int").alias("epoch"),
        field(7, "remaining: ", "s").cast("int").alias("remaining_s"),
    )
