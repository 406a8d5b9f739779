"""Experiment logs as tab-separated text, one file per run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.operators.experiments import normalised
from sheafmill.functions import text as tx
from sheafmill.operators.ordered import with_rank
from sheafmill.sources import versions

STATUSES = ("keep", "discard", "crash", "keep-sa")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Log rows in line order; the run is the folder `run_tag=...` or else the file.

    A log is cut at tabs, not parsed as quoted text: descriptions may hold quotes and commas.
    Files of one run follow each other by the number of the append that wrote them, then by name.
    """
    text = spark.read.text(path)
    run = F.col("run_tag").cast("string") if "run_tag" in text.columns else F.col("_metadata.file_path")
    append = F.col("append").cast("long") if "append" in text.columns else F.lit(0)
    lines = text.select(
        "value",
        run.alias("run_tag"),
        F.struct(
            append.alias("append"), "_metadata.file_path", "_metadata.file_block_start",
            F.monotonically_increasing_id().alias("line"),
        ).alias("_at"),
    )
    header = "\t".join(fixed.RESULT_COLUMNS)
    body = lines.where((F.col("value") != header) & (tx.strip("value") != ""))
    placed = with_rank(body, ["run_tag"], [F.col("_at")], "_n")
    cells = F.split("value", "\t", len(fixed.RESULT_COLUMNS))
    columns = [F.get(cells, F.lit(i)).alias(name) for i, name in enumerate(fixed.RESULT_COLUMNS)]
    return normalised(placed.select("run_tag", (F.col("_n") - 1).alias("seq"), *columns))


def invalid_rows(results: DataFrame) -> DataFrame:
    """Rows that must not enter a log: an unknown status, or a tab or line end in a text."""
    bad_text = F.concat_ws("", "commit", "description").rlike(r"[\t\r\n]")
    known = tx.strip(F.lower("status")).isin(*STATUSES)
    return results.where(bad_text | ~F.coalesce(known, F.lit(False)))


def write_results(results: DataFrame, path: str, mode: str = "append", files: int | None = None) -> None:
    """Append log rows as text, values with six decimals and memory with one.

    A crash without a score is written as 0; a score missing from any other row stays missing.
    Every append is a folder with a number that it alone could take, so that lines keep their order
    whichever file is finished first, and appends at the same time do not meet. Mode `overwrite`
    replaces the whole log.
    """
    if not invalid_rows(results).isEmpty():
        raise ValueError("log rows with an unknown status, or with tabs or line ends in a text")
    crash = tx.strip(F.lower("status")) == "crash"

    def shown(form: str, column: str) -> Column:
        value = F.when(crash, F.coalesce(column, F.lit(0.0))).otherwise(F.col(column))
        return F.when(value.isNull(), "").otherwise(F.format_string(form, value))

    line = F.concat_ws(
        "\t",
        "commit",
        shown("%.6f", "val_bpb"),
        shown("%.1f", "memory_gb"),
        F.lower(tx.strip("status")),
        F.coalesce("description", F.lit("")),
    )
    # Ranges of (run, line): a long run becomes several files whose names follow its order.
    rows = results.select("run_tag", "seq", line.alias("value"))
    rows = rows.repartitionByRange(*([files] if files else []), "run_tag", "seq").sortWithinPartitions("run_tag", "seq")
    if mode != "append":
        rows = rows.select(F.lit(0).alias("append"), "run_tag", "value")
        rows.write.mode(mode).partitionBy("append", "run_tag").text(path)
        return
    spark = results.sparkSession
    written = versions.numbers(spark, path, "append=")
    number = versions.take_number(spark, f"{path}/_claims", max(written, default=-1) + 1)
    rows.select("run_tag", "value").write.partitionBy("run_tag").text(f"{path}/append={number}")
