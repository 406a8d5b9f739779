"""Report tables as files, for people and for programs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str, form: str = "json") -> None:
    """A report as JSON lines, Parquet, or aligned-by-tab text with a header line in each file."""
    if form == "json":
        report.write.mode("overwrite").json(path)
    elif form == "parquet":
        report.write.mode("overwrite").parquet(path)
    elif form == "text":
        report.write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
    else:
        raise ValueError("form must be 'json', 'parquet' or 'text'")


def display_lines(report: DataFrame, order: list[str]) -> DataFrame:
    """A small report as ordered text lines `column=value ...`."""
    cells = [F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in report.columns]
    return report.orderBy(*order).select(F.concat_ws("  ", *cells).alias("value"))
