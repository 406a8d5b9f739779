"""All report tables of an experiment log."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sheafmill.operators import experiments as ex


def experiment_report(results: DataFrame) -> dict[str, DataFrame]:
    return {
        "outcomes": ex.outcome_counts(results),
        "keep_rate": ex.keep_rate(results),
        "kept": ex.kept(results),
        "progress": ex.progress(results),
        "axis": ex.chart_axis(results),
        "summary": ex.summary(results),
        "effort": ex.effort_per_improvement(results),
        "top_hits": ex.top_hits(results),
        "total_gain": ex.total_gain(results),
        "winner": ex.winner(results),
        "population": ex.population(results),
    }


def preview(results: DataFrame, rows: int = 10) -> DataFrame:
    """The first rows of each log."""
    return results.where(results["seq"] < rows).orderBy(ex.RUN, "seq")
