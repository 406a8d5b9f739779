"""Analytics over experiment logs; every operator works per run and on any number of runs.

Input columns: run_tag, seq (line order, unique per run), commit, val_bpb, memory_gb, status,
description.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sheafmill import fixed
from sheafmill.functions import text as tx
from sheafmill.operators.ordered import CHUNK_ROWS, running, top_per_group, with_rank

RUN = "run_tag"


def normalised(results: DataFrame) -> DataFrame:
    """Numbers parsed tolerantly, status stripped and upper-cased."""
    return results.withColumns(
        {
            "val_bpb": tx.number("val_bpb"),
            "memory_gb": tx.number("memory_gb"),
            "status": tx.status_label("status"),
        }
    )


def is_status(label: str) -> Column:
    """True or false, never NULL: a missing status is no status at all."""
    return F.col("status").eqNullSafe(F.lit(label))


def outcome_counts(results: DataFrame) -> DataFrame:
    return results.groupBy(RUN, "status").agg(F.count(F.lit(1)).alias("n"))


def keep_rate(results: DataFrame) -> DataFrame:
    counts = results.groupBy(RUN).agg(
        F.count_if(is_status("KEEP")).alias("n_keep"),
        F.count_if(is_status("DISCARD")).alias("n_discard"),
        F.count_if(is_status("CRASH")).alias("n_crash"),
    )
    decided = F.col("n_keep") + F.col("n_discard")
    return counts.withColumn("keep_rate", F.try_divide(F.col("n_keep"), decided))


def kept(results: DataFrame) -> DataFrame:
    return results.where(is_status("KEEP"))


def survived(results: DataFrame) -> DataFrame:
    return results.where(~is_status("CRASH"))


def progress(results: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Chart rows: surviving experiments renumbered from 0, with the running best of kept ones."""
    kept_value = F.when(is_status("KEEP"), F.col("val_bpb"))
    placed = running(
        survived(results),
        [RUN],
        "seq",
        {
            "idx": ("count", F.lit(1)), "running_best": ("min", kept_value),
            "chart_baseline": ("first", F.struct("val_bpb")),
        },
        chunk_rows=chunk_rows,
    )
    # The best so far shows only where a kept value was added.
    charted = placed.withColumns(
        {
            "idx": F.col("idx") - 1,
            "running_best": F.when(kept_value.isNotNull(), F.col("running_best")),
            "label": F.when(is_status("KEEP"), tx.chart_label("description")),
            "chart_baseline": F.col("chart_baseline.val_bpb"),
        }
    )
    labelled = charted.select(*[c for c in charted.columns if c != "chart_baseline"], "chart_baseline")
    return labelled.withColumn(
        "is_below", F.coalesce(F.col("val_bpb") <= F.col("chart_baseline") + fixed.BASELINE_MARGIN, F.lit(False))
    )


def below_baseline(results: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Surviving experiments at or below the first surviving one, with a small margin.

    The first one rides along in sequence order, so a run of any size stays spread over chunks.
    """
    first = {"chart_baseline": ("first", F.struct("val_bpb"))}
    placed = running(survived(results), [RUN], "seq", first, chunk_rows=chunk_rows)
    known = placed.withColumn("chart_baseline", F.col("chart_baseline.val_bpb"))
    return known.where(F.col("val_bpb") <= F.col("chart_baseline") + fixed.BASELINE_MARGIN)


def chart_axis(results: DataFrame) -> DataFrame:
    """Vertical range of the progress chart: best to baseline with a margin on both sides."""
    ends = results.groupBy(RUN).agg(
        F.min_by(
            F.when(~is_status("CRASH"), F.col("val_bpb")),
            F.when(~is_status("CRASH"), F.col("seq")),
        ).alias("chart_baseline"),
        F.min(F.when(is_status("KEEP"), F.col("val_bpb"))).alias("best_bpb"),
    )
    margin = (F.col("chart_baseline") - F.col("best_bpb")) * fixed.AXIS_MARGIN
    return ends.withColumns(
        {"axis_low": F.col("best_bpb") - margin, "axis_high": F.col("chart_baseline") + margin}
    )


def hit_deltas(results: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Kept experiments after a run's first, with the gain over the kept one before.

    The previous value rides in a struct so that a missing value still counts as the previous one.
    """
    linked = running(
        kept(results), [RUN], "seq",
        {"_before": ("last", F.struct("val_bpb", "seq"))},
        inclusive=False,
        chunk_rows=chunk_rows,
    )
    return (
        linked.where(F.col("_before").isNotNull())
        .withColumns(
            {
                "prev_bpb": F.col("_before.val_bpb"),
                "delta": F.col("_before.val_bpb") - F.col("val_bpb"),
            }
        )
        .drop("_before")
    )


def top_hits(results: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Kept experiments ranked by gain."""
    return with_rank(
        hit_deltas(results, chunk_rows), [RUN],
        [F.col("delta").desc_nulls_last(), F.col("seq").asc()],
    )


def total_gain(results: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    return hit_deltas(results, chunk_rows).groupBy(RUN).agg(
        F.count(F.lit(1)).alias("n_hits"), F.sum("delta").alias("total_delta")
    )


def effort_per_improvement(results: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Kept experiments with their number in the log and the experiments spent since the last one."""
    linked = running(
        kept(results), [RUN], "seq", {"_before": ("last", F.col("seq"))},
        inclusive=False, chunk_rows=chunk_rows,
    )
    return linked.withColumn("effort", F.col("seq") - F.col("_before")).drop("_before")


def summary(results: DataFrame) -> DataFrame:
    """One row per run: counts, baseline, best kept experiment and improvement."""
    scored = is_status("KEEP") & F.col("val_bpb").isNotNull()
    rank = F.when(scored, F.struct("val_bpb", "seq"))
    per_run = results.groupBy(RUN).agg(
        F.count(F.lit(1)).alias("n_experiments"),
        F.count_if(is_status("KEEP")).alias("n_keep"),
        F.count_if(is_status("DISCARD")).alias("n_discard"),
        F.count_if(is_status("CRASH")).alias("n_crash"),
        F.min_by("val_bpb", "seq").alias("baseline_bpb"),
        F.min(rank).alias("_best"),
        F.min_by("description", rank).alias("best_description"),
    )
    gain = F.col("baseline_bpb") - F.col("_best.val_bpb")
    return per_run.select(
        RUN, "n_experiments", "n_keep", "n_discard", "n_crash",
        F.try_divide(F.col("n_keep"), F.col("n_keep") + F.col("n_discard")).alias("keep_rate"),
        "baseline_bpb",
        F.col("_best.val_bpb").alias("best_bpb"),
        F.col("_best.seq").alias("best_seq"),
        "best_description",
        gain.alias("improvement"),
        (F.try_divide(gain, F.col("baseline_bpb")) * 100).alias("improvement_pct"),
    )


def winner(results: DataFrame) -> DataFrame:
    """The kept experiment with the lowest value of each run; the earlier one wins a tie."""
    scored = kept(results).where(F.col("val_bpb").isNotNull())
    best = F.min_by(F.struct("commit", "val_bpb", "seq", "description"), F.struct("val_bpb", "seq"))
    return scored.groupBy(RUN).agg(best.alias("_w")).select(RUN, "_w.*")


def population(results: DataFrame, size: int = fixed.POPULATION) -> DataFrame:
    """The best `size` surviving experiments of each run."""
    scored = survived(results).where(F.col("val_bpb").isNotNull())
    return top_per_group(scored, [RUN], [F.col("val_bpb"), F.col("seq")], size)


def log_rows(summaries: DataFrame) -> DataFrame:
    """Experiment-log numbers from run summaries; a run without a score is a crash."""
    crashed = F.col("val_bpb").isNull()
    return summaries.withColumns(
        {
            "val_bpb": F.when(crashed, 0.0).otherwise(F.round("val_bpb", 6)),
            "memory_gb": F.when(crashed, 0.0).otherwise(tx.gigabytes("peak_vram_mb")),
            "is_crash": crashed,
        }
    )


# --- step telemetry: run_tag, step (from 0, unique per run), loss, dt_s, tokens ---


def smoothed_loss(steps: DataFrame, beta: float = fixed.EMA_BETA) -> DataFrame:
    """Exponential moving average of the loss in step order, and its bias-corrected form.

    Inside a block of steps the average is a prefix sum of x_i * beta**-i scaled back. A block
    inherits the averages its predecessors ended with, weighted by beta**(rows between); weights
    beyond `horizon` rows are exactly zero in double arithmetic, so nothing is left out. A loss that is
    no finite number never leaves the average again, as in the recursion.
    """
    broken = F.isnan("loss") | (F.abs("loss") == float("inf"))
    marked = running(steps, [RUN], "step", {"_broken": ("sum", F.when(broken, F.col("loss")))})
    columns = steps.columns
    steps = marked.withColumns(
        {"_loss": F.col("loss"), "loss": F.when(broken, F.lit(0.0)).otherwise(F.col("loss"))}
    )
    per_digit = -1 / math.log10(beta)
    block_rows = max(1, min(2000, int(100 * per_digit)))
    horizon = int(650 * per_digit) + block_rows
    blocked = steps.withColumn("_block", F.floor(F.col("step") / block_rows))
    local = W.partitionBy(RUN, "_block").orderBy("step")
    inside = blocked.withColumn("_i", F.row_number().over(local) - 1).withColumn(
        "_own",
        (1 - beta)
        * F.pow(F.lit(beta), F.col("_i"))
        * F.sum(F.col("loss") * F.pow(F.lit(beta), -F.col("_i"))).over(
            local.rowsBetween(W.unboundedPreceding, W.currentRow)
        ),
    )
    ends = inside.groupBy(RUN, "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.max_by("_own", "_i").alias("_end")
    )
    in_run = W.partitionBy(RUN).orderBy("_block")
    ends = ends.withColumn("_stop", F.sum("_n").over(in_run)).withColumn("_start", F.col("_stop") - F.col("_n"))
    recent = W.partitionBy(RUN).orderBy("_start").rangeBetween(-horizon, -1)
    ends = ends.select(
        RUN, "_block", "_start", F.collect_list(F.struct("_end", "_stop")).over(recent).alias("_past")
    ).select(
        RUN, "_block",
        F.aggregate(
            "_past", F.lit(0.0),
            lambda acc, p: acc + p["_end"] * F.pow(F.lit(beta), F.col("_start") - p["_stop"]),
        ).alias("_carry"),
    )
    smooth = F.coalesce(
        F.col("_broken"), F.col("_own") + F.col("_carry") * F.pow(F.lit(beta), F.col("_i") + 1)
    )
    return (
        inside.join(ends, [RUN, "_block"])
        .withColumn("smooth_loss", smooth)
        .withColumn(
            "debiased_loss", F.col("smooth_loss") / (1 - F.pow(F.lit(beta), F.col("step") + 1))
        )
        .withColumn("loss", F.col("_loss"))
        .select(*columns, "smooth_loss", "debiased_loss")
    )


def training_time(steps: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Seconds of training up to each step, start-up steps not counted."""
    counted = F.when(F.col("step") > fixed.WARMUP_STEPS, F.col("dt_s")).otherwise(0.0)
    return running(steps, [RUN], "step", {"train_s": ("sum", counted)}, chunk_rows=chunk_rows)


def throughput(steps: DataFrame) -> DataFrame:
    """Tokens per second of every step, whole number."""
    return steps.withColumn(
        "tok_per_sec", F.floor(F.try_divide(F.col("tokens"), F.col("dt_s"))).cast("long")
    )


def utilisation(steps: DataFrame, flops_per_token: Column, peak_flops: Column) -> DataFrame:
    """Steady-state use of the peak rate per run, in percent.

    `mfu` divides by one step more than was timed, as the logs do; `mfu_timed` by the timed steps.
    NULL when the peak is unknown or nothing was timed.
    """
    timed = F.col("step") > fixed.WARMUP_STEPS
    per_run = steps.groupBy(RUN).agg(
        (F.max("step") + 1).alias("n_steps"),
        F.count_if(timed).alias("n_timed"),
        F.sum(F.when(timed, F.col("dt_s")).otherwise(0.0)).alias("train_s"),
        F.sum("tokens").alias("total_tokens"),
        F.max("tokens").alias("_batch"),
        F.max(flops_per_token).alias("_flops"),
        F.max(peak_flops).alias("_peak"),
    )
    steady = F.greatest(F.col("n_steps") - fixed.WARMUP_STEPS, F.lit(0))

    def percent(count: Column) -> Column:
        work = 100.0 * F.col("_flops") * F.col("_batch") * count
        share = F.try_divide(F.try_divide(work, F.col("train_s")), F.col("_peak"))
        return F.when((F.col("_peak") > 0) & (F.col("train_s") > 0) & (steady > 0), share)

    return per_run.select(
        RUN, "n_steps", "n_timed", "train_s", "total_tokens",
        percent(steady).alias("mfu"), percent(F.col("n_timed")).alias("mfu_timed"),
    )


def exploded(steps: DataFrame) -> DataFrame:
    """Steps whose loss is beyond the limit or no number."""
    return steps.where((F.col("loss") > fixed.LOSS_LIMIT) | F.isnan("loss"))
