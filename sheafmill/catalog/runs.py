"""Queries about experiment logs, step telemetry and search replays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.catalog.base import CHUNK_ROWS, RESULTS_SQL, query, raw_results, rounded, table
from sheafmill.functions import text as tx
from sheafmill.operators import experiments, replay


def results(spark: SparkSession, d: str) -> DataFrame:
    return experiments.normalised(raw_results(spark, d))


@query("results_normalised", f"WITH {RESULTS_SQL} SELECT * FROM results")
def results_normalised(spark: SparkSession, d: str) -> DataFrame:
    return results(spark, d)


@query("outcome_counts", f"WITH {RESULTS_SQL} SELECT run_tag, status, count(*) AS n FROM results GROUP BY ALL")
def outcome_counts(spark: SparkSession, d: str) -> DataFrame:
    return experiments.outcome_counts(results(spark, d))


_COUNTS_SQL = """count(*) FILTER (WHERE status = 'KEEP') AS n_keep,
    count(*) FILTER (WHERE status = 'DISCARD') AS n_discard,
    count(*) FILTER (WHERE status = 'CRASH') AS n_crash"""


@query(
    "keep_rate",
    f"""WITH {RESULTS_SQL}, c AS (SELECT run_tag, {_COUNTS_SQL} FROM results GROUP BY run_tag)
    SELECT *, round(n_keep / nullif(n_keep + n_discard, 0), 6) AS keep_rate FROM c""",
)
def keep_rate(spark: SparkSession, d: str) -> DataFrame:
    return rounded(experiments.keep_rate(results(spark, d)), "keep_rate")


@query(
    "kept_experiments",
    f"WITH {RESULTS_SQL} SELECT run_tag, seq, val_bpb, memory_gb, description FROM results WHERE status = 'KEEP'",
)
def kept_experiments(spark: SparkSession, d: str) -> DataFrame:
    return experiments.kept(results(spark, d)).select("run_tag", "seq", "val_bpb", "memory_gb", "description")


_CHART_SQL = f"""{RESULTS_SQL},
valid AS (SELECT *, row_number() OVER w - 1 AS idx, first_value(val_bpb) OVER w AS chart_baseline,
                 CASE WHEN status = 'KEEP' THEN min(CASE WHEN status = 'KEEP' THEN val_bpb END) OVER w END AS running_best
          FROM results WHERE status <> 'CRASH' WINDOW w AS (PARTITION BY run_tag ORDER BY seq))"""


@query(
    "running_best",
    f"WITH {_CHART_SQL} SELECT run_tag, seq, val_bpb, running_best FROM valid WHERE status = 'KEEP'",
)
def running_best(spark: SparkSession, d: str) -> DataFrame:
    charted = experiments.progress(results(spark, d), CHUNK_ROWS)
    return charted.where(experiments.is_status("KEEP")).select("run_tag", "seq", "val_bpb", "running_best")


@query(
    "progress_chart",
    f"""WITH {_CHART_SQL} SELECT run_tag, idx, seq, val_bpb, status, running_best,
    val_bpb <= chart_baseline + 0.0005 AS is_below,
    CASE WHEN status = 'KEEP' THEN CASE WHEN length(trim(description)) > 45
         THEN left(trim(description), 42) || '...' ELSE trim(description) END END AS label FROM valid""",
)
def progress_chart(spark: SparkSession, d: str) -> DataFrame:
    return experiments.progress(results(spark, d), CHUNK_ROWS).select(
        "run_tag", "idx", "seq", "val_bpb", "status", "running_best", "is_below", "label"
    )


@query(
    "below_baseline",
    f"WITH {_CHART_SQL} SELECT run_tag, seq, val_bpb, status FROM valid WHERE val_bpb <= chart_baseline + 0.0005",
)
def below_baseline(spark: SparkSession, d: str) -> DataFrame:
    return experiments.below_baseline(results(spark, d), CHUNK_ROWS).select("run_tag", "seq", "val_bpb", "status")


@query(
    "chart_axis",
    f"""WITH {_CHART_SQL}, e AS (SELECT run_tag, any_value(chart_baseline) AS b,
        min(val_bpb) FILTER (WHERE status = 'KEEP') AS m FROM valid GROUP BY run_tag)
    SELECT run_tag, b AS chart_baseline, m AS best_bpb, round(m - (b - m) * 0.15e0, 6) AS axis_low,
           round(b + (b - m) * 0.15e0, 6) AS axis_high FROM e""",
)
def chart_axis(spark: SparkSession, d: str) -> DataFrame:
    return rounded(experiments.chart_axis(results(spark, d)), "axis_low", "axis_high")


_HITS_SQL = f"""{RESULTS_SQL},
linked AS (SELECT *, lag(val_bpb) OVER w AS prev_bpb, lag(seq) OVER w AS prev_seq, row_number() OVER w AS kept_no
           FROM results WHERE status = 'KEEP' WINDOW w AS (PARTITION BY run_tag ORDER BY seq)),
hits AS (SELECT *, prev_bpb - val_bpb AS delta FROM linked WHERE kept_no > 1)"""


@query(
    "top_hits",
    f"""WITH {_HITS_SQL} SELECT run_tag, seq, val_bpb, round(delta, 6) AS delta, description,
    row_number() OVER (PARTITION BY run_tag ORDER BY delta DESC NULLS LAST, seq) AS rank FROM hits""",
)
def top_hits(spark: SparkSession, d: str) -> DataFrame:
    ranked = experiments.top_hits(results(spark, d), CHUNK_ROWS)
    return rounded(ranked, "delta").select("run_tag", "seq", "val_bpb", "delta", "description", "rank")


@query(
    "total_gain",
    f"""WITH {_HITS_SQL} SELECT run_tag, count(*) AS n_hits, round(sum(delta), 6) AS total_delta
    FROM hits GROUP BY run_tag""",
)
def total_gain(spark: SparkSession, d: str) -> DataFrame:
    return rounded(experiments.total_gain(results(spark, d), CHUNK_ROWS), "total_delta")


@query(
    "effort_per_improvement",
    f"WITH {_HITS_SQL} SELECT run_tag, seq, val_bpb, seq - prev_seq AS effort, description FROM linked",
)
def effort_per_improvement(spark: SparkSession, d: str) -> DataFrame:
    return experiments.effort_per_improvement(results(spark, d), CHUNK_ROWS).select(
        "run_tag", "seq", "val_bpb", "effort", "description"
    )


@query(
    "summary",
    f"""WITH {RESULTS_SQL}, c AS (
      SELECT run_tag, count(*) AS n_experiments, {_COUNTS_SQL}, arg_min(val_bpb, seq) AS baseline_bpb,
             min(val_bpb) FILTER (WHERE status = 'KEEP') AS best_bpb FROM results GROUP BY run_tag),
    b AS (SELECT run_tag, seq AS best_seq, description AS best_description FROM results WHERE status = 'KEEP'
          QUALIFY row_number() OVER (PARTITION BY run_tag ORDER BY val_bpb, seq) = 1)
    SELECT c.*, best_seq, best_description, round(n_keep / nullif(n_keep + n_discard, 0), 6) AS keep_rate,
           round(baseline_bpb - best_bpb, 6) AS improvement,
           CASE WHEN baseline_bpb <> 0 THEN round((baseline_bpb - best_bpb) / baseline_bpb * 100, 6) END
             AS improvement_pct
    FROM c LEFT JOIN b USING (run_tag)""",
)
def summary(spark: SparkSession, d: str) -> DataFrame:
    return rounded(experiments.summary(results(spark, d)), "keep_rate", "improvement", "improvement_pct")


@query(
    "winner",
    f"""WITH {RESULTS_SQL} SELECT run_tag, commit, val_bpb, seq, description FROM results WHERE status = 'KEEP'
    QUALIFY row_number() OVER (PARTITION BY run_tag ORDER BY val_bpb, seq) = 1""",
)
def winner(spark: SparkSession, d: str) -> DataFrame:
    return experiments.winner(results(spark, d))


@query(
    "population_top5",
    f"""WITH {RESULTS_SQL}, r AS (SELECT run_tag, commit, val_bpb, seq,
        row_number() OVER (PARTITION BY run_tag ORDER BY val_bpb, seq) AS rank FROM results WHERE status <> 'CRASH')
    SELECT * FROM r WHERE rank <= 5""",
)
def population_top5(spark: SparkSession, d: str) -> DataFrame:
    return experiments.population(results(spark, d)).select("run_tag", "commit", "val_bpb", "seq", "rank")


@query(
    "population_replay",
    f"""WITH {RESULTS_SQL},
    p AS (SELECT run_tag, seq, val_bpb, status, list_sort(list({{'v': val_bpb, 's': seq, 'c': commit}})
                 FILTER (WHERE status <> 'CRASH') OVER (PARTITION BY run_tag ORDER BY seq)) AS seen,
          FROM results),
    q AS (SELECT *, status <> 'CRASH' AND list_contains(list_transform(seen[1:5], lambda x: x.s), seq) AS entered FROM p)
    SELECT run_tag, seq, val_bpb, entered, CASE WHEN entered AND len(seen) > 5 THEN seen[6].c END AS evicted,
           array_to_string(list_transform(seen[1:5], lambda x: x.c), ' ') AS members FROM q""",
)
def population_replay(spark: SparkSession, d: str) -> DataFrame:
    return replay.population_replay(results(spark, d), chunk_rows=CHUNK_ROWS).select(
        "run_tag", "seq", "val_bpb", "entered", "evicted",
        F.nullif(F.array_join(F.transform("members", lambda m: m["commit"]), " "), F.lit("")).alias("members"),
    )


@query(
    "annealing_replay",
    f"""WITH RECURSIVE {RESULTS_SQL},
    ordered AS (
      SELECT run_tag, seq, status, val_bpb, row_number() OVER (PARTITION BY run_tag ORDER BY seq) AS i,
             ('0x' || substring(md5('42:' || run_tag || ':' || seq), 1, 8))::BIGINT / 4294967296e0 AS draw
      FROM results),
    walk AS (
      SELECT run_tag, 0::BIGINT AS i, (-1)::BIGINT AS seq, '' AS decision, 0.005e0 AS t, 'inf'::DOUBLE AS best,
             'inf'::DOUBLE AS cur, 0::BIGINT AS idle, 0::BIGINT AS cnt
      FROM (SELECT DISTINCT run_tag FROM results)
      UNION ALL
      SELECT run_tag, i, seq, decision,
             CASE WHEN decision = 'crash' THEN t WHEN idle >= 15 THEN 0.003e0 ELSE t * 0.97e0 END,
             CASE WHEN decision = 'accept' THEN least(best, val_bpb) ELSE best END,
             CASE WHEN decision IN ('accept', 'accept-sa') THEN val_bpb ELSE cur END,
             CASE WHEN decision <> 'crash' AND idle >= 15 THEN 0 ELSE idle END,
             CASE WHEN decision = 'crash' THEN cnt ELSE cnt + 1 END
      FROM (SELECT *, CASE WHEN decision = 'crash' THEN was WHEN decision = 'accept' THEN 0 ELSE was + 1 END AS idle
            FROM (SELECT w.run_tag, o.i, o.seq, o.val_bpb, w.t, w.best, w.cur, w.idle AS was, w.cnt,
                         CASE WHEN o.status = 'CRASH' THEN 'crash' WHEN o.val_bpb < w.cur THEN 'accept'
                              WHEN o.draw < exp(-(o.val_bpb - w.cur) / w.t) THEN 'accept-sa'
                              ELSE 'discard' END AS decision
                  FROM walk w JOIN ordered o ON o.run_tag = w.run_tag AND o.i = w.i + 1)))
    SELECT run_tag, seq, decision, round(t, 9) AS temperature,
           CASE WHEN isinf(best) THEN NULL ELSE best END AS best_val_bpb,
           CASE WHEN isinf(cur) THEN NULL ELSE cur END AS current_val_bpb,
           idle AS no_improve_count, cnt AS experiment_count FROM walk WHERE i > 0""",
)
def annealing_replay(spark: SparkSession, d: str) -> DataFrame:
    walked = replay.annealing(results(spark, d))
    return rounded(walked, "temperature", places=9).withColumns(
        {
            c: F.when(F.col(c) != float("inf"), F.col(c))
            for c in ("best_val_bpb", "current_val_bpb")
        }
    )


@query(
    "memory_gb",
    "SELECT o_orderkey, round(o_totalprice / 1024e0, 1) AS memory_gb FROM orders",
)
def memory_gb(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", tx.gigabytes("o_totalprice").alias("memory_gb"))


# --- step telemetry: one run per supplier hash, one step per line item ---

_STEPS_SQL = """steps AS (
  SELECT concat('run', l_suppkey % 3) AS run_tag,
         row_number() OVER (PARTITION BY l_suppkey % 3 ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS step,
         2 + l_discount * 10 + l_tax AS loss, 0.2 + l_quantity / 1000 AS dt_s, 32768 AS tokens
  FROM lineitem)"""


def steps(spark: SparkSession, d: str) -> DataFrame:
    from sheafmill.operators.ordered import with_rank

    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    items = table(spark, d, "lineitem").select(
        F.expr("concat('run', l_suppkey % 3)").alias("run_tag"), *keys, "l_discount", "l_tax", "l_quantity"
    )
    order = [F.col(c) for c in keys]
    return with_rank(items, ["run_tag"], order, "step").selectExpr(
        "run_tag", "step - 1 AS step", "2 + l_discount * 10 + l_tax AS loss",
        "0.2e0 + l_quantity / 1000 AS dt_s", "32768L AS tokens",
    )


@query(
    "smoothed_loss",
    f"""WITH {_STEPS_SQL},
    weighted AS (SELECT a.run_tag, a.step, sum(0.1e0 * pow(0.9e0, a.step - b.step) * b.loss) AS smooth
                 FROM steps a JOIN steps b ON a.run_tag = b.run_tag AND b.step BETWEEN a.step - 400 AND a.step
                 GROUP BY ALL)
    SELECT run_tag, step, round(smooth, 6) AS smooth_loss,
           round(smooth / (1 - pow(0.9e0, step + 1)), 6) AS debiased_loss FROM weighted""",
)
def smoothed_loss(spark: SparkSession, d: str) -> DataFrame:
    smooth = experiments.smoothed_loss(steps(spark, d))
    return rounded(smooth.select("run_tag", "step", "smooth_loss", "debiased_loss"), "smooth_loss", "debiased_loss")


@query(
    "training_time",
    f"""WITH {_STEPS_SQL} SELECT run_tag, step, round(sum(CASE WHEN step > 10 THEN dt_s ELSE 0 END)
    OVER (PARTITION BY run_tag ORDER BY step), 4) AS train_s FROM steps""",
)
def training_time(spark: SparkSession, d: str) -> DataFrame:
    timed = experiments.training_time(steps(spark, d), CHUNK_ROWS).select("run_tag", "step", "train_s")
    return rounded(timed, "train_s", places=4)


@query(
    "throughput",
    f"WITH {_STEPS_SQL} SELECT run_tag, step, floor(tokens / dt_s)::BIGINT AS tok_per_sec FROM steps",
)
def throughput(spark: SparkSession, d: str) -> DataFrame:
    return experiments.throughput(steps(spark, d)).select("run_tag", "step", "tok_per_sec")


@query(
    "utilisation",
    f"""WITH {_STEPS_SQL}, c AS (SELECT run_tag, max(step) + 1 AS n_steps,
      count(*) FILTER (WHERE step > 10) AS n_timed, sum(CASE WHEN step > 10 THEN dt_s ELSE 0 END) AS t,
      sum(tokens)::BIGINT AS total_tokens FROM steps GROUP BY run_tag)
    SELECT run_tag, n_steps, n_timed, round(t, 4) AS train_s, total_tokens,
      round(100 * 3e8 * 32768 * greatest(n_steps - 10, 0) / t / 1e14, 6) AS mfu,
      round(100 * 3e8 * 32768 * n_timed / t / 1e14, 6) AS mfu_timed FROM c""",
)
def utilisation(spark: SparkSession, d: str) -> DataFrame:
    used = experiments.utilisation(steps(spark, d), F.lit(3e8), F.lit(1e14))
    return rounded(rounded(used, "train_s", places=4), "mfu", "mfu_timed")
