import heapq
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sheafmill.operators import experiments as ex
from sheafmill.operators import replay

SCHEMA = "run_tag string, seq long, commit string, val_bpb double, memory_gb double, status string, description string"


def make(spark, rows):
    full = [("r", i, f"c{i}", v, 1.0, s, d) for i, (v, s, d) in enumerate(rows)]
    return ex.normalised(spark.createDataFrame(full, SCHEMA))


EDGE = [
    (0.0, " crash ", "first line is a crash"),
    (1.10, "Keep", "x" * 46),
    (None, "keep", "no number"),
    (1.00, "KEEP", "x" * 45),
    (1.00, "keep ", "tie"),
    (1.05, None, "missing status"),
    (1.2, "keep-sa", "accepted though worse"),
    (0.9, "discard", "better but discarded"),
    (0.99, "keep", " last "),
]


def test_edges_of_the_log(spark):
    log = make(spark, EDGE)
    (facts,) = ex.summary(log).collect()
    assert facts.baseline_bpb == 0.0 and facts.best_bpb == 0.99 and facts.best_seq == 8
    assert (facts.n_keep, facts.n_discard, facts.n_crash) == (5, 1, 1)
    assert facts.keep_rate == pytest.approx(5 / 6) and facts.improvement_pct is None
    chart = ex.progress(log, chunk_rows=2).orderBy("idx").collect()
    assert [r.seq for r in chart] == [1, 2, 3, 4, 5, 6, 7, 8] and [r.idx for r in chart] == list(range(8))
    assert {r.chart_baseline for r in chart} == {1.10}
    assert [r.running_best for r in chart] == [1.10, None, 1.00, 1.00, None, None, None, 0.99]
    assert chart[0].label == "x" * 42 + "..." and chart[2].label == "x" * 45 and chart[-1].label == "last"
    assert [r.is_below for r in chart] == [True, False, True, True, True, False, True, True]
    assert {r.status: r.n for r in ex.outcome_counts(log).collect()} == {"CRASH": 1, "KEEP": 5, None: 1, "KEEP-SA": 1, "DISCARD": 1}


@pytest.mark.parametrize("chunk_rows", [1, 3, 1000])
def test_hits_use_the_previous_kept_row_even_without_value(spark, chunk_rows):
    log = make(spark, EDGE)
    frame = pd.DataFrame([(i, v) for i, (v, s, _) in enumerate(EDGE) if (s or "").strip().upper() == "KEEP"], columns=["seq", "v"])
    frame["delta"] = frame.v.shift(1) - frame.v
    hits = {r.seq: r.delta for r in ex.hit_deltas(log, chunk_rows).collect()}
    assert set(hits) == set(frame.seq[1:])
    for seq, delta in zip(frame.seq[1:], frame.delta[1:]):
        assert hits[seq] == (None if delta != delta else pytest.approx(delta))
    ranked = [(r["rank"], r.seq) for r in ex.top_hits(log, chunk_rows).orderBy("rank").collect()]
    assert ranked == [(1, 8), (2, 4), (3, 2), (4, 3)]
    effort = {r.seq: r.effort for r in ex.effort_per_improvement(log, chunk_rows).collect()}
    assert effort == {1: None, 2: 1, 3: 1, 4: 1, 8: 4}


def test_winner_ignores_crashes_and_breaks_ties_by_order(spark):
    log = make(spark, [(0.0, "crash", ""), (0.8, "discard", ""), (0.9, "keep", "a"), (0.9, "keep", "b")])
    (best,) = ex.winner(log).collect()
    assert (best.commit, best.val_bpb) == ("c2", 0.9)


def random_log(spark, n, runs, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        status = rng.choices(["keep", "discard", "crash"], [3, 5, 1])[0]
        value = 0.0 if status == "crash" else round(1 + rng.gauss(0, 0.004), 4)
        # One run holds half of all rows.
        run = "hot" if rng.random() < 0.5 else f"r{rng.randrange(runs)}"
        rows.append((run, i, f"c{i}", value, 1.0, status, "d"))
    return rows, ex.normalised(spark.createDataFrame(rows, SCHEMA))


def walk(values, draws, reheat_after):
    """One run by the rules, step by step."""
    T, best, current, idle, count, out = 0.005, math.inf, math.inf, 0, 0, []
    for value, u in zip(values, draws):
        if value is None:
            out.append(("crash", T, best, current, idle, count))
            continue
        delta = value - current
        if delta < 0:
            decision, current, idle = "accept", value, 0
            best = min(best, value)
        else:
            idle += 1
            decision = "accept-sa" if u < math.exp(-delta / T) else "discard"
            if decision == "accept-sa":
                current = value
        T *= 0.97
        count += 1
        if idle >= reheat_after:
            T, idle = 0.003, 0
        out.append((decision, T, best, current, idle, count))
    return out


@pytest.mark.parametrize("chunk_rows,reheat_after", [(25, 15), (90, 10), (10_000, 15)])
def test_annealing_in_chunks_equals_the_walk(spark, chunk_rows, reheat_after):
    rows, log = random_log(spark, 300, 3, 11)
    draws = {(r.run_tag, r.seq): r.u for r in log.select("run_tag", "seq", replay.hashed_draw().alias("u")).collect()}
    got = {(r.run_tag, r.seq): tuple(r)[2:] for r in replay.annealing(log, None, reheat_after, chunk_rows).collect()}
    assert len(got) == len(rows)
    for run in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == run]
        values = [None if r[5] == "crash" else r[3] for r in mine]
        want = walk(values, [draws[run, r[1]] for r in mine], reheat_after)
        assert [got[run, r[1]] for r in mine] == want


@pytest.mark.parametrize("chunk_rows", [7, 60, 10_000])
def test_population_in_chunks_equals_the_walk(spark, chunk_rows):
    rows, log = random_log(spark, 260, 3, 23)
    got = {(r.run_tag, r.seq): r for r in replay.population_replay(log, 5, chunk_rows).collect()}
    for run in {r[0] for r in rows}:
        members = []
        for _, seq, commit, value, _, status, _ in [r for r in rows if r[0] == run]:
            entered, evicted = False, None
            if status != "crash":
                pool = sorted(members + [(value, seq, commit)])
                members, rest = pool[:5], pool[5:]
                entered = (value, seq, commit) in members
                evicted = rest[0][2] if entered and rest else None
            r = got[run, seq]
            assert (r.entered, r.evicted) == (entered, evicted)
            assert [(m.val_bpb, m.seq, m.commit) for m in r.members] == members


def test_smoothed_loss_equals_the_recursion(spark):
    rng = np.random.default_rng(3)
    loss = {"a": rng.uniform(2, 9, 6000), "b": rng.uniform(2, 9, 3)}
    rows = [(run, i, float(x)) for run, xs in loss.items() for i, x in enumerate(xs)]
    steps = spark.createDataFrame(rows, "run_tag string, step long, loss double")
    got = {(r.run_tag, r.step): r for r in ex.smoothed_loss(steps).collect()}
    for run, xs in loss.items():
        smooth = 0.0
        for i, x in enumerate(xs):
            smooth = 0.9 * smooth + (1 - 0.9) * x
            assert got[run, i].smooth_loss == pytest.approx(smooth, rel=1e-12)
            assert got[run, i].debiased_loss == pytest.approx(smooth / (1 - 0.9 ** (i + 1)), rel=1e-12)


def test_training_time_and_utilisation(spark):
    rows = [("a", i, 0.5, 100, 3.0) for i in range(20)] + [("short", i, 0.5, 100, 3.0) for i in range(5)]
    steps = spark.createDataFrame(rows, "run_tag string, step long, dt_s double, tokens long, loss double")
    timed = {(r.run_tag, r.step): r.train_s for r in ex.training_time(steps, chunk_rows=4).collect()}
    assert timed["a", 10] == 0 and timed["a", 11] == 0.5 and timed["a", 19] == 4.5 and timed["short", 4] == 0
    used = {r.run_tag: r for r in ex.utilisation(steps, F.lit(2.0), F.lit(1000.0)).collect()}
    assert used["a"].mfu == pytest.approx(100 * 2 * 100 * 10 / 4.5 / 1000)
    assert used["a"].mfu_timed == pytest.approx(100 * 2 * 100 * 9 / 4.5 / 1000)
    assert used["short"].mfu is None
    unknown = ex.utilisation(steps, F.lit(2.0), F.lit(None).cast("double")).collect()
    assert {r.mfu for r in unknown} == {None}
    assert ex.throughput(steps).first().tok_per_sec == 200


def test_exploded_losses_include_nan(spark):
    rows = [("a", 0, 3.0), ("a", 1, 101.0), ("a", 2, float("nan")), ("a", 3, 100.0)]
    steps = spark.createDataFrame(rows, "run_tag string, step long, loss double")
    assert sorted(r.step for r in ex.exploded(steps).collect()) == [1, 2]


def test_population_is_the_smallest_values(spark):
    rows, log = random_log(spark, 200, 2, 31)
    got = {}
    for r in ex.population(log).collect():
        got.setdefault(r.run_tag, []).append((r.val_bpb, r.seq))
    for run, members in got.items():
        want = heapq.nsmallest(5, [(r[3], r[1]) for r in rows if r[0] == run and r[5] != "crash"])
        assert sorted(members) == want
