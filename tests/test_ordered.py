import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sheafmill.functions import text as tx
from sheafmill.operators import ordered, profile


def keyed(spark, n, parts):
    return spark.range(n).repartition(parts).withColumn("k", tx.shuffle_key(F.col("id").cast("string")))


@pytest.mark.parametrize("parts", [1, 4, 7])
def test_positions_do_not_depend_on_partitions(spark, parts):
    rows = ordered.with_position(keyed(spark, 500, parts), "k", total="all", group_rows=60).collect()
    assert {r["all"] for r in rows} == {500}
    assert [r.pos for r in sorted(rows, key=lambda r: r.k)] == list(range(500))


@pytest.mark.parametrize("n", [0, 1, 137, 499, 500, 900])
def test_first_by_position_is_the_sorted_head(spark, n):
    df = keyed(spark, 500, 4)
    want = [r.id for r in df.orderBy("k").limit(n).collect()] if n else []
    got = ordered.first_by_position(df, "k", n, group_rows=60).collect()
    assert sorted(r.id for r in got) == sorted(want)


@pytest.fixture(scope="module")
def log(spark):
    rng = random.Random(5)
    # Run 'hot' holds most rows; positions have gaps; some values are missing.
    rows = [("hot", s, rng.choice([None, rng.random()])) for s in rng.sample(range(900), 400)]
    rows += [(f"r{i % 7}", i * 3, rng.random()) for i in range(100)]
    return rows, spark.createDataFrame(rows, "run string, seq long, v double")


@pytest.mark.parametrize("inclusive", [True, False])
@pytest.mark.parametrize("chunk_rows", [1, 37, 10_000])
def test_running_equals_one_pass(log, inclusive, chunk_rows):
    rows, df = log
    specs = {"s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v"), "n": ("count", "v"), "last": ("last", "v")}
    got = ordered.running(df, ["run"], "seq", specs, inclusive, chunk_rows).collect()
    frame = pd.DataFrame(rows, columns=["run", "seq", "v"]).sort_values(["run", "seq"])
    want = {}
    for run, part in frame.groupby("run"):
        seen = []
        for seq, v in zip(part.seq, part.v):
            now = seen + ([v] if v == v else [])
            use = now if inclusive else seen
            want[run, seq] = (sum(use) if use else None, min(use, default=None), max(use, default=None), len(use), use[-1] if use else None)
            seen = now
    assert len(got) == len(rows)
    for r in got:
        s, lo, hi, n, last = want[r.run, r.seq]
        assert (r.lo, r.hi, r.n, r["last"]) == (lo, hi, n, last)
        assert r.s == (None if s is None else pytest.approx(s))


def test_rank_is_dense_and_ordered(log):
    rows, df = log
    order = [F.col("v").desc_nulls_last(), F.col("seq").asc()]
    got = ordered.with_rank(df, ["run"], order).collect()
    by_run = {}
    for r in got:
        by_run.setdefault(r.run, []).append(r)
    for run, part in by_run.items():
        part.sort(key=lambda r: (r.v is None, -(r.v or 0), r.seq))
        assert [r["rank"] for r in part] == list(range(1, len(part) + 1))


def test_top_per_group_beyond_the_map_side_limit(log, monkeypatch):
    rows, df = log
    order = [F.col("seq").asc()]
    near = sorted(map(tuple, ordered.top_per_group(df, ["run"], order, 12).collect()))
    monkeypatch.setattr(ordered, "MAP_SIDE_TOP", 5)
    assert sorted(map(tuple, ordered.top_per_group(df, ["run"], order, 12).collect())) == near


@pytest.mark.parametrize("budget", [0, 1, 500, 1234, 10**6])
@pytest.mark.parametrize("chunk_rows", [1, 16, 1000])
def test_budget_keeps_the_row_that_crosses(spark, budget, chunk_rows):
    rng = random.Random(9)
    sizes = [rng.choice([0, 5, 40]) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(sizes)), "pos long, size long")
    kept = ordered.budget_prefix(df, "pos", F.col("size"), budget, chunk_rows).collect()
    want, used = [], 0
    for pos, size in enumerate(sizes):
        if used >= budget:
            break
        want.append(pos)
        used += size
    assert sorted(r.pos for r in kept) == want


def test_large_samples_equal_small_ones(spark, monkeypatch):
    df = spark.range(300)
    small = sorted(r.id for r in profile.sample_rows(df, "id", 80).collect())
    monkeypatch.setattr(profile, "HEAP_ROWS", 10)
    assert sorted(r.id for r in profile.sample_rows(df, "id", 80).collect()) == small
    assert profile.sample_rows(df, "id", 1000).count() == 300


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_single_task_over_rows(spark, log):
    """Only the per-slice counts, bounded in number, may meet in one task."""
    plan = plan_of(ordered.with_position(keyed(spark, 500, 4), "k"))
    lines = plan.splitlines()
    single = [i for i, line in enumerate(lines) if "SinglePartition" in line]
    assert len(single) == 1
    assert "HashAggregate(keys=[_slice" in lines[single[0] + 1]
    running = plan_of(ordered.running(log[1], ["run"], "seq", {"s": ("sum", "v")}))
    assert "SinglePartition" not in running


def test_group_sample_is_pruned_in_map_tasks(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    plan = plan_of(profile.sample_per_group(df, "g", "id", 5))
    assert "WindowGroupLimit" in plan and "Partial" in plan
