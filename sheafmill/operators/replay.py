"""Replays of the two search policies over logged values."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from sheafmill import fixed
from sheafmill.operators.experiments import RUN, is_status
from sheafmill.operators.fold import State, fold_rows
from sheafmill.operators.ordered import CHUNK_ROWS, chunk_of, running, top_per_group

# What the next decision depends on. Best value and count do not steer the walk: they are running
# aggregates, and kept out of the state they cannot delay the point where chunks agree.
_STATE = T.StructType(
    [
        T.StructField("temperature", T.DoubleType()),
        T.StructField("current_val_bpb", T.DoubleType()),
        T.StructField("no_improve_count", T.LongType()),
    ]
)


def hashed_draw(seed: int = fixed.SEED) -> Column:
    """A draw in [0, 1) that depends only on run and line."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(RUN), F.col("seq").cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(16**8)


def annealing(
    results: DataFrame,
    draw: Column | None = None,
    reheat_after: int = fixed.REHEAT_AFTER,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Decision and search state after every experiment of every run.

    Improvements on the value stood on are accepted; others with probability exp(-delta / T).
    A crash has no value to judge, so it leaves the state as it is.
    """
    log = results.select(
        RUN, "seq",
        F.when(~is_status("CRASH"), F.col("val_bpb")).alias("value"),
        (hashed_draw() if draw is None else draw).alias("draw"),
    )
    # A value that is not accepted is no better than the one stood on, so the best value seen is
    # also the best value accepted.
    log = running(
        log, [RUN], "seq", {"best_val_bpb": ("min", "value"), "experiment_count": ("count", "value")},
        chunk_rows=chunk_rows,
    ).withColumn("best_val_bpb", F.coalesce("best_val_bpb", F.lit(float("inf"))))
    carried = [RUN, "seq", "best_val_bpb", "experiment_count"]
    out = T.StructType(
        [*[log.schema[c] for c in carried], T.StructField("decision", T.StringType()), *_STATE]
    )

    def fold(rows: pd.DataFrame, start: State, is_last: bool) -> tuple[pd.DataFrame, State]:
        heat, stand, idle = (start[f.name] for f in _STATE)
        trace = []
        for value, draw in zip(rows["value"].to_numpy(float), rows["draw"].to_numpy(float)):
            if math.isnan(value):
                trace.append(("crash", heat, stand, idle))
                continue
            delta = value - stand
            if delta < 0:
                decision, stand, idle = "accept", value, 0
            else:
                idle += 1
                chance = math.exp(-delta / heat) if delta > 0 and heat > 0 else float(delta == 0)
                decision = "accept-sa" if draw < chance else "discard"
                stand = value if draw < chance else stand
            heat *= fixed.COOLING
            if idle >= reheat_after:
                heat, idle = fixed.REHEAT_TEMPERATURE, 0
            trace.append((decision, heat, stand, idle))
        states = pd.DataFrame(trace, columns=["decision", *_STATE.fieldNames()], index=rows.index)
        end = {"temperature": heat, "current_val_bpb": stand, "no_improve_count": idle}
        return pd.concat([rows[carried], states], axis=1), end

    initial = {
        "temperature": fixed.START_TEMPERATURE,
        "current_val_bpb": float("inf"),
        "no_improve_count": 0,
    }
    folded = fold_rows(log, [RUN], "seq", fold, initial, _STATE, out, chunk_rows)
    return folded.select(
        RUN, "seq", "decision", "temperature", "best_val_bpb", "current_val_bpb", "no_improve_count",
        "experiment_count",
    )


def _running_best(df: DataFrame, part: list[str], order: list[str], item: str, size: int) -> DataFrame:
    """Add _m1.._m<size>, the smallest items so far, and _out, the item the last of them let go.

    A minimum hands on whatever a new item displaces, so the running minimum of what level k - 1
    hands on is the k-th best; all levels share one partitioning and one sort.
    """
    rows = W.partitionBy(*part).orderBy(*order)
    so_far = rows.rowsBetween(W.unboundedPreceding, W.currentRow)
    df = df.withColumn("_out", F.col(item))
    for level in range(1, size + 1):
        best = f"_m{level}"
        df = df.withColumn(best, F.min("_out").over(so_far)).withColumn("_was", F.lag(best).over(rows))
        both = F.col("_was").isNotNull() & F.col("_out").isNotNull()
        df = df.withColumn("_out", F.when(both, F.greatest("_out", "_was")))
    return df.drop("_was")


def population_replay(
    results: DataFrame, size: int = fixed.POPULATION, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """The population after every experiment: did it enter, whom did it evict, who are the members.

    Members are ordered best first; on equal values the earlier experiment ranks first, so a
    newcomer must be better than the worst member. Crashes never enter.
    """
    levels = [f"_m{k}" for k in range(1, size + 1)]
    scored = ~is_status("CRASH") & F.col("val_bpb").isNotNull()
    log = results.withColumn("_chunk", chunk_of("seq", chunk_rows)).withColumn(
        "_me", F.when(scored, F.struct("val_bpb", "seq", "commit", "description"))
    )
    part = [RUN, "_chunk"]
    inside = _running_best(log, part, ["seq"], "_me", size)

    # The best items of each chunk, and from them the best of all chunks before it.
    best = top_per_group(
        log.where(F.col("_me").isNotNull()).select(*part, "_me"), part, [F.col("_me")], size, "_level"
    )
    known_by = _running_best(best, [RUN], ["_chunk", "_level"], "_me", size)
    after = known_by.groupBy(*part).agg(F.max_by(F.array(*levels), "_level").alias("_after"))
    earlier = W.partitionBy(RUN).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carried = log.select(*part).distinct().join(after, part, "left").select(
        *part, F.last("_after", ignorenulls=True).over(earlier).alias("_carry")
    )

    nothing = F.array().cast(after.schema["_after"].dataType)
    known = F.array_sort(
        F.array_compact(F.concat(F.coalesce("_carry", nothing), F.array(*levels, "_out")))
    )
    return (
        inside.join(carried, part)
        .withColumn("_known", known)
        .withColumn("members", F.slice("_known", 1, size))
        .withColumn("entered", F.coalesce(F.array_contains("members", F.col("_me")), F.lit(False)))
        .withColumn("evicted", F.when(F.col("entered"), F.get("_known", F.lit(size))["commit"]))
        .select(RUN, "seq", "commit", "val_bpb", "entered", "evicted", "members")
    )
