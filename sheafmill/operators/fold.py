"""Exact sequential folds over ordered rows, run chunk by chunk in parallel.

Some rules (annealing decisions, greedy packing) carry a state from row to row that no SQL
aggregate can combine. Folding a whole key in one task would not scale, so the order is cut into
chunks that are folded at the same time, each from an assumed state. A chunk whose assumption
turns out wrong is folded again from the state its predecessor really ended in, until no
assumption is wrong. The outcome equals the one-by-one fold; states of the rules used here soon
forget where they started, so two or three rounds are usual, but the worst case is one round per chunk. Keep sums, counts and minima out of a
state, for they never forget: `ordered.running` computes them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any, NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from sheafmill.operators.ordered import CHUNK_ROWS, chunk_of
from sheafmill.session import materialise

State = dict[str, Any]
Fold = Callable[[pd.DataFrame, State, bool], tuple[pd.DataFrame, State]]


def fold_rows(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    fold: Fold,
    initial: State,
    state_schema: T.StructType,
    out_schema: T.StructType,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Fold each key's rows in the order of an integer column that is unique per key.

    `fold(rows, state, is_last)` gets one sorted chunk, the state before it, and whether it is
    the key's last chunk; it returns output rows and the state after the chunk.
    """
    by = list(by)
    part = [*by, "_chunk"]
    fields = state_schema.fieldNames()
    # Every round reads the rows again, so whatever made them runs only once.
    data = materialise(df.withColumn("_chunk", chunk_of(order, chunk_rows)), "rows")

    per_key = W.partitionBy(*by).orderBy("_chunk")
    links = materialise(
        data.select(*part).distinct().select(
            *part,
            F.lag("_chunk").over(per_key).alias("_prev"),
            F.lead("_chunk").over(per_key).isNull().alias("_is_last"),
        ),
        "links",
    )
    assumed = links.select(
        "*", *[F.lit(initial[f.name]).cast(f.dataType).alias(f.name) for f in state_schema]
    )

    def chunk_states(key: tuple, rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        first = start.iloc[0]
        _, end = fold(rows.sort_values(order), {n: first[n] for n in fields}, bool(first["_is_last"]))
        return pd.DataFrame([[*key, *[end[n] for n in fields]]], columns=[*part, *fields])

    def chunk_output(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        first = start.iloc[0]
        out, _ = fold(rows.sort_values(order), {n: first[n] for n in fields}, bool(first["_is_last"]))
        return out

    part_fields = [data.schema[c] for c in part]
    ends_schema = T.StructType([*part_fields, *state_schema])

    # Only chunks with a successor need their end state before the final pass.
    todo = assumed.where(~F.col("_is_last"))
    ends = None
    while not todo.isEmpty():
        fresh = materialise(
            data.join(todo.select(*part), part, "left_semi")
            .groupBy(*part)
            .cogroup(todo.groupBy(*part))
            .applyInPandas(chunk_states, ends_schema),
            "ends",
        )
        ends = fresh if ends is None else materialise(
            ends.join(fresh.select(*part), part, "left_anti").unionByName(fresh), "ends"
        )
        arrived = ends.select(
            *by, F.col("_chunk").alias("_prev"), F.struct(*fields).alias("_arrived")
        )
        checked = materialise(
            assumed.withColumn("_assumed", F.struct(*fields))
            .drop(*fields)
            .join(arrived, [*by, "_prev"], "left")
            .withColumn("_state", F.coalesce("_arrived", "_assumed"))
            .select(
                *part, "_prev", "_is_last",
                (~F.col("_state").eqNullSafe(F.col("_assumed"))).alias("_changed"),
                *[F.col(f"_state.{n}").alias(n) for n in fields],
            ),
            "states",
        )
        assumed = checked.drop("_changed")
        todo = checked.where(F.col("_changed") & ~F.col("_is_last")).drop("_changed")

    return (
        data.groupBy(*part).cogroup(assumed.groupBy(*part)).applyInPandas(chunk_output, out_schema)
    )


class Summary(NamedTuple):
    """What a chunk does to each of finitely many start states, numbered from 0.

    `state` is the end state; the count that goes along is increased by `held`, or where `resets` is
    set, replaced by it.
    """

    state: np.ndarray
    held: np.ndarray
    resets: np.ndarray

    def then(self, later: Summary) -> Summary:
        resets = later.resets[self.state]
        added = later.held[self.state]
        return Summary(later.state[self.state], np.where(resets, added, self.held + added), self.resets | resets)


_SUMMARY = "_chunk long, state array<int>, held array<long>, resets array<boolean>"
_START = "_chunk long, start_state long, start_held long"
#: Summaries that one task composes.
FAN = 1000


def _summaries(rows: pd.DataFrame) -> list[Summary]:
    kinds = (np.int64, np.int64, bool)
    columns = ("state", "held", "resets")
    return [Summary(*[np.asarray(v, k) for v, k in zip(r, kinds)]) for r in zip(*[rows[c] for c in columns])]


def fold_by_summary(
    df: DataFrame,
    order: str,
    summary: Callable[[pd.DataFrame], Summary],
    output: Callable[[pd.DataFrame, int, int, bool], pd.DataFrame],
    out_schema: T.StructType,
    chunk_rows: int = CHUNK_ROWS,
    fan: int | None = None,
) -> DataFrame:
    """Fold all rows in the order of a unique integer column, for rules with few states.

    Chunks are summarised at the same time, summaries composed in a tree of FAN branches, start states
    handed down the tree, and chunks folded once more with their start (state 0, count 0 for the first).
    The number of jobs grows with the depth of the tree alone, whatever the values are.
    `output(rows, state, held, is_last)` gets one sorted chunk.
    """
    fan = fan or FAN
    data = materialise(df.withColumn("_chunk", chunk_of(order, chunk_rows)), "rows")
    last = data.agg(F.max("_chunk")).first()[0]

    def row(key: int, s: Summary) -> pd.DataFrame:
        return pd.DataFrame({"_chunk": [key], "state": [s.state], "held": [s.held], "resets": [s.resets]})

    def summarise(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        return row(key[0], summary(rows.sort_values(order)))

    def compose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        whole, *rest = _summaries(rows.sort_values("_chunk"))
        for later in rest:
            whole = whole.then(later)
        return row(key[0], whole)

    def hand_down(rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("_chunk")
        state, held, made = int(start["start_state"].iloc[0]), int(start["start_held"].iloc[0]), []
        for chunk, s in zip(rows["_chunk"], _summaries(rows)):
            made.append((chunk, state, held))
            held = int(s.held[state]) if s.resets[state] else held + int(s.held[state])
            state = int(s.state[state])
        return pd.DataFrame(made, columns=["_chunk", "start_state", "start_held"])

    def finish(key: tuple, rows: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        first = start.iloc[0]
        return output(
            rows.sort_values(order), int(first["start_state"]), int(first["start_held"]), int(first["_chunk"]) == last
        )

    parent = F.floor(F.col("_chunk") / fan).cast("long")
    levels = [materialise(data.groupBy("_chunk").applyInPandas(summarise, _SUMMARY), "summaries")]
    count = (last or 0) + 1
    while count > fan:
        count = -(-count // fan)
        levels.append(materialise(levels[-1].groupBy(parent).applyInPandas(compose, _SUMMARY), "summaries"))
    spark = df.sparkSession
    starts = spark.createDataFrame([(0, 0, 0)], _START)
    for level in reversed(levels):
        keyed = level.withColumn("_parent", parent)
        starts = materialise(
            keyed.groupBy("_parent").cogroup(starts.groupBy("_chunk")).applyInPandas(
                lambda rows, start: hand_down(rows, start) if len(rows) else pd.DataFrame(
                    columns=["_chunk", "start_state", "start_held"]
                ),
                _START,
            ),
            "starts",
        )
    return data.groupBy("_chunk").cogroup(starts.groupBy("_chunk")).applyInPandas(finish, out_schema)
