"""Ordered computation without a single-task window.

Spark has no row order, and one window over a whole table or over one hot key would run in one
task. Every operator here works on bounded pieces of the order and joins in what the pieces
before them add up to:

* `with_position`  pieces are ranges of a uniformly distributed hash key;
* `running`        pieces are ranges of an integer order column inside each key;
* `with_rank`      pieces are sampled ranges of arbitrary order columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from sheafmill.functions.text import col
from sheafmill.session import materialise

# Leading hex digits of the shuffle key that name a slice: at most 16**4 slices, whatever the data.
SLICE_DIGITS = 4
GROUP_ROWS = 100_000
CHUNK_ROWS = 100_000
# Up to here Spark prunes a row_number filter inside each map task.
MAP_SIDE_TOP = 1_000


def _slice_of(key: str) -> Column:
    """Never NULL, so that the join on it adds no filter to one side only: the counting pass and
    the placing pass then share every exchange below them."""
    return F.coalesce(F.substring(key, 1, SLICE_DIGITS), F.lit(""))


def with_position(
    df: DataFrame, key: str, out: str = "pos", total: str | None = None, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """Number all rows from 0 in the order of `key`, a unique lower-case hex digest.

    Rows per slice are counted first (65,536 slices at most, hence the broadcast). Neighbouring
    slices are then put together to groups of about `group_rows` rows, and each group is sorted
    by itself.
    """
    sliced = df.withColumn("_slice", _slice_of(key))
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    everything = W.orderBy("_slice")
    before = F.sum("_n").over(everything.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    whole = everything.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    offsets = (
        sizes.select("_slice", before.alias("_before"), F.sum("_n").over(whole).alias("_total"))
        .withColumn("_group", F.floor(F.col("_before") / group_rows))
        .withColumn("_base", F.min("_before").over(W.partitionBy("_group")))
        .drop("_before")
    )
    placed = sliced.join(F.broadcast(offsets), "_slice")
    place = F.row_number().over(W.partitionBy("_group").orderBy(key)) - 1 + F.col("_base")
    keep = [F.col(c) for c in df.columns] + [place.cast("long").alias(out)]
    if total:
        keep.append(F.col("_total").alias(total))
    return placed.select(*keep)


def first_by_position(df: DataFrame, key: str, n: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """The first `n` rows in key order, however large `n` is; later slices never get shuffled."""
    sliced = df.withColumn("_slice", _slice_of(key))
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    w = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    needed = sizes.select("_slice", (F.sum("_n").over(w) - F.col("_n")).alias("_before")).where(
        F.col("_before") < n
    )
    candidates = sliced.join(F.broadcast(needed.select("_slice")), "_slice", "left_semi")
    numbered = with_position(candidates.drop("_slice"), key, "_pos", group_rows=group_rows)
    return numbered.where(F.col("_pos") < n).drop("_pos")


def chunk_of(order: str, rows: int = CHUNK_ROWS) -> Column:
    """The piece a row belongs to; at most `rows` distinct order values share one."""
    return F.floor(F.col(order) / rows).cast("long")


_AGGREGATES = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}


def running(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    specs: dict[str, tuple[str, Column | str]],
    inclusive: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Running aggregates per key in the order of an integer column that is unique per key.

    `specs` maps output names to (kind, column), kind one of sum, min, max, count, last, first; NULLs
    are skipped, `last` is the latest non-NULL value and `first` the earliest (wrap a value in a
    struct to keep its NULLs). With `inclusive=False` the current row
    is left out. A key of any size is spread over chunks; what earlier chunks contribute is one
    summary row per chunk.
    """
    by = list(by)
    chunked = df.withColumn("_chunk", chunk_of(order, chunk_rows))
    part = [*by, "_chunk"]
    local = W.partitionBy(*part).orderBy(order).rowsBetween(
        W.unboundedPreceding, W.currentRow if inclusive else -1
    )
    earlier = W.partitionBy(*by).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)

    local_cols, chunk_cols, carry_cols, result = [], [], [], []
    for name, (kind, value) in specs.items():
        value = col(value)
        here, whole, carry = f"_l_{name}", f"_w_{name}", f"_c_{name}"
        if kind == "last":
            local_cols.append(F.last(value, ignorenulls=True).over(local).alias(here))
            chunk_cols.append(
                F.max(F.when(value.isNotNull(), F.struct(F.col(order), value.alias("v"))))["v"].alias(whole)
            )
            carry_cols.append(F.last(whole, ignorenulls=True).over(earlier).alias(carry))
            combined = F.coalesce(F.col(here), F.col(carry))
        elif kind == "first":
            local_cols.append(F.first(value, ignorenulls=True).over(local).alias(here))
            chunk_cols.append(
                F.min(F.when(value.isNotNull(), F.struct(F.col(order), value.alias("v"))))["v"].alias(whole)
            )
            carry_cols.append(F.first(whole, ignorenulls=True).over(earlier).alias(carry))
            combined = F.coalesce(F.col(carry), F.col(here))
        else:
            local_cols.append(_AGGREGATES[kind](value).over(local).alias(here))
            chunk_cols.append(_AGGREGATES[kind](value).alias(whole))
            over_chunks = {"count": F.sum}.get(kind, _AGGREGATES[kind])
            carry_cols.append(over_chunks(F.col(whole)).over(earlier).alias(carry))
            if kind in ("sum", "count"):
                total = F.coalesce(F.col(here), F.lit(0)) + F.coalesce(F.col(carry), F.lit(0))
                known = F.col(here).isNotNull() | F.col(carry).isNotNull()
                combined = total if kind == "count" else F.when(known, total)
            else:
                combined = (F.least if kind == "min" else F.greatest)(F.col(here), F.col(carry))
        result.append(combined.alias(name))

    placed = chunked.select("*", *local_cols)
    carried = chunked.groupBy(*part).agg(*chunk_cols).select(*part, *carry_cols)
    return placed.join(carried, part).select(*df.columns, *result)


def with_rank(df: DataFrame, by: Sequence[str], order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Number the rows of each key from 1 in any order; the order must have no ties.

    A range exchange spreads a large key over tasks. Its bounds are sampled, so the result is
    written once before the pieces are counted.
    """
    by = list(by)
    ranged = df.repartitionByRange(*[F.col(c) for c in by], *order)
    fixed = materialise(ranged.withColumn("_piece", F.spark_partition_id()), "rank")
    part = [*by, "_piece"]
    earlier = W.partitionBy(*by).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    before = (
        fixed.groupBy(*part).agg(F.count(F.lit(1)).alias("_n"))
        .select(*part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    local = F.row_number().over(W.partitionBy(*part).orderBy(*order))
    return (
        fixed.withColumn("_local", local)
        .join(before, part)
        .select(*df.columns, (F.col("_local") + F.col("_before")).cast("long").alias(out))
    )


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, out: str = "rank"
) -> DataFrame:
    """The first `n` rows of each key, numbered from 1."""
    if n > MAP_SIDE_TOP:
        return with_rank(df, by, order, out).where(F.col(out) <= n)
    ranked = df.withColumn(out, F.row_number().over(W.partitionBy(*by).orderBy(*order)).cast("long"))
    return ranked.where(F.col(out) <= n)


def budget_prefix(
    df: DataFrame, position: str, size: Column, budget: int, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Rows in position order until `budget` is used up; the row that crosses it is still kept.

    Sizes are added per chunk; only the one chunk in which the budget runs out is looked at row
    by row, the chunks before it pass whole.
    """
    sized = df.withColumn("_size", size.cast("long")).withColumn("_chunk", chunk_of(position, chunk_rows))
    sums = sized.groupBy("_chunk").agg(F.sum("_size").alias("_sum"))
    w = W.orderBy("_chunk").rowsBetween(W.unboundedPreceding, W.currentRow)
    sums = sums.select("_chunk", "_sum", F.sum("_sum").over(w).alias("_end")).withColumn(
        "_start", F.col("_end") - F.col("_sum")
    )
    whole = sized.join(sums.where(F.col("_end") < budget).select("_chunk"), "_chunk", "left_semi")
    edge = sized.join(
        F.broadcast(sums.where((F.col("_start") < budget) & (F.col("_end") >= budget))), "_chunk"
    )
    local = W.partitionBy("_chunk").orderBy(position).rowsBetween(W.unboundedPreceding, W.currentRow)
    used = F.sum("_size").over(local) - F.col("_size") + F.col("_start")
    edge = edge.withColumn("_used", used).where(F.col("_used") < budget)
    return whole.select(*df.columns).unionByName(edge.select(*df.columns))
