"""Counts, length profiles, short documents and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.functions import text as tx
from sheafmill.operators.ordered import first_by_position, top_per_group

# Above this many rows a sample is taken by position instead of in one sorted heap.
HEAP_ROWS = 10_000

_PERCENTILES = {"median": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}


def breakdown(df: DataFrame, column: str) -> DataFrame:
    """Rows per value with their share of the total."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.crossJoin(total).select(column, "n", (F.col("n") / F.col("_total")).alias("share"))


def length_profile(df: DataFrame, length: Column, by: Sequence[str] = ()) -> DataFrame:
    """Count, extremes, mean and interpolated percentiles of a length, per key.

    Lengths take few values, so rows are first folded to (key, length) counts; the exact
    percentiles then come from those counts however many rows a key has.
    """
    by = list(by)
    histogram = df.groupBy(*by, length.alias("len")).agg(F.count(F.lit(1)).alias("n"))
    points = [F.col("_points")[i].alias(name) for i, name in enumerate(_PERCENTILES)]
    return histogram.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.min("len").cast("long").alias("min_len"),
        (F.sum(F.col("len") * F.col("n")) / F.sum("n")).alias("mean_len"),
        F.percentile("len", list(_PERCENTILES.values()), F.col("n")).alias("_points"),
        F.max("len").cast("long").alias("max_len"),
    ).select(*by, "n", "min_len", "mean_len", *points, "max_len")


def approximate_profile(df: DataFrame, length: Column, by: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """The same percentiles in one pass within rank error 1/accuracy, for unbounded lengths."""
    points = [
        F.percentile_approx(length, p, accuracy).alias(name) for name, p in _PERCENTILES.items()
    ]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *points)


def context_fit(
    df: DataFrame, length: Column, contexts: Sequence[int] = fixed.CONTEXT_LENGTHS
) -> DataFrame:
    """Share of rows no longer than each context length, from one pass."""
    sums = [F.avg((length <= c).cast("int")).alias(f"c{i}") for i, c in enumerate(contexts)]
    pairs = ", ".join(f"{c}, c{i}" for i, c in enumerate(contexts))
    return df.agg(*sums).select(
        F.expr(f"stack({len(contexts)}, {pairs}) AS (context, share)")
    )


def short_documents(docs: DataFrame, limit: int = fixed.SHORT_CHARS) -> DataFrame:
    return docs.where(F.char_length("text") < limit)


def short_share(docs: DataFrame, by: Sequence[str] = (), limit: int = fixed.SHORT_CHARS) -> DataFrame:
    """Number and share of documents under the limit, per key."""
    is_short = F.char_length("text") < limit
    return docs.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_short).alias("n_short"),
        F.avg(is_short.cast("int")).alias("short_share"),
    )


def groups(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values in order."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = fixed.SEED) -> DataFrame:
    """`n` rows picked by hash order of a unique key; all rows when there are fewer."""
    hashed = df.withColumn("_shuffle", tx.shuffle_key(F.col(key).cast("string"), seed))
    if n <= HEAP_ROWS:
        return hashed.orderBy("_shuffle", key).limit(n).drop("_shuffle")
    return first_by_position(hashed, "_shuffle", n).drop("_shuffle")


def sample_per_group(
    df: DataFrame, by: str, key: str, n: int, seed: int = fixed.SEED
) -> DataFrame:
    """`n` rows of every non-NULL group, numbered from 1 in `sample_no`."""
    hashed = df.where(F.col(by).isNotNull()).withColumn(
        "_shuffle", tx.shuffle_key(F.col(key).cast("string"), seed)
    )
    return top_per_group(hashed, [by], [F.col("_shuffle"), F.col(key)], n, "sample_no").drop("_shuffle")


def implications(profile: DataFrame) -> DataFrame:
    """The whole-number median and the context length that would hold about two documents."""
    median = F.floor("median").cast("long")
    return profile.select(median.alias("median_tokens"), (median * 2).alias("two_per_row_len"))
