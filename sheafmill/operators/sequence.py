"""Fixed-length training rows, batches, evaluation weights, packing and bits per byte."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafmill import fixed
from sheafmill.functions import text as tx
from sheafmill.operators.fold import State, Summary, fold_by_summary
from sheafmill.operators.ordered import CHUNK_ROWS


def document_batches(
    docs: DataFrame, batch: int = fixed.DOC_BATCH, epochs: int = 1, shard_rows: int = fixed.SHARD_ROWS
) -> DataFrame:
    """Batches of neighbouring documents of one shard, once per epoch.

    `pos` numbers documents from 0 over all shards, `shard` numbers shards from 1; the last batch of a
    shard may be short, and the next shard begins a new one.
    """
    before = (F.col("shard") - 1).cast("long")
    inside = F.floor((F.col("pos") - before * shard_rows) / batch).cast("long")
    batched = docs.withColumn("batch_no", before * -(-shard_rows // batch) + inside)
    return batched.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))


def training_rows(encoded: DataFrame, bos: int, length: int = fixed.SEQ_LEN) -> DataFrame:
    """One row per document: cut to length + 1 tokens or padded with BOS, then shifted by one."""
    tokens = F.slice("tokens", 1, length + 1)
    row = F.concat(tokens, F.array_repeat(F.lit(bos), F.lit(length + 1) - F.size(tokens)))
    return (
        encoded.withColumn("_row", row)
        .withColumns({"inputs": F.slice("_row", 1, length), "targets": F.slice("_row", 2, length)})
        .drop("_row", "tokens")
    )


def assign_batches(rows: DataFrame, batch: int) -> DataFrame:
    """First in, first out: `pos` gives the batch and the place in it."""
    return rows.withColumns(
        {
            "batch_no": F.floor(F.col("pos") / batch).cast("long"),
            "row_in_batch": (F.col("pos") % batch).cast("int"),
        }
    )


def batches_over_epochs(rows: DataFrame, batch: int, epochs: int) -> DataFrame:
    """First in, first out over several epochs without a break: a batch takes the next epoch's first rows where one ends.

    `pos` numbers the rows of one epoch from 0; `epoch` counts from 1. Only the very last batch may be short.
    """
    total = rows.agg(F.count(F.lit(1)).alias("_rows"))
    repeated = rows.crossJoin(F.broadcast(total)).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    at = (F.col("epoch") - 1) * F.col("_rows") + F.col("pos")
    return repeated.withColumns(
        {"batch_no": F.floor(at / batch).cast("long"), "row_in_batch": (at % batch).cast("int")}
    ).drop("_rows")


def evaluation_rows(
    rows: DataFrame, batch: int, eval_tokens: int = fixed.EVAL_TOKENS, length: int = fixed.SEQ_LEN
) -> DataFrame:
    """Rows an evaluation reads, with how often it reads them when it wraps around the split."""
    needed = eval_tokens // (batch * length) * batch
    total = rows.agg(F.count(F.lit(1)).alias("_rows"))
    weight = F.floor((F.lit(needed) - 1 - F.col("pos")) / F.col("_rows")) + 1
    return (
        rows.where(F.col("pos") < needed)
        .crossJoin(total)
        .withColumn("weight", weight.cast("long"))
        .drop("_rows")
    )


def bits_per_byte(losses: DataFrame, vocab: DataFrame) -> DataFrame:
    """Corpus metric from a token-loss table (token_id, nats, weight); zero-byte tokens do not count.

    Losses are added up per token before the join, so a token as frequent as a space is one row
    per map task, and the join is between two tables of the vocabulary's size.
    """
    per_token = losses.groupBy("token_id").agg(
        F.sum(F.col("nats") * F.col("weight")).alias("nats"), F.sum("weight").alias("times")
    )
    scored = per_token.join(vocab.select("token_id", "nbytes"), "token_id").where(F.col("nbytes") > 0)
    return scored.agg(
        F.sum("nats").alias("total_nats"),
        F.sum(F.col("nbytes").cast("long") * F.col("times")).alias("total_bytes"),
    ).select(
        "total_nats", "total_bytes", tx.bits_per_byte(F.col("total_nats"), F.col("total_bytes")).alias("bpb")
    )


def packed_rows(
    lengths: DataFrame,
    max_len: int = fixed.PACK_LEN,
    order: str = "pos",
    length: str = "n",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Next-fit packing: one output row per context window with the number of documents in it.

    A window takes documents in order until one does not fit. A document longer than the window
    sits alone. What a chunk does depends on the room it starts with alone, so each chunk is
    summarised once for every room, and the summaries are composed.
    """
    out = T.StructType([T.StructField("documents", T.LongType())])

    def fold(rows: pd.DataFrame, start: State, is_last: bool) -> tuple[pd.DataFrame, State]:
        sizes = rows[length].to_numpy(np.int64)
        reach = np.concatenate([[0], np.cumsum(sizes)])
        room, held = int(start["room"]), int(start["held"])
        closed, at = [], 0
        while True:
            # Documents up to `stop` still fit into the open window.
            stop = at + int(np.searchsorted(reach[at + 1 :], reach[at] + room, side="right")) if room >= 0 else at
            held += stop - at
            if stop == len(sizes):
                room = room - int(reach[stop] - reach[at]) if room >= 0 else room
                break
            if held:
                closed.append(held)
            room, held, at = max_len - int(sizes[stop]), 1, stop + 1
        if is_last and held:
            closed.append(held)
        return pd.DataFrame({"documents": np.array(closed, dtype=np.int64)}), {"room": room, "held": held}

    def summary(rows: pd.DataFrame) -> Summary:
        sizes = rows[length].to_numpy(np.int64)
        n, reach = len(sizes), np.concatenate([[0], np.cumsum(sizes)])
        # the document that closes the window which document i opens, then the last one to open a window
        closes = np.searchsorted(reach[1:], reach[:-1] + max_len, side="right")
        closes = np.maximum(closes, np.arange(n) + 1)
        opens_last = list(range(n))
        for i in range(n - 1, -1, -1):
            if closes[i] < n:
                opens_last[i] = opens_last[closes[i]]
        first = np.append(0, np.searchsorted(reach[1:], np.arange(max_len + 1), side="right"))  # by room, from -1
        stays = first == n
        last = np.array(opens_last)[np.minimum(first, n - 1)]
        room = np.where(stays, np.arange(-1, max_len + 1) - reach[n], max_len - (reach[n] - reach[last]))
        return Summary(np.maximum(room, -1) + 1, np.where(stays, n, n - last), ~stays)

    picked = lengths.select(F.col(order).cast("long").alias(order), F.col(length).cast("long").alias(length))
    def output(rows: pd.DataFrame, state: int, held: int, is_last: bool) -> pd.DataFrame:
        return fold(rows, {"room": state - 1, "held": held}, is_last)[0]

    return fold_by_summary(picked, order, summary, output, out, chunk_rows)


def packing_distribution(packed: DataFrame) -> DataFrame:
    """Windows per number of documents, with shares."""
    counts = packed.groupBy("documents").agg(F.count(F.lit(1)).alias("windows"))
    total = counts.agg(F.sum("windows").alias("_total"))
    return counts.crossJoin(total).select(
        "documents", "windows", (F.col("windows") / F.col("_total")).alias("share")
    )


def packing_table(packed: DataFrame) -> DataFrame:
    """The distribution as a report shows it, with a percent text and a bar for each row."""
    share = F.col("share")
    return packing_distribution(packed).withColumns({"percent": tx.percent_text(share), "bar": tx.bar_text(share)})


def packing_profile(packed: DataFrame) -> DataFrame:
    """Windows, documents per window and the share of windows that hold a single document."""
    histogram = packed.groupBy("documents").agg(F.count(F.lit(1)).alias("w"))
    single = F.sum(F.when(F.col("documents") == 1, F.col("w")).otherwise(0))
    return histogram.agg(
        F.sum("w").alias("windows"),
        (F.sum(F.col("documents") * F.col("w")) / F.sum("w")).alias("mean_documents"),
        F.percentile("documents", 0.5, F.col("w")).alias("median_documents"),
        F.min("documents").alias("min_documents"),
        F.max("documents").alias("max_documents"),
        (single / F.sum("w")).alias("single_share"),
    )
