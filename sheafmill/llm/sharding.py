"""Sharding by a permutation-filled lookup table.

Each shard has its own permutation of the slots of a table of prime size, from two hashes of its name:
an offset and a step. Shards take turns; in its turn a shard claims its next slot that is free, and a
shard of weight k claims k. Nearly all slots stay where they are when a shard joins or leaves. A row's
slot is a hash of its key, so placing is one look-up in a table whose size is fixed by a parameter and
not by the data; that table alone is broadcast.

Defined results: a null key has a slot like any other key; rows that repeat a key go to one shard, also
if a third of all rows do, and write_shards() then spreads that shard over several files; an empty table
gives an empty result; other columns are kept by place() and write_shards().
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots; a prime far above the number of shards keeps their shares within about one per cent.
SLOTS = 65_537


def _hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{salt}:{name}".encode()).digest()[:8], "big")


def fill(names: list[str], slots: int = SLOTS, weights: dict[str, int] | None = None) -> list[str]:
    """The shard of each slot."""
    if len(set(names)) < len(names) or not names:
        raise ValueError("shards need distinct names, one at least")
    if len(names) > slots or slots < 2 or any(slots % k == 0 for k in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime, not below the number of shards")
    at = {n: _hash(n, "offset") % slots for n in names}
    step = {n: _hash(n, "step") % (slots - 1) + 1 for n in names}
    turns = [n for n in sorted(names) for _ in range((weights or {}).get(n, 1))]
    table: list[str | None] = [None] * slots
    left = slots
    while left and turns:
        for name in turns:
            while table[at[name]] is not None:
                at[name] = (at[name] + step[name]) % slots
            table[at[name]] = name
            left -= 1
            if not left:
                break
    if left:
        raise ValueError("all weights are zero")
    return table


def lookup(spark: SparkSession, table: list[str]) -> DataFrame:
    rows = spark.createDataFrame(list(enumerate(table)), "slot int, shard string")
    return F.broadcast(rows)  # as many rows as slots, whatever the data


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def place(df: DataFrame, table: list[str], key: str = "doc_id") -> DataFrame:
    """`df`, all its columns, with slot and shard behind them; there is no shuffle.

    Where `df` has columns of these names, the new ones are named with an underscore before them.
    """
    slot, shard = free(df, "slot"), free(df, "shard")
    rows = df.withColumn(slot, slot_of(df[key], len(table)))
    found = lookup(df.sparkSession, table).toDF(slot, shard)
    return rows.join(F.broadcast(found), slot).select(*df.columns, slot, shard)


def free(df: DataFrame, name: str) -> str:
    while name in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name


def write_shards(
    df: DataFrame, path: str, table: list[str], key: str = "doc_id", files: int = 4
) -> DataFrame:
    """Parquet folders shard=<name>, `files` files each, and the manifest of their rows."""
    placed, shard = place(df, table, key), free(df, "shard")
    part = F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(files))  # spreads a hot key as well
    placed.repartition(shard, part).write.partitionBy(shard).mode("errorifexists").parquet(path)
    written = df.sparkSession.read.parquet(path)
    return written.groupBy(shard).agg(F.count("*").alias("n_rows"))


def names(count: int) -> list[str]:
    return [f"shard-{k:05d}" for k in range(count)]
