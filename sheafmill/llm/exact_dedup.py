"""Exact de-duplication against a minimal perfect hash over historical distinct digests.

Documents are equal when their texts are equal without white space. The index has one part per some
4,096 distinct digests. A part is a minimal perfect hash by hash and displace: each digest falls into
a small bucket, each bucket has one displacement, and displacement and digest give the slot; a part
of m digests has exactly m slots. Slots hold the full digest and the winner's locator. A look-up is
two joins, bucket to displacement and slot to digest; only an equal digest, compared byte by byte,
makes a row a member. Rows that are no members are grouped by digest among themselves.

Defined results: null text counts as empty; empty and white-space texts are equal to each other; a
null id sorts before all others; rows that repeat an id are one document and get the same answer, and
each of them counts in group_size; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import SPACES, arrow_type, as_bytes, id_type, map_rows, materialise, texts

#: Distinct digests per part of the index, on average; a part is built in one task.
PART_KEYS = 4096
#: Buckets of a part, some four digests each.
BUCKETS = 1024


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, digest (SHA-256 of the text without white space), n_chars of the whole text."""
    kind = id_type(docs, id_col)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [
                hashlib.sha256(t.translate(None, SPACES)).digest() for t in as_bytes(batch.column(1))
            ]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), pa.array(made, pa.binary()), batch.column(2)],
                ["doc_id", "digest", "n_chars"],
            )

        return step

    source = texts(docs, id_col, text_col).withColumn("n_chars", F.char_length("text").cast("long"))
    return map_rows(source, f"doc_id {kind}, digest binary, n_chars long", make)


def winners(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key the longest text, then the smallest id, and the number of rows."""
    best = F.min(F.struct((-F.col("n_chars")).alias("shorter"), F.col("doc_id").alias("keep_id")))
    return rows.groupBy(*keys).agg(best.alias("best"), F.count("*").alias("size"))


def _word(k: int) -> Column:
    """The k-th 32 bits of the digest as a number."""
    return F.conv(F.hex(F.substring("digest", 4 * k + 1, 4)), 16, 10).cast("long")


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">u4").reshape(len(digests), 8).astype(np.int64)


def build_part(digests: list[bytes]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Seed, and per digest bucket, the bucket's displacement (two numbers) and slot."""
    words, m = _words(digests), len(digests)
    bucket = words[:, 1] % BUCKETS
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    groups = sorted(np.split(order, cuts), key=len, reverse=True)
    turn = np.arange(m)
    for seed in range(64):
        first = (words[:, 2] + seed * words[:, 4]) % m
        second = (words[:, 3] + seed * words[:, 5]) % m
        free = np.ones(m, bool)
        slot, d0s, d1s = np.empty(m, np.int64), np.empty(m, np.int64), np.empty(m, np.int64)
        for rows in groups:
            for d0 in range(m):
                base = (first[rows] + d0 * second[rows]) % m
                if len(rows) > 1 and len(np.unique(base)) < len(rows):
                    continue
                fits = np.flatnonzero(free[(base[:, None] + turn) % m].all(axis=0))
                if len(fits):
                    slot[rows] = (base + fits[0]) % m
                    free[slot[rows]] = False
                    d0s[rows], d1s[rows] = d0, fits[0]
                    break
            else:
                break
        else:
            return seed, bucket, d0s, d1s, slot
    raise ValueError("no displacement fits; are the digests distinct?")


def build_index(history: DataFrame) -> DataFrame:
    """The written index over rows of digest, best and size with distinct digests.

    One row per slot: part, slot, digest, best, size; bucket_head marks one row per bucket, whose
    bucket, seed, m, d0 and d1 are the displacement table.
    """
    n = history.count()
    parts = max(1, -(-n // PART_KEYS))
    best = history.schema["best"].dataType.simpleString()

    def build(group: pa.Table) -> pa.Table:
        digests = group.column("digest").to_pylist()
        seed, bucket, d0, d1, slot = build_part(digests)
        head = ~pd.Series(bucket).duplicated().to_numpy()
        fixed = {"seed": np.full(len(digests), seed), "m": np.full(len(digests), len(digests))}
        added = fixed | {"bucket": bucket, "d0": d0, "d1": d1, "slot": slot, "bucket_head": head}
        for name, values in added.items():
            group = group.append_column(name, pa.array(values))
        return group

    schema = (
        f"part long, digest binary, best {best}, size long, seed long, m long, bucket long, "
        "d0 long, d1 long, slot long, bucket_head boolean"
    )
    keyed = history.select((_word(0) % parts).alias("part"), "digest", "best", "size")
    index = materialise(keyed.groupBy("part").applyInArrow(build, schema), "digest-index")
    return index.withColumn("parts", F.lit(parts))


def look_up(rows: DataFrame, index: DataFrame) -> DataFrame:
    """`rows` with part and slot of their digest, both null where it is not in the index."""
    parts = index.select(F.max("parts")).first()[0] or 1
    heads = index.filter("bucket_head").select("part", "bucket", "seed", "m", "d0", "d1")
    placed = rows.withColumns({"part": _word(0) % parts, "bucket": _word(1) % BUCKETS}).join(
        heads, ["part", "bucket"], "left"
    )
    first, second = _word(2) + F.col("seed") * _word(4), _word(3) + F.col("seed") * _word(5)
    at = (first % F.col("m") + F.col("d0") * (second % F.col("m")) + F.col("d1")) % F.col("m")
    slots = index.select("part", "slot", F.col("digest").alias("held"))
    found = placed.withColumn("slot", at).join(slots, ["part", "slot"], "left")
    same = F.col("held") == F.col("digest")
    return found.select(
        *rows.columns, F.when(same, F.col("part")).alias("part"), F.when(same, F.col("slot")).alias("slot")
    )


def deduplicate(rows: DataFrame, history: DataFrame) -> DataFrame:
    """keep_id, group_size and kept for all of `rows`, whose digests partly are in `history`.

    `rows` and `history` are as from digest_rows(); history rows are part of the groups and of the
    result. A new row that is longer than the winner of its slot replaces it.
    """
    index = build_index(materialise(winners(history, "digest"), "digest-history"))
    found = materialise(look_up(rows, index), "digest-found")
    repeats = winners(found.filter("slot IS NOT NULL"), "part", "slot").select(
        "part", "slot", F.col("best").alias("new_best"), F.col("size").alias("new_size")
    )
    known = index.join(repeats, ["part", "slot"], "left").select(
        "digest",
        F.least("best", F.coalesce("new_best", "best")).alias("best"),
        (F.col("size") + F.coalesce("new_size", F.lit(0))).alias("size"),
    )
    others = winners(found.filter("slot IS NULL"), "digest")
    groups = known.unionByName(others)
    every = history.unionByName(rows)
    return every.join(groups, "digest").select(
        "doc_id",
        F.col("best.keep_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("best.keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The whole table de-duplicated: its lower half of ids is the history, the rest is looked up.

    Where the halves meet does not change the result, only how many rows take which way.
    """
    rows = materialise(digest_rows(docs, id_col, text_col), "digests")
    low, high = rows.select(F.min("doc_id"), F.max("doc_id")).first()
    middle = F.lit((low + high) // 2 if isinstance(low, int) else low)
    old = F.coalesce(F.col("doc_id") <= middle, F.lit(False))
    return deduplicate(rows.filter(~old), rows.filter(old))
