"""SimHash near-duplicates by covering locality-sensitive hashing.

Each of the 64 fingerprint positions has a fixed vector of radius + 1 bits that are not all zero. For
every nonzero vector v there is one table, whose key keeps the positions whose vector has an odd product
with v. Whatever `radius` positions differ, some v is orthogonal to all their vectors, so its table
drops exactly positions that include them: every pair within the radius shares a key in some table.

Tables hold distinct fingerprints. Fingerprints with one key stand together after a sort; the links
among them are checked bit by bit and only a spanning star per linked group goes on, so that no group
yields all its pairs. A key with more than CROWD fingerprints is taken apart exactly: its dropped
positions are cut into 2 * radius blocks, and each choice of `radius` blocks that may differ makes a
finer key, under which at most two to the number of positions in those blocks can be different.

Defined results: null, empty and white-space texts have fingerprint zero and are linked like any other;
rows that repeat an id get the same answer; a null id is left out of the smallest id and a group of
null ids alone has none; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import arrow_type, as_bytes, id_type, map_rows, materialise, texts
from sheafmill.llm.components import components

WORDS, RADIUS, SEED = 3, 3, 42
#: Fingerprints of one key that are compared with each other directly, at most.
CROWD = 1024
_BATCH = 1 << 16
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def fingerprint(data: bytes, width: int = WORDS) -> int:
    """Bits set in over half of the hashes of all word shingles, as a signed 64-bit number."""
    words = data.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends[:-1]]
    width = min(width, len(words))
    set_bits, n = np.zeros(64, np.int64), len(words) - width + 1
    hash_of = xxhash.xxh64_intdigest
    for at in range(0, n, _BATCH):
        stop = min(n, at + _BATCH)
        hashes = [
            hash_of(joined[a : b - 1], SEED)
            for a, b in zip(starts[at:stop], ends[at + width - 1 : stop + width - 1])
        ]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * set_bits > n, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = WORDS) -> DataFrame:
    """doc_id and fingerprint (signed 64-bit) per row."""
    kind = id_type(docs)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = [fingerprint(t, width) for t in as_bytes(batch.column(1))]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), pa.array(made, pa.int64())], ["doc_id", "bits"]
            )

        return step

    return map_rows(texts(docs), f"doc_id {kind}, bits long", make)


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def masks(radius: int = RADIUS) -> list[int]:
    """The covering family: 2^(radius+1) - 1 masks of the positions that a table's key keeps."""
    size = 1 << (radius + 1)
    vector = [i % (size - 1) + 1 for i in range(64)]
    return [
        sum(1 << i for i in range(64) if (vector[i] & v).bit_count() % 2) for v in range(1, size)
    ]


def finer(mask: int, radius: int = RADIUS) -> list[int]:
    """Masks that keep `mask` and all but `radius` of 2 * radius blocks of the other positions."""
    free = [i for i in range(64) if not mask >> i & 1]
    blocks = [sum(1 << i for i in free[k :: 2 * radius]) for k in range(2 * radius)]
    return [mask | sum(kept) for kept in combinations(blocks, radius)]


def linked(own: np.ndarray, radius: int) -> np.ndarray:
    """For distinct fingerprints the position of a common member of each one's linked group."""
    root = np.full(len(own), -1)
    for first in range(len(own)):
        if root[first] >= 0:
            continue
        root[first], waiting = first, [first]
        while waiting:
            near = np.bitwise_count(own ^ own[waiting.pop()]) <= radius
            new = np.flatnonzero(near & (root < 0))
            root[new] = first
            waiting += new.tolist()
    return root


def linked_crowd(own: np.ndarray, radius: int) -> np.ndarray:
    """As linked(), by looking up every fingerprint within the radius instead of comparing all."""
    varying = int(np.bitwise_or.reduce(own ^ own[0]))
    places = [i for i in range(64) if varying >> i & 1]
    steps = [
        np.uint64(sum(1 << i for i in chosen)) for k in range(1, radius + 1) for chosen in combinations(places, k)
    ]
    order = np.argsort(own)
    ranked, root = own[order], np.arange(len(own))
    while True:
        before = root.copy()
        for step in steps:
            at = np.minimum(np.searchsorted(ranked, ranked ^ step), len(ranked) - 1)
            root = np.where(ranked[at] == ranked ^ step, np.minimum(root, root[at]), root)
        root = root[root]
        if (root == before).all():
            break
    found = np.empty(len(own), np.int64)
    found[order] = order[root]
    return found


def _stars(sorted_rows: DataFrame, radius: int, crowd: int | None) -> DataFrame:
    """Over rows (t, key, bits), equal keys side by side: links a-b, and rows of crowded keys (t >= 0)."""

    def run(batches):
        kept_t, kept_key, kept = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64)
        crowded = None  # the key whose rows go on as they come

        def finish(t, key, own):
            nonlocal crowded
            if not len(own):
                return
            change = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
            starts, ends = np.append(0, change), np.append(change, len(own))
            size = ends - starts
            two = starts[size == 2]
            near = two[np.bitwise_count(own[two] ^ own[two + 1]) <= radius]
            yield np.full(len(near), -1, np.int32), own[near + 1], own[near]
            for s, e in zip(starts[size > 2], ends[size > 2]):
                part = np.unique(own[s:e])
                root = linked(part, radius) if len(part) <= CROWD else linked_crowd(part, radius)
                to = part[root]
                yield np.full(int((to != part).sum()), -1, np.int32), part[to != part], to[to != part]

        def rows(found):
            for t, a, b in found:
                if len(t):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(t), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["t", "a", "b"]
                    )

        for batch in batches:
            if not batch.num_rows:
                continue
            t = np.concatenate([kept_t, batch.column(0).to_numpy(zero_copy_only=False)])
            key = np.concatenate([kept_key, batch.column(1).to_numpy(zero_copy_only=False)])
            own = np.concatenate([kept, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)])
            if crowd is not None:
                change = np.flatnonzero((t[1:] != t[:-1]) | (key[1:] != key[:-1])) + 1
                starts, ends = np.append(0, change), np.append(change, len(own))
                big = ends - starts > crowd
                if crowded is not None:
                    big |= (t[starts] == crowded[0]) & (key[starts] == crowded[1])
                out = np.repeat(big, ends - starts)
                yield from rows([(t[out].astype(np.int32), own[out], own[out])])
                if big[-1]:
                    crowded = (t[-1], key[-1])
                t, key, own = t[~out], key[~out], own[~out]
            if not len(own):
                kept_t, kept_key, kept = t, key, own
                continue
            last = int(np.flatnonzero((t == t[-1]) & (key == key[-1]))[0])
            yield from rows(finish(t[:last], key[:last], own[:last]))
            kept_t, kept_key, kept = t[last:], key[last:], own[last:]
        yield from rows(finish(kept_t, kept_key, kept))

    return sorted_rows.mapInArrow(run, "t int, a long, b long")


def _keyed(rows: DataFrame, tables: list[tuple[int, int]], parent: bool) -> DataFrame:
    """Each fingerprint under the key of each table (number, mask), dealt out and sorted by key."""
    keys = [
        F.struct(F.lit(n).cast("int").alias("t"), F.col("bits").bitwiseAND(F.lit(signed(m))).alias("key"))
        for n, m in tables
    ]
    if parent:  # tables of the crowded rows' own parent only
        per = len(tables) // (max(n for n, _ in tables) // 1000 + 1)
        choice = F.array(*[F.array(*keys[k : k + per]) for k in range(0, len(keys), per)])
        made = F.element_at(choice, F.col("t") + 1)
    else:
        made = F.array(*keys)
    dealt = rows.select(F.explode(made).alias("k"), "bits").select("k.t", "k.key", "bits")
    return dealt.repartition("t", "key").sortWithinPartitions("t", "key", "bits")


def links(distinct: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """Edges a-b between fingerprints that connect the same groups as all links within the radius."""
    family = masks(radius)
    first = materialise(_stars(_keyed(distinct, list(enumerate(family)), False), radius, crowd), "simhash-links")
    rest = first.filter("t >= 0").select("t", F.col("a").alias("bits"))
    tables = [(1000 * n + k, m) for n, mask in enumerate(family) for k, m in enumerate(finer(mask, radius))]
    second = _stars(_keyed(rest, tables, True), radius, None)
    return first.filter("t < 0").select("a", "b").unionByName(second.select("a", "b"))


def near_duplicates(
    docs: DataFrame, width: int = WORDS, radius: int = RADIUS, crowd: int = CROWD
) -> DataFrame:
    """doc_id, fingerprint and component_id, the smallest id reachable over links within the radius."""
    rows = materialise(fingerprints(docs, width), "fingerprints")
    distinct = materialise(rows.groupBy("bits").agg(F.min("doc_id").alias("first_id")), "fingerprint-ids")
    roots = components(links(distinct.select("bits"), radius, crowd))
    placed = distinct.join(roots, distinct["bits"] == roots["node"], "left").select(
        "bits", "first_id", F.coalesce("root", "bits").alias("root")
    )
    least = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_bits = placed.join(least, "root").select("bits", "component_id")
    return rows.join(of_bits, "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id"
    )
