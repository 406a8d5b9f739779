"""Packing of token sequences by patterns fitted to the length histogram.

All patterns of at most four documents are enumerated over lengths rounded up to 1/64 of a sequence.
Non-negative least squares fits repeat counts to the histogram, short lengths weighing less; the counts
are rounded down and given real lengths, the last document of a pattern being the longest that fits.
What is left is packed by best fit, longest first, also into the room that the patterns leave. All of this works on counts per length, so its size depends on
the sequence length and not on the number of documents. Documents then find their place by their rank
among those of equal length; ranks are counted in slices by a hash of the id, so that a length that a
third of all documents share is spread like any other.

Defined results: null text is empty and has the closing token alone; rows that repeat an id are packed
one by one; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import os
import re
import struct
from array import array
from functools import lru_cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.llm.common import arrow_type, as_bytes, id_type, map_rows, materialise, texts

CAPACITY = 4096
END = 1
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
#: Pieces of one slice in which ranks are counted, on average.
SLICE = 50_000
#: Steps that lengths are rounded to in patterns, and documents in a pattern, at most.
STEPS, FEW = 64, 4
#: Shares of the fitted repeat counts that are tried.
SHARES = (1.0, 0.9, 0.75)
#: Encoded words that a worker remembers, in each of two generations; longer ones are not remembered.
REMEMBERED, SHORT = 400_000, 32
#: With these characters alone, lower case is the whole normalisation and Python splits the same.
_PLAIN = re.compile(r"[^\t-\r -~¡-įı-ſ]")
_SPECIAL = ("<|startoftext|>", "<|endoftext|>")
#: The vocabulary file's own pattern for what is merged separately.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: The same for texts without characters beyond these, in the standard library's engine.
_RARE = re.compile(r"[^\t-\r -~À-ÖØ-öø-įı-ſ]")
_QUICK = re.compile(r"[a-zß-öø-ſ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\sa-z0-9ß-öø-ſ]+")


class Coder:
    """Texts to ids as packed little-endian numbers; words are encoded together and remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        ends = [k for word, k in self.tokenizer.get_vocab().items() if word.endswith("</w>")]
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ends[ends] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, words: list[str]) -> list[bytes]:
        """The ids of words that are in no memory; each word ends with a token that ends a word."""
        ids = self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        ids = np.array(ids, "<u4")
        cuts = np.flatnonzero(self.ends[ids]) + 1
        if len(cuts) != len(words):
            return [self.ids(w) for w in words]
        data, at = ids.tobytes(), [0, *(4 * cuts).tolist()]
        return [data[i:j] for i, j in zip(at, at[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [not _PLAIN.search(t) and not any(s in t for s in _SPECIAL) for t in texts]
        split = [(_WORDS if _RARE.search(t) else _QUICK).findall(t.lower()) if p else () for t, p in zip(texts, plain)]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        unseen, long = [], {}
        for word in set().union(*split).difference(young):
            if word in old:
                young[word] = old[word]
            else:
                unseen.append(word)
        for word, ids in zip(unseen, self.learn(unseen) if unseen else ()):
            (young if len(word) <= SHORT else long)[word] = ids
        known = young if not long else {**young, **long}
        return [
            b"".join(map(known.__getitem__, s)) if p else self.ids(t) for t, s, p in zip(texts, split, plain)
        ]


@lru_cache(maxsize=2)
def coder(path: str) -> Coder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
    return Coder(path)


def pieces(docs: DataFrame, path: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: documents as token sequences, longer ones cut."""
    kind = id_type(docs)

    def make():
        known = coder(path)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            whole = [t.decode("utf-8", "replace") for t in as_bytes(batch.column(1))]
            rows = []
            for first in range(0, len(whole), 256):
                for i, ids in enumerate(known.encode(whole[first : first + 256]), first):
                    ids += struct.pack("<I", END)
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        rows.append((i, piece, at // 4, len(own) // 4, crc32(own)))
            at, *rest = map(list, zip(*rows))
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)).cast(arrow_type(kind))]
                + [pa.array(v, k) for v, k in zip(rest, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

        return step

    return map_rows(
        texts(docs), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long", make
    )


def patterns(steps: int = STEPS, few: int = FEW) -> list[tuple[int, ...]]:
    """All descending tuples of at most `few` lengths with the sum `steps`."""

    def fill(room: int, most: int, left: int):
        if room == 0:
            yield ()
        elif left:
            for first in range(min(room, most), -(-room // left) - 1, -1):
                for rest in fill(room - first, first, left - 1):
                    yield (first, *rest)

    return list(fill(steps, steps, few))


def nonnegative_least_squares(a: np.ndarray, b: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """min |a x - b| with x >= 0, by an active set."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    floor = 1e-9 * max(1.0, np.abs(a.T @ b).max(initial=0.0))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[active] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= floor:
            break
        active[best] = True
        while True:
            columns = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, columns], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[columns] = z
                break
            low = z <= 0
            own = x[columns]
            share = np.min(own[low] / np.maximum(own[low] - z[low], 1e-300))
            own = own + share * (z - own)
            own[low & (own <= 1e-12 * max(1.0, own.max()))] = 0
            own[np.flatnonzero(low)[np.argmin(own[low])]] = 0
            x[:] = 0
            x[columns] = np.maximum(own, 0)
            active = x > 0
            if not active.any():
                break
    return x


def fit_patterns(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """How often which real lengths share a sequence; counts[n] documents have length n."""
    steps = min(STEPS, capacity)
    step_of = -(-np.arange(capacity + 1) * steps // capacity)
    histogram = np.bincount(step_of, counts, steps + 1)
    shapes = patterns(steps)
    a = np.zeros((steps, len(shapes)))
    for column, shape in enumerate(shapes):
        for s in shape:
            a[s - 1, column] += 1
    weight = np.linspace(1 / steps, 1, steps)
    total = max(1.0, histogram.sum())
    times = total * nonnegative_least_squares(a * weight[:, None], histogram[1:] / total * weight)
    left, made = counts.copy(), []

    def longest(low: int, high: int) -> int:
        """The longest length in (low, high] of which documents are left, else 0."""
        found = np.flatnonzero(left[low + 1 : high + 1])
        return low + 1 + int(found[-1]) if len(found) else 0

    for column in sorted(np.flatnonzero(times >= 1), key=lambda c: shapes[c], reverse=True):
        *first, last = shapes[column]
        turns_left = int(times[column])
        while turns_left:
            chosen: list[int] = []
            for s in first:
                n = longest((s - 1) * capacity // steps, s * capacity // steps)
                if n:
                    left[n] -= 1
                    chosen.append(n)
            room = capacity - sum(chosen)
            n = longest((last - 1) * capacity // steps, room)  # what rounding left goes to the last one
            if n:
                left[n] -= 1
                chosen.append(n)
            if len(chosen) < len(first) + 1:
                np.add.at(left, chosen, 1)
                break
            own, each = np.unique(chosen, return_counts=True)
            more = min(turns_left - 1, int((left[own] // each).min()))
            left[own] -= more * each
            made.append((1 + more, tuple(chosen)))
            turns_left -= 1 + more
    return made


def best_fit(
    counts: np.ndarray, opened: list[tuple[int, tuple[int, ...]]], capacity: int
) -> list[tuple[int, list[tuple[int, int]]]]:
    """Best fit, longest first, on counts: (sequences, [(length, documents of it in each)])."""
    groups: dict[int, list[list]] = {}
    for turns, lengths in opened:
        held = [(n, 1) for n in lengths]
        groups.setdefault(capacity - sum(lengths), []).append([turns, held])
    rooms = sorted(groups)
    done = []

    def put(room: int, turns: int, held: list) -> None:
        if room == 0:
            done.append((turns, held))
            return
        if room not in groups or not groups[room]:
            groups[room] = []
            at = int(np.searchsorted(rooms, room)) if rooms else 0
            if at == len(rooms) or rooms[at] != room:
                rooms.insert(at, room)
        groups[room].append([turns, held])

    if 0 in groups:
        done += [(t, h) for t, h in groups.pop(0)]
        rooms.remove(0)
    for n in range(capacity, 0, -1):
        left = int(counts[n])
        at = int(np.searchsorted(rooms, n)) if rooms else 0
        while left and at < len(rooms):
            room = rooms[at]
            if not groups[room]:
                del groups[room], rooms[at]
                continue
            turns, held = groups[room].pop()
            each = room // n
            full = min(turns, left // each)
            if full:
                put(room - each * n, full, [*held, (n, each)])
            rest = left - full * each
            used = full
            if full < turns and 0 < rest < each:
                put(room - rest * n, 1, [*held, (n, rest)])
                used, rest = used + 1, 0
            if used < turns:
                groups[room].append([turns - used, held])
            left = rest
            at = int(np.searchsorted(rooms, n))
        if left:
            each = capacity // n
            if left // each:
                put(capacity - each * n, left // each, [(n, each)])
            if left % each:
                put(capacity - (left % each) * n, 1, [(n, left % each)])
    return done + [(t, h) for room in groups.values() for t, h in room]


def arrange(counts: np.ndarray, capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns, then best fit for the rest; of a few shares for the patterns the one that needs least."""
    fitted, best = fit_patterns(counts, capacity), None
    for share in SHARES:
        opened = [(int(turns * share), lengths) for turns, lengths in fitted if int(turns * share)]
        left = counts.copy()
        for turns, lengths in opened:
            np.subtract.at(left, list(lengths), turns)
        found = best_fit(left, opened, capacity)
        if best is None or sum(t for t, _ in found) < sum(t for t, _ in best):
            best = found
    return best or []


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Where documents go: per run of ranks of a length its first sequence and the place in it."""
    rows, taken, base = [], np.zeros(capacity + 1, np.int64), 0
    for turns, held in arrange(counts, capacity):
        offset = 0
        for n, each in held:
            rows.append((n, taken[n], each, base, offset))
            taken[n] += turns * each
            offset += n * each
        base += turns
    rows.sort()
    names = ("length", "first_rank", "each", "base", "offset")
    return dict(zip(names, np.array(rows, np.int64).reshape(-1, 5).T))


def ranked(rows: DataFrame, slices: int) -> DataFrame:
    """`rows` with rank, counted from 0 among the rows of equal length."""
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    counts = sliced.groupBy("slice", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("slice", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("slice", "length").orderBy("doc_id", "piece", "ids_crc32")
    numbered = sliced.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(starts, ["slice", "length"]).withColumn("rank", F.col("own") + F.col("before"))


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`rows` of pieces() with sequence_id and offset."""
    rows = materialise(rows, "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in rows.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    sent = rows.sparkSession.sparkContext.broadcast(plan(counts, capacity))
    keep = ("doc_id", "piece", "start", "length", "ids_crc32")

    def make():
        p = sent.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            at = np.empty(len(rank), np.int64)
            for n in np.unique(length):
                low, high = np.searchsorted(p["length"], [n, n + 1])
                own = length == n
                at[own] = low + np.searchsorted(p["first_rank"][low:high], rank[own], "right") - 1
            turn = rank - p["first_rank"][at]
            sequence = p["base"][at] + turn // p["each"][at]
            offset = p["offset"][at] + turn % p["each"][at] * length
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*keep, "sequence_id", "offset"]
            )

        return step

    schema = (
        f"doc_id {id_type(rows)}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long"
    )
    slices = max(1, -(-int(counts.sum()) // SLICE))
    return map_rows(ranked(rows, slices).select(*keep, "rank"), schema, make)


def pack_documents(docs: DataFrame, path: str = VOCABULARY, capacity: int = CAPACITY) -> DataFrame:
    return pack(pieces(docs, path, capacity), capacity)
