"""Phrases that occur more often than their parts let expect, mined in Toivonen's way.

A sample of the texts, drawn by a hash, proposes phrases: those whose count in the sample reaches a lowered
threshold. One pass over all texts then counts, exactly and by their words, the proposed phrases and their
negative border, which is every phrase that occurs and is not proposed itself but has both its longest parts
proposed (for single words: every word). A phrase found frequent that was not proposed is a border failure. An
expansion pass then takes failures as proposed and counts the phrases that this lets in for the first time, and
lets those grow in turn, up to the greatest length. That closes the border: both longest parts of a frequent
phrase are frequent, so they were proposed, or failed and joined, or were let in by the expansion, and in
each case the phrase was counted. The result does not depend on the sample.

A pass reads the texts twice. It first sums counts by hashes cut to 32 bits, which are short to shuffle; phrases under a
cut hash with too small a sum cannot be frequent, and only the others are then counted by their words.

Proposals reach the tasks as a bitmap over 64-bit hashes, sized by their number up to a fixed bound. A collision lets a phrase be counted
that need not be, never the reverse, and counts are kept by the phrase itself, so results do not depend
on hashes. Within a task phrases are numbered exactly, level by level, and summed before the shuffle.

Defined results: a null text is empty; a null language is `und`; rows that repeat an id count each; an empty
table gives no rows; a language without frequent phrases has none; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count as numbers_from

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.llm.common import as_bytes, materialise, parts

#: Occurrences of a phrase worth reporting, its words at most, and phrases reported per language.
FREQUENT, LONGEST, REPORTED = 100, 5, 2000
#: One of so many texts is in the sample; the share of the expected count that is enough there.
SAMPLE, LOWERED = 16, 0.4
#: Least and greatest size of the map of proposals, as powers of two: 16 MB at most.
MAP_BITS = 20, 27
#: Text that is numbered together.
CHUNK = 3 << 19
#: Separators become a full stop, tabs spaces, A-Z lower case.
_PIECES = bytes(
    46 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256)
)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(29)


def _follow(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of its first words and that of its last."""
    mixed = (before ^ (before >> _FOLD)) * _STEP + word
    return (mixed ^ (mixed >> _FOLD)) * _STEP


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes >> np.uint64(64 - _power(bitmap))).astype(np.int64)
    return (bitmap[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


def _power(bitmap: np.ndarray) -> int:
    """Which power of two the number of bits is."""
    return len(bitmap).bit_length() + 5


def _numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each value among the distinct ones, and those."""
    distinct, codes = np.unique(values, return_inverse=True)
    return codes, distinct


class Chunk:
    """Texts of one language as word numbers, 0 between pieces."""

    def __init__(self, lang: str, pieces: list[bytes]):
        self.lang = lang
        ids: dict[bytes, int] = defaultdict(numbers_from().__next__)
        ids[b"."]
        found = b".".join(pieces).replace(b".", b" . ").split()
        self.tokens = np.fromiter(map(ids.__getitem__, found), np.int64, len(found))
        del found
        self.words = list(ids)
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in self.words], np.uint64)

    def n_words(self) -> int:
        return int(np.count_nonzero(self.tokens))

    def spell(self, first: np.ndarray | None, n: int, chosen: np.ndarray) -> pa.Array:
        """The chosen ones of the phrases of n words that start at the given places."""
        words = pa.array(self.words, pa.binary())
        if first is None:
            return words.slice(1).filter(pa.array(chosen))
        first = first[chosen]
        each = [words.take(pa.array(self.tokens[first + k])) for k in range(n)]
        return each[0] if n == 1 else pc.binary_join_element_wise(*each, pa.scalar(b" ", pa.binary()))

    def sampled(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Hashes of all phrases that others can grow from, and their counts."""
        now, inside = self.hashes[self.tokens], self.tokens != 0
        word = now
        for n in range(1, LONGEST):
            if n > 1:
                now, inside = _follow(now[:-1], word[n - 1 :]), inside[:-1] & (self.tokens[n - 1 :] != 0)
            codes, distinct = _numbered(now[inside])
            yield distinct, np.bincount(codes, minlength=len(distinct))

    def counted(
        self, proposed: np.ndarray, before: np.ndarray | None
    ) -> Iterator[tuple[int, np.ndarray | None, np.ndarray, np.ndarray]]:
        """(words, places, hashes, counts) of proposals and their border; single words have no place.

        With `before`, only phrases that were not counted for it, and those grow whether proposed or not.
        """
        tokens, size = self.tokens, len(self.words)
        if before is None:
            times = np.bincount(tokens, minlength=size)[1:]
            yield 1, None, self.hashes[1:], times
        word = self.hashes[tokens]
        grows = (tokens != 0) & _has(proposed, self.hashes)[tokens]
        grew = None if before is None else (tokens != 0) & _has(before, self.hashes)[tokens]
        number, now = tokens, word
        for n in range(2, LONGEST + 1):
            if len(tokens) < n:
                return
            both = grows[:-1] & grows[1:]
            at = np.flatnonzero(both)
            if not len(at):
                return
            codes, distinct = _numbered(number[at] * size + tokens[at + n - 1])
            first = np.empty(len(distinct), np.int64)
            first[codes[::-1]] = at[::-1]
            times = np.bincount(codes, minlength=len(distinct))
            hashes = _follow(now[first], word[first + n - 1])
            if grew is not None:
                old = grew[:-1] & grew[1:]
                fresh = ~old[first]
                yield n, first[fresh], hashes[fresh], times[fresh]
            else:
                yield n, first, hashes, times
            if n == LONGEST:
                return
            number = np.zeros(len(both), np.int64)
            number[at] = codes
            here = np.zeros(len(both), np.uint64)
            here[at] = _follow(now[at], word[at + n - 1])
            now = here
            grows = np.zeros(len(both), bool)
            grows[at] = _has(proposed, now[at])
            if grew is not None:
                grows |= both & ~old
                grew = np.zeros(len(both), bool)
                grew[at] = old[at] & _has(before, now[at])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    waiting: dict[str, list[bytes]] = defaultdict(list)
    size: dict[str, int] = defaultdict(int)
    for batch in (b.slice(k, 500) for b in batches for k in range(0, b.num_rows, 500)):
        for lang, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
            for part in parts(text.translate(_PIECES), b".", CHUNK):
                waiting[lang].append(part)
                size[lang] += len(part)
                if size[lang] >= CHUNK:
                    yield Chunk(lang, waiting.pop(lang))
                    size[lang] = 0
        if len(waiting) > 100 or sum(size.values()) > 4 * CHUNK:  # many languages: hand on what there is
            yield from (Chunk(lang, waiting.pop(lang)) for lang in list(waiting))
            size.clear()
    yield from (Chunk(lang, pieces) for lang, pieces in waiting.items())


def _bitmap(hashes: DataFrame, power: int) -> np.ndarray:
    """The map with the bits of a table of hashes set; at most 2**(power - 6) numbers reach the driver."""
    bit = F.shiftrightunsigned("hash", 64 - power)
    own = hashes.select(
        F.shiftright(bit, 6).cast("int").alias("at"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(hash, {64 - power}) & 63 AS INT))").alias("mask")
    )
    made = own.groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (power - 6), np.uint64)
    out[made["at"].to_numpy()] = made["mask"].to_numpy().view(np.uint64)
    return out


def propose(rows: DataFrame, least: float) -> np.ndarray:
    """The map of phrases whose count among `rows` is at least `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches):
            for hashes, times in chunk.sampled():
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(times)], ["hash", "n"])

    counted = rows.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    return _map(materialise(counted.filter(F.col("n") >= least).select("hash"), "phrases-proposed"))


def _map(hashes: DataFrame) -> np.ndarray:
    """The map of a table of hashes, sized by their number."""
    low, high = MAP_BITS
    return _bitmap(hashes, min(max(low, (16 * hashes.count()).bit_length()), high))


def common(rows: DataFrame, proposed: np.ndarray, before: np.ndarray | None, least: int) -> np.ndarray:
    """The map of phrases counted in a pass whose hashes, cut to 32 bits, occur `least` times or more; it has
    every phrase that does, since phrases that share a cut hash only add to its count."""
    packed, old = proposed.tobytes(), None if before is None else before.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(packed, np.uint64)
        done = None if old is None else np.frombuffer(old, np.uint64)
        for chunk in _chunks(batches):
            for _, _, hashes, times in chunk.counted(bitmap, done):
                cut = (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cut), pa.array(times.astype(np.int64))], ["cut", "n"])

    summed = rows.mapInArrow(run, "cut int, n long").groupBy("cut").agg(F.sum("n").alias("n"))
    hashes = summed.filter(F.col("n") >= least).select(F.shiftleft(F.col("cut").cast("long"), 32).alias("hash"))
    return _map(materialise(hashes, "phrases-common"))


def count(rows: DataFrame, proposed: np.ndarray, before: np.ndarray | None, least: int) -> DataFrame:
    """lang, size, phrase, f of what a pass counts `least` times; in the first also the words of a language, as ''."""
    packed, old = proposed.tobytes(), None if before is None else before.tobytes()
    often = common(rows, proposed, before, least).tobytes()

    def spelled(chunk: Chunk, bitmap: np.ndarray, done: np.ndarray | None) -> Iterator[tuple[pa.Array, np.ndarray]]:
        if done is None:
            yield pa.array([b""]), np.array([chunk.n_words()])
        wanted = np.frombuffer(often, np.uint64)
        for n, first, hashes, times in chunk.counted(bitmap, done):
            chosen = _has(wanted, hashes)
            yield chunk.spell(first, n, chosen), times[chosen]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(packed, np.uint64)
        done = None if old is None else np.frombuffer(old, np.uint64)
        for chunk in _chunks(batches):
            head = pa.scalar(chunk.lang.encode(), pa.binary())
            for phrases, times in spelled(chunk, bitmap, done):
                keys = pc.binary_join_element_wise(head, phrases.cast(pa.binary()), pa.scalar(b"\t", pa.binary()))
                yield pa.RecordBatch.from_arrays([keys.cast(pa.string()), pa.array(times.astype(np.int64))], ["key", "f"])

    # language and phrase travel as one short text; a phrase holds no tab
    summed = rows.mapInArrow(run, "key string, f long").groupBy("key").agg(F.sum("f").alias("f"))
    split = summed.filter((F.col("f") >= least) | F.col("key").endswith("\t")).selectExpr(
        "left(key, char_length(key) - char_length(substring_index(key, '\t', -1)) - 1) AS lang",
        "substring_index(key, '\t', -1) AS phrase", "f",
    )
    size = F.expr("IF(phrase = '', 0, char_length(phrase) - char_length(replace(phrase, ' ', '')) + 1)")
    return materialise(split.select("lang", size.alias("size"), "phrase", "f"), "phrases-counted")


def failures(frequent: DataFrame, proposed: np.ndarray) -> DataFrame:
    """Hashes of frequent phrases that could grow and were not proposed."""
    packed = proposed.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.frombuffer(packed, np.uint64)
        for batch in batches:
            own = []
            for lang, phrase in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                seed = xxhash.xxh64_intdigest(lang.encode())
                word = [np.array([xxhash.xxh64_intdigest(w, seed)], np.uint64) for w in phrase.split(b" ")]
                now = word[0]
                for w in word[1:]:
                    now = _follow(now, w)
                own.append(now[0])
            hashes = np.array(own, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[~_has(bitmap, hashes)].view(np.int64))], ["hash"])

    short = frequent.filter(F.col("size").between(1, LONGEST - 1)).select("lang", "phrase")
    return short.mapInArrow(run, "hash long")


def frequent_phrases(docs: DataFrame, least: int = FREQUENT, sample: int = SAMPLE) -> tuple[DataFrame, int]:
    """lang, size, phrase, f of all phrases with `least` occurrences and of '', the words of each language; and
    how many passes over all texts that took."""
    rows = docs.select(
        F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    drawn = rows.filter(F.pmod(F.xxhash64("lang", "text"), F.lit(sample)) == 0)
    proposed = propose(drawn, max(2.0, least * LOWERED / sample))
    counted = count(rows, proposed, None, least)
    failed = _bitmap(failures(counted, proposed), _power(proposed))
    if not failed.any():
        return counted, 1
    return counted.unionByName(count(rows, proposed | failed, proposed, least)), 2


def collocations(docs: DataFrame, least: int = FREQUENT, reported: int = REPORTED) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's phrases by the score of their weakest cut."""
    frequent, _ = frequent_phrases(docs, least)
    phrases = frequent.filter("size > 0")
    first = F.expr("substring_index(phrase, ' ', size - 1)")
    rest = F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    # a part as frequent as a longer phrase is as frequent as one that is one word longer
    longer = phrases.filter("size > 2").select(
        "lang", F.explode(F.array(first, rest)).alias("phrase"), F.lit(None).cast("int").alias("size"),
        F.lit(None).cast("long").alias("a"), F.col("f").alias("longer"),
    )
    own = phrases.filter("size > 1").selectExpr("lang", "phrase", "size", "f AS a", "CAST(NULL AS LONG) AS longer")
    kept = (
        own.unionByName(longer).groupBy("lang", "phrase")
        .agg(F.max("size").alias("size"), F.max("a").alias("a"), F.max("longer").alias("longer"))
        .filter("a IS NOT NULL AND (longer IS NULL OR longer < a)").drop("longer")
    )
    cuts = kept.withColumn("k", F.explode(F.expr("sequence(1, size - 1)"))).selectExpr(
        "*", "substring_index(phrase, ' ', k) AS head", "substring_index(phrase, ' ', k - size) AS tail"
    )
    heads = phrases.selectExpr("lang", "phrase AS head", "f AS l")
    tails = phrases.selectExpr("lang", "phrase AS tail", "f AS r")
    totals = frequent.filter("size = 0").selectExpr("lang", "f AS n")
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(totals, "lang").withColumn(
        "score",
        F.expr("""CAST(1000 * a AS DECIMAL(19, 0)) * CAST(n AS DECIMAL(18, 0))
                  div (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0)))"""),
    )
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    flat = weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    def best(rows: DataFrame, *keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"), "phrase")
        return rows.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= reported)

    few = best(flat.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))), "lang", "part").drop("part", "rank")
    return best(few, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
