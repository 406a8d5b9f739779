"""Ranked lexical search for a set of items over all documents, half term-at-a-time, half document-at-a-time.

Documents are indexed for the terms of the items only: one row per document with its length, the numbers of
the items' terms in it and how often each occurs. Lists over a batch of documents are split by length. The
short ones are added up term by term into accumulators, which then act as one more list with a bound per
block of documents. Blocks are walked in document order; a block whose bounds over the long lists and the
accumulators cannot reach the item's k-th best score is skipped, and inside a block long lists are added by
falling bound until no document can reach it. What a task finds best are its candidates; ranking those of all
tasks gives the result. No limit lies on lists, candidates or documents.

Items are taken in blocks of BLOCK_BYTES of text, so what travels to the tasks has a bound however many items
there are; each block is a pass over the documents.

Defined results: a null text has no terms; documents without terms rank nowhere; rows that repeat an id rank
one by one; equal scores rank by ascending id, a null id last; items that repeat an id are ranked one by one
under that id; an item without terms, or no documents, gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafmill.llm.common import arrow_type, as_bytes, id_type, map_rows, materialise, parts, texts

BEST = 10
#: Text of the items that one pass over the documents answers.
BLOCK_BYTES = 16 << 20
#: Documents in a block that is skipped or read as a whole.
BLOCK = 128
#: A list is long where it holds more than one of so many documents of a batch.
LONG = 24
#: What is not a term's character becomes a space; A-Z become lower case.
TERMS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, a part of the text at a time."""
    for part in parts(data.translate(TERMS)):
        yield part.split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def index(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), and the numbers and counts of the terms in `numbers`; rows with terms only."""
    kind = id_type(docs)

    def make():
        number = numbers.get

        def one(data: bytes) -> tuple[int, bytes, bytes]:
            n, found = 0, Counter()
            for words in terms(data):
                n += len(words)
                found.update(map(number, words))
            found.pop(None, None)
            return n, np.fromiter(found, "<i4", len(found)).tobytes(), np.fromiter(found.values(), "<i8", len(found)).tobytes()

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n, ids, counts = zip(*map(one, as_bytes(batch.column(1))))
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), pa.array(n, pa.int64())]
                + [pa.array(v, pa.binary()) for v in (ids, counts)],
                ["doc_id", "n", "terms", "counts"],
            )

        return step

    return map_rows(texts(docs), f"doc_id {kind}, n long, terms binary, counts binary", make).filter("n > 0")


def frequencies(indexed: DataFrame, size: int) -> dict[int, int]:
    """Documents that hold each of the `size` numbered terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                total[np.frombuffer(ids, "<i4")] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["term", "df"])

    counted = indexed.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return dict(map(tuple, counted.collect()))  # one row per term of the items


class Lists:
    """Postings of one batch of documents by term, with the greatest score per block for long lists."""

    def __init__(self, n: np.ndarray, ids: list[bytes], counts: list[bytes], weights: np.ndarray, n_docs: int, total: int):
        lengths = np.array([len(x) // 4 for x in ids], np.int64)
        term, tf = np.frombuffer(b"".join(ids), "<i4"), np.frombuffer(b"".join(counts), "<i8")
        if int(n.max()) * 75 * n_docs < 1 << 62:
            m = 25 + 75 * n * n_docs // total
        else:
            m = np.array([25 + 75 * int(x) * n_docs // total for x in n], np.int64)
        doc = np.repeat(np.arange(len(n)), lengths)
        value = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        order = np.argsort(term, kind="stable")
        self.doc, self.value = doc[order], value[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.size, self.blocks = len(n), -(-len(n) // BLOCK)
        self._bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def get(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.starts[term], self.starts[term + 1])
        return self.doc[own], self.value[own]

    def is_long(self, term: int) -> bool:
        return (self.starts[term + 1] - self.starts[term]) * LONG > self.size

    def bounds(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Where each block of a list starts, and its greatest score."""
        if term not in self._bounds:
            doc, value = self.get(term)
            cuts = np.searchsorted(doc, np.arange(self.blocks + 1) * BLOCK)
            most = np.zeros(self.blocks, np.int64)
            np.maximum.at(most, doc // BLOCK, value)
            self._bounds[term] = cuts, most
        return self._bounds[term]


class Best:
    """The k best scores so far; a document that ties the least of them may still have the smaller id."""

    def __init__(self, k: int):
        self.k, self.scores = k, np.empty(0, np.int64)

    @property
    def floor(self) -> int:
        return max(int(self.scores[0]), 1) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray) -> None:
        self.scores = np.sort(np.concatenate([self.scores, scores]))[-self.k :]


def walk(lists: Lists, asked: dict[int, int], best: Best) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a batch that may be among an item's best, and their scores.

    `asked` counts the item's terms. Ends with the floor in `best` raised to what the batch allows.
    """
    summed = np.zeros(lists.blocks * BLOCK, np.int64)
    long = []
    for term, times in asked.items():
        if lists.is_long(term):
            cuts, most = lists.bounds(term)
            long.append((term, times, cuts, most))
        else:
            doc, value = lists.get(term)
            summed[doc] += times * value
    reach = summed.reshape(lists.blocks, BLOCK).max(axis=1)
    for _, times, _, most in long:
        reach = reach + times * most
    docs, scores = [], []
    for block in np.flatnonzero(reach >= best.floor).tolist():
        floor, rest = best.floor, int(reach[block])
        if rest < floor:
            continue
        own = summed[block * BLOCK : (block + 1) * BLOCK].copy()
        rest -= int(own.max())
        for term, times, cuts, most in sorted(long, key=lambda x: -x[1] * int(x[3][block])):
            bound = times * int(most[block])
            if not bound or int(own.max()) + rest < floor:
                break
            doc, value = lists.get(term)
            inside = slice(cuts[block], cuts[block + 1])
            own[doc[inside] - block * BLOCK] += times * value[inside]
            rest -= bound
        else:
            rest = 0
        if rest and int(own.max()) + rest < floor:
            continue
        hit = np.flatnonzero(own >= floor)
        if len(hit):
            best.add(own[hit])
            docs.append(hit + block * BLOCK)
            scores.append(own[hit])
    if not docs:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    docs, scores = np.concatenate(docs), np.concatenate(scores)
    kept = scores >= best.floor
    return docs[kept], scores[kept]


def candidates(
    indexed: DataFrame, asked: list[tuple[int, dict[int, int]]], weights: np.ndarray, n_docs: int, total: int, k: int
) -> DataFrame:
    """no, doc_id, score: every document that may be among the k best of item `no`, all of those included."""
    kind = id_type(indexed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {no: Best(k) for no, _ in asked}
        for batch in batches:
            if not batch.num_rows or not asked:
                continue
            n = np.array(batch.column(1).to_pylist(), np.int64)
            lists = Lists(n, batch.column(2).to_pylist(), batch.column(3).to_pylist(), weights, n_docs, total)
            nos, docs, scores = [], [], []
            for no, own in asked:
                doc, score = walk(lists, own, best[no])
                nos.append(np.full(len(doc), no, np.int64))
                docs.append(doc)
                scores.append(score)
            found = batch.column(0).cast(arrow_type(kind)).take(pa.array(np.concatenate(docs)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(nos)), found, pa.array(np.concatenate(scores))], ["no", "doc_id", "score"]
            )

    return indexed.mapInArrow(run, f"no long, doc_id {kind}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item, best first."""
    asked = items.select(F.col("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    asked = materialise(asked.withColumn("no", F.monotonically_increasing_id()), "search-items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 + int(size) // BLOCK_BYTES
    found = [
        _search_block(docs, [(r.no, r.text) for r in asked.filter(F.pmod(F.xxhash64("no"), F.lit(blocks)) == b).collect()], k)
        for b in range(blocks)
    ]
    ranked = reduce(DataFrame.unionByName, found)
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(asked.select("item_id", "no")) if blocks == 1 else asked.select("item_id", "no"), "no").select(
        "item_id", "rank", "doc_id", "score"
    )


def _search_block(docs: DataFrame, items: list[tuple[int, str]], k: int) -> DataFrame:
    counted = [(no, sum((Counter(words) for words in terms(text.encode())), Counter())) for no, text in items]
    numbers = {term: i for i, term in enumerate(sorted(set().union(*(c for _, c in counted))))}
    indexed = materialise(index(docs, numbers), "search-index")
    n_docs, total = indexed.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = frequencies(indexed, len(numbers))
    weights = np.array([weight(n_docs, held.get(i, 0)) for i in range(len(numbers))], np.int64)
    asked = [(no, {numbers[t]: times for t, times in c.items() if numbers[t] in held}) for no, c in counted if c]
    return materialise(candidates(indexed, asked, weights, n_docs, total, k), "search-candidates")
