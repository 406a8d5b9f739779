"""Scoring of texts by a hidden Markov language model that Baum-Welch trains on the corpus.

A text is its words, A-Z in lower case, then one end. A state emits a class of words, and the class a word
of it, so the probability of a text is the sum over all paths of states of transitions and class emissions,
times the words' shares in their classes. A word with at least a share 1/OWN of all training tokens is a class of its
own; the others fall into TAIL classes by a hash of their last three bytes. Classes therefore have a bounded number
however large the vocabulary is, while every word keeps its exact count: in a class, a word seen c times has
the share (c + 1) / (C + V + 1), with C tokens and V distinct words of the class, and all unseen words
together have 1 / (C + V + 1).

Training: pairs of neighbouring classes, counted over the corpus and folded to COARSE classes, give the first
model by EM on that table alone. Then each Baum-Welch round runs the scaled forward and backward recursions over
all training texts; expected counts of first states, transitions and emissions are summed per task and then by
Spark, and only the sums, whose number does not depend on the corpus, reach the driver. Texts are scored
by the scaled forward recursion in double precision: the logarithms of its scales add up to the exact likelihood.

Counts of frequent words (a share of 1/LISTED at least, so at most LISTED words) travel to the texts; the
rest travel to their counts, so no key of that join holds more than that share of the tokens. Words of over
LONG bytes go by their SHA-256.

Defined results: a null text is empty and has the end alone; a null id counts as an empty one for the choice of
training texts; rows that repeat an id are scored and learnt from one by one; without training texts every word is unknown,
and the score equals the base score; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import arrow_type, as_bytes, id_type, materialise, parts, texts

STATES = 8
#: Rounds of Baum-Welch over the corpus, and of EM on the table of pairs before them.
ROUNDS, FIRST_ROUNDS = 2, 60
#: Least shares of words that are classes of their own and of words whose counts are sent to all tasks.
OWN, LISTED = 2048, 1 << 16
TAIL, COARSE = 1024, 512
LONG = 32
#: Pseudo-tokens per state that keep the corpus-wide share of each class.
PRIOR = 64.0
#: Tokens whose recursions run side by side, and words that a task counts before it hands them on.
TOGETHER, HELD = 1 << 20, 500_000
END = b"\n"  # no word holds it


def words(text: bytes) -> Iterator[list[bytes]]:
    """Lower-case words of a text, a part at a time; long ones by digest."""
    for part in parts(text):
        found = part.lower().split()
        if len(part) > LONG and max(map(len, found), default=0) > LONG:
            found = [w if len(w) <= LONG else b"\xff" + hashlib.sha256(w).digest() for w in found]
        yield found


def tail_class(word: bytes) -> int:
    return crc32(word[-3:]) % TAIL


@dataclass
class Model:
    """`counts` is a written table of word, tail class and c; the arrays do not grow with the corpus."""

    counts: DataFrame
    tokens: int
    distinct: int
    listed: dict[bytes, tuple[int, int]]  # class and count of frequent words
    mass: np.ndarray  # C + V + 1 of each class
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # states by classes

    @property
    def classes(self) -> int:
        return len(self.mass)


def training(docs: DataFrame) -> DataFrame:
    """doc_id, text and held_out: texts whose crc32 of the id, as text, leaves 2 when divided by 7 are held out."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return texts(docs).withColumn("held_out", F.crc32(own.cast("binary")) % 7 == 2)


def count_words(rows: DataFrame) -> DataFrame:
    """word, tail class and count over texts, the end included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted: Counter = Counter()

        def out() -> pa.RecordBatch:
            found = list(counted)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(found, pa.binary()), pa.array(list(map(tail_class, found)), pa.int32()),
                    pa.array(list(counted.values()), pa.int64()),
                ],
                ["word", "tail", "c"],
            )

        for batch in batches:
            for text in as_bytes(batch.column(0)):
                for found in words(text):
                    counted.update(found)
                if len(counted) > HELD:
                    yield out()
                    counted.clear()
            counted[END] += batch.num_rows
        if counted:
            yield out()

    made = rows.select("text").mapInArrow(run, "word binary, tail int, c long")
    return made.groupBy("word", "tail").agg(F.sum("c").alias("c"))


def tokens(rows: DataFrame, listed: dict[bytes, tuple[int, int]], every: int, first_tail: int) -> DataFrame:
    """Texts as classes, written once and read by every round.

    row, doc_id, held_out, n_tokens, classes (two bytes each), n_known and base (the sum of log10(c + 1)) and
    inside (the sum of log10 of shares in the class but for its mass) over listed words, and the other words
    with their numbers of occurrences.
    """
    kind = id_type(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number: dict[bytes, int] = {w: k for w, (k, _) in listed.items()}
        logs = {w: math.log10(c + 1) for w, (_, c) in listed.items()}
        known: dict[bytes, int] = dict(number)

        def one(text: bytes) -> tuple:
            classes, counted = [], Counter()
            for found in [*words(text), [END]]:
                counted.update(found)
                for w in set(found).difference(known):
                    known[w] = first_tail + tail_class(w)
                classes.append(np.fromiter(map(known.__getitem__, found), "<u2", len(found)))
            classes = np.concatenate(classes)
            rest = [w for w in counted if w not in number]
            times = [counted.pop(w) for w in rest]
            base = math.fsum(n * logs[w] for w, n in counted.items())
            if len(known) > HELD:
                known.clear()
                known.update(number)
            return len(classes), classes.tobytes(), sum(counted.values()), base, rest, times

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                own = batch.slice(at, 1000)
                n, classes, seen, base, rest, times = zip(*map(one, as_bytes(own.column(1))))
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column(0).cast(arrow_type(kind)), own.column(2), pa.array(n, pa.int64()),
                        pa.array(classes, pa.binary()), pa.array(seen, pa.int64()), pa.array(base, pa.float64()),
                        pa.array(rest, pa.list_(pa.binary())), pa.array(times, pa.list_(pa.int64())),
                    ],
                    ["doc_id", "held_out", "n_tokens", "classes", "n_known", "base", "rest", "times"],
                )

    columns = "held_out boolean, n_tokens long, classes binary, n_known long, base double, rest array<binary>, times array<long>"
    made = rows.select("doc_id", "text", "held_out").mapInArrow(run, f"doc_id {kind}, {columns}")
    return materialise(made.withColumn("row", F.monotonically_increasing_id()), "markov-tokens")


class Together:
    """Texts side by side, longest first: step t holds the t-th class of all texts that have one."""

    def __init__(self, sequences: list[np.ndarray]):
        self.order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
        sequences = [sequences[i] for i in self.order]
        self.lengths = np.array([len(s) for s in sequences], np.int64)
        flat = np.concatenate(sequences)
        place = np.arange(len(flat)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.width = np.bincount(place)  # texts at each step
        self.at = np.concatenate([[0], np.cumsum(self.width)])
        self.classes = np.empty(len(flat), np.int64)
        self.classes[self.at[place] + np.repeat(np.arange(len(sequences)), self.lengths)] = flat


def together(lists: list[bytes]) -> Iterator[tuple[list[int], Together]]:
    """Groups of texts with some TOGETHER tokens, and which texts they are."""
    lists = [np.frombuffer(x, "<u2") for x in lists]
    group, size = [], 0
    for i, sequence in enumerate(lists):
        if group and size + len(sequence) > TOGETHER:
            yield group, Together([lists[k] for k in group])
            group, size = [], 0
        group.append(i)
        size += len(sequence)
    if group:
        yield group, Together([lists[k] for k in group])


def likelihoods(side: Together, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """log10 of the probability of each text's classes, by the scaled forward recursion."""
    total = np.zeros(len(side.lengths))
    of = np.ascontiguousarray(emit.T)
    now = None
    for t, width in enumerate(side.width.tolist()):
        seen = of[side.classes[side.at[t] : side.at[t] + width]]
        now = (start if t == 0 else now[:width] @ move) * seen
        scale = now.sum(axis=1)
        now /= scale[:, None]
        total[:width] += np.log10(scale)
    out = np.empty_like(total)
    out[side.order] = total
    return out


def expected(side: Together, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple:
    """Expected counts of first states, transitions and emissions, and the log-likelihood, of texts side by side."""
    start, move, of = (np.ascontiguousarray(x, np.float32) for x in (start, move, emit.T))
    seen = of[side.classes]
    alpha = np.empty_like(seen)
    scale = np.empty(len(seen), np.float32)
    widths, at = side.width.tolist(), side.at.tolist()
    now = None
    for t, width in enumerate(widths):
        own = slice(at[t], at[t] + width)
        now = np.multiply(start if t == 0 else now[:width] @ move, seen[own], out=alpha[own])
        scale[own] = now.sum(axis=1)
        now /= scale[own, None]
    log = float(np.log10(scale, dtype=np.float64).sum())
    seen /= scale[:, None]
    moved = np.zeros(move.shape)
    back = np.ascontiguousarray(move.T)
    for t in range(len(widths) - 2, -1, -1):  # alpha turns into the states' probabilities given the whole text
        nxt = slice(at[t + 1], at[t + 1] + widths[t + 1])
        ahead = seen[nxt]  # emission times what follows
        here = alpha[at[t] : at[t] + widths[t + 1]]
        moved += here.T @ ahead
        beta = ahead @ back
        here *= beta
        seen[at[t] : at[t] + widths[t + 1]] *= beta
    first = alpha[: widths[0]].sum(axis=0, dtype=np.float64)
    emitted = np.stack([np.bincount(side.classes, alpha[:, s], emit.shape[1]) for s in range(len(start))])
    return first, moved * move, emitted, log


def _sums(rows: DataFrame, make, size: int) -> np.ndarray:
    """Arrays of `size` that `make` adds up over batches of class lists, summed over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += make(batch.column(0).to_pylist())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["cell", "value"])

    out = np.zeros(size)
    summed = rows.select("classes").mapInArrow(run, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value"))
    found = summed.toArrow()  # at most one row per cell
    out[found["cell"].to_numpy()] = found["value"].to_numpy()
    return out


def pair_counts(rows: DataFrame, coarse: np.ndarray) -> np.ndarray:
    """How often each coarse class follows each other one; the last row counts first classes."""

    def make(lists: list[bytes]) -> np.ndarray:
        lengths = np.array([len(x) // 2 for x in lists])
        flat = coarse[np.frombuffer(b"".join(lists), "<u2")]
        before = np.concatenate([[COARSE], flat[:-1]])
        before[np.cumsum(lengths) - lengths] = COARSE
        return np.bincount(before * COARSE + flat, minlength=(COARSE + 1) * COARSE)

    return _sums(rows, make, (COARSE + 1) * COARSE).reshape(COARSE + 1, COARSE)


def first_model(pairs: np.ndarray, share: np.ndarray, coarse: np.ndarray) -> tuple:
    """Start, moves and emissions from EM on the table of pairs, spread to all classes by their shares."""
    table = pairs[:COARSE]
    total = pairs.sum(axis=0) + 1e-9
    draw = np.random.default_rng(1)
    emit = total * np.exp(draw.normal(0, 0.5, (STATES, COARSE)))
    emit /= emit.sum(axis=1, keepdims=True)
    both = np.full((STATES, STATES), 0.2 / STATES) + 0.8 * np.eye(STATES)
    both /= both.sum()  # probability of a pair of states
    for _ in range(FIRST_ROUNDS):
        likely = np.maximum(emit.T @ both @ emit, 1e-300)
        ratio = table / likely
        new_both = both * (emit @ ratio @ emit.T)
        left = emit * (both @ emit @ ratio.T)
        right = emit * (both.T @ emit @ ratio)
        emit = left + right + PRIOR * total / total.sum()
        emit /= emit.sum(axis=1, keepdims=True)
        both = (new_both + 1e-3) / (new_both + 1e-3).sum()
    move = both / both.sum(axis=1, keepdims=True)
    start = emit @ (pairs[COARSE] / np.maximum(total, 1e-9)) * both.sum(axis=1) + 1e-6
    per = np.bincount(coarse, share, COARSE)
    fine = emit[:, coarse] * (share / np.maximum(per[coarse], 1e-300))
    return start / start.sum(), move, fine / fine.sum(axis=1, keepdims=True)


def _updated(first: np.ndarray, moved: np.ndarray, emitted: np.ndarray, share: np.ndarray) -> tuple:
    start, move, emit = first + 1.0, moved + 1.0, emitted + PRIOR * share
    return start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True)


def fit(rows: DataFrame, rounds: int = ROUNDS) -> tuple[Model, DataFrame, list[float]]:
    """The model learnt from rows of training() that are not held out, all rows as tokens(), and the
    log10 likelihood of the training classes before each round."""
    counts = materialise(count_words(rows.filter("not held_out")), "markov-counts")
    every, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = [
        (bytes(r.word), r.c)
        for r in counts.filter(F.col("c") * LISTED >= every).select("word", "c").collect()
    ]  # at most LISTED words of at most LONG + 1 bytes
    own = sorted(w for w, c in frequent if c * OWN >= every)
    number = {w: k for k, w in enumerate(own)}
    listed = {w: (number.get(w, len(own) + tail_class(w)), c) for w, c in frequent}
    size = len(own) + TAIL
    seen, kinds = np.zeros(size), np.zeros(size)
    for r in counts.groupBy("tail").agg(F.sum("c").alias("c"), F.count("*").alias("v")).collect():
        seen[len(own) + r.tail], kinds[len(own) + r.tail] = r.c, r.v
    for w in own:
        k, c = listed[w]
        seen[k], kinds[k] = c, 1
        seen[len(own) + tail_class(w)] -= c
        kinds[len(own) + tail_class(w)] -= 1
    written = tokens(rows, listed, every, len(own))
    learnt = written.filter("not held_out")
    mass = seen + kinds + 1
    share = (seen + 1) / (seen + 1).sum()
    ranked = np.argsort(-seen[: len(own)], kind="stable")
    coarse = COARSE // 2 + np.arange(size) % (COARSE // 2)
    coarse[ranked[: COARSE // 2]] = np.arange(min(len(own), COARSE // 2))
    start, move, emit = first_model(pair_counts(learnt, coarse), share, coarse)
    history = []
    for _ in range(rounds if every else 0):
        parameters = start, move, emit

        def make(lists: list[bytes], parameters=parameters) -> np.ndarray:
            total = np.zeros(1 + STATES + STATES**2 + STATES * size)
            for _, side in together(lists):
                first, moved, emitted, log = expected(side, *parameters)
                total += np.concatenate([[log], first, moved.ravel(), emitted.ravel()])
            return total

        log, first, moved, emitted = np.split(
            _sums(learnt, make, 1 + STATES + STATES**2 + STATES * size), np.cumsum([1, STATES, STATES**2])
        )
        history.append(float(log[0]))
        start, move, emit = _updated(first, moved.reshape(STATES, STATES), emitted.reshape(STATES, size), share)
    return Model(counts, int(every), int(distinct), listed, mass, start, move, emit), written, history


def score(written: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of rows of tokens()."""
    kind = id_type(written)
    start, move, emit, mass = model.start, model.move, model.emit, np.log10(model.mass)

    along = ("row", "doc_id", "held_out", "n_tokens", "n_known", "base")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("classes").to_pylist()
            path, inside = np.empty(len(lists)), np.empty(len(lists))
            for which, side in together(lists):
                path[which] = likelihoods(side, start, move, emit)
                for i in which:
                    inside[i] = mass[np.frombuffer(lists[i], "<u2")].sum()
            yield pa.RecordBatch.from_arrays(
                [*map(batch.column, along), pa.array(path), pa.array(inside)], [*along, "path", "mass"]
            )

    columns = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, path double, mass double"
    every = written.select(*along, "classes").mapInArrow(run, columns)
    rest = written.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select(
        "row", F.col("x.rest").alias("word"), F.col("x.times").alias("times")
    )
    counts = model.counts.filter(F.col("c") * LISTED < model.tokens).select("word", "c")
    seen = rest.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("logs")
    )
    unit = math.log10(model.tokens + model.distinct + 1)
    known = F.col("n_known") + F.coalesce("more", F.lit(0))
    spelled = F.col("base") + F.coalesce("logs", F.lit(0.0))
    base = spelled - F.col("n_tokens") * unit
    full = F.col("path") + spelled - F.col("mass") if model.tokens else base
    return every.join(seen, "row", "left").select(
        "doc_id", "held_out", "n_tokens", known.cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        F.round(base, 6).alias("base_score"), F.round(full, 6).alias("score"),
    )


def language_scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    model, written, _ = fit(training(docs), rounds)
    return score(written, model)
