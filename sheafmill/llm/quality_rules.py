"""Quality rules: exact base counts, and a hashed n-gram logistic regression with calibrated output.

Features are hashed word unigrams and bigrams and hashed four-byte character n-grams of the whole
text, each family as shares of its n-grams. The regression is trained on a bounded, documented sample
of labelled rows (SAMPLE, smallest hashes of the id first); one fifth of it, unseen in training, fits the
probability calibration. Texts are scored in Arrow batches; KEEP_AT is the fixed threshold.

Defined results: a null text has no words; a text without words has base_failed; a null id keeps its
row; rows that repeat an id are scored one by one; without labels of both classes the model passes
every text, so only the base rules decide; other columns are untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill.llm.common import arrow_type, as_bytes, id_type, map_rows, texts

#: Labelled rows that the model may be trained on, at most.
SAMPLE = 2000
#: Texts whose calibrated probability of good quality is lower are rejected.
KEEP_AT = 0.5
#: A text with fewer words is rejected, and one whose repeated words exceed this percentage.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Buckets of one n-gram family.
BITS = 16
SCALE = 50.0
_SLICE = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_LEFT, _RIGHT = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_SYMBOLS = b"#*$%&|<>"


@dataclass
class Model:
    """Weights of the word and of the character buckets, intercept, and the calibration's line."""

    words: np.ndarray
    chars: np.ndarray
    intercept: float
    slope: float
    shift: float

    def probability(self, score: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * score + self.shift, -500, 500))))


def code_points(data: bytes) -> int:
    if data.isascii():
        return len(data)
    return int(np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80))


def repeated_words(ids: np.ndarray) -> int:
    """Words inside three-word windows that occur at least twice."""
    if len(ids) < 4:
        return 0
    size = int(ids.max()) + 1
    pairs = ids[:-1] * size + ids[1:]
    if size > 2_000_000:  # the code of three words would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    order = np.sort(windows)
    again = order[1:][order[1:] == order[:-1]]
    if not len(again):
        return 0
    hit = np.isin(windows, again)
    covered = np.zeros(len(ids), bool)
    for k in range(3):
        covered[k : k + len(hit)] |= hit
    return int(covered.sum())


def base_counts(data: bytes, words: list[bytes], ids: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    joined = b"".join(words)
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = len(joined) - len(joined.translate(None, _SYMBOLS))
    return len(words), code_points(joined), symbols, len(lines) - len(set(lines)), repeated_words(ids)


def split(data: bytes) -> tuple[list[bytes], list[bytes], np.ndarray]:
    """Words, distinct words, and each word's number among the distinct ones."""
    words, known = data.split(), {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    return words, list(known), ids


def word_buckets(distinct: list[bytes], ids: np.ndarray) -> np.ndarray:
    hashed = np.array([crc32(w) for w in distinct], np.uint64)[ids]
    both = np.concatenate([hashed * _ODD, (hashed[:-1] * _LEFT + hashed[1:] * _RIGHT) * _ODD])
    return (both >> np.uint64(64 - BITS)).astype(np.int32)


def char_buckets(data: bytes) -> Iterator[np.ndarray]:
    """Buckets of all four-byte n-grams, a slice of the text at a time."""
    for at in range(0, max(0, len(data) - 3), _SLICE):
        b = np.frombuffer(data[at : at + _SLICE + 3], np.uint8).astype(np.uint32)
        grams = b[:-3] | (b[1:-2] << 8) | (b[2:-1] << 16) | (b[3:] << 24)
        yield ((grams * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int32)


def score(model: Model, data: bytes, distinct: list[bytes], ids: np.ndarray) -> float:
    total = model.intercept
    if len(ids):
        total += SCALE * float(model.words[word_buckets(distinct, ids)].mean())
    if len(data) > 3:
        total += SCALE * sum(float(model.chars[b].sum()) for b in char_buckets(data)) / (len(data) - 3)
    return total


def _features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers (characters behind words) and their shares."""
    _, distinct, ids = split(data)
    found = [(0, word_buckets(distinct, ids))] if len(ids) else []
    if grams := list(char_buckets(data)):
        found.append((1 << BITS, np.concatenate(grams)))
    at, share = [np.empty(0, np.int32)], [np.empty(0)]
    for offset, buckets in found:
        own, counts = np.unique(buckets, return_counts=True)
        at.append(own.astype(np.int32) + offset)
        share.append(SCALE * counts / len(buckets))
    return np.concatenate(at), np.concatenate(share)


def train(samples: list[bytes], good: np.ndarray, rounds: int = 120) -> Model | None:
    """Logistic regression by Adam steps on the whole sample; calibrated on every fifth row."""
    if len(set(good.tolist())) < 2:
        return None
    rows = [_features(s) for s in samples]
    size = 2 << BITS
    held = np.arange(len(rows)) % 5 == 4
    if len(set(good[held].tolist())) < 2 or len(set(good[~held].tolist())) < 2:
        held[:] = False
    use = np.flatnonzero(~held)
    at = np.concatenate([rows[i][0] for i in use])
    share = np.concatenate([rows[i][1] for i in use])
    row = np.repeat(np.arange(len(use)), [len(rows[i][0]) for i in use])
    y, w, bias = good[use].astype(float), np.zeros(size + 1), size
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, rounds + 1):
        margin = np.bincount(row, share * w[at], len(use)) + w[bias]
        error = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - y
        slope = np.bincount(at, share * error[row], size + 1) / len(use)
        slope[bias] = error.mean()
        slope += 1e-5 * w
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model = Model(w[: 1 << BITS], w[1 << BITS : size], float(w[bias]), 1.0, 0.0)
    if held.any():
        check = np.flatnonzero(held)
        margin = np.array([rows[i][1] @ w[rows[i][0]] for i in check]) + w[bias]
        model.slope, model.shift = _platt(margin, good[check].astype(float))
    return model


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the calibrated probability: damped Newton steps towards smoothed targets."""
    pos, neg = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    spread = float(margin.std()) or 1.0
    x = np.stack([margin / spread, np.ones_like(margin)], 1)

    def loss(line: np.ndarray) -> float:
        z = x @ line
        return float((np.logaddexp(0, z) - target * z).sum() + 0.5 * line @ line)

    line = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -500, 500)))
        slope = x.T @ (p - target) + line
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and loss(line - size * step) > loss(line):
            size /= 2
        line = line - size * step
    return float(line[0]) / spread, float(line[1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """The model, trained in one task on at most `sample` labelled texts; None without both classes."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    labelled = texts(docs).join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "text", F.col("quality").cast("long").alias("quality")
    )

    def run(batches):
        seen: dict = {}
        for batch in batches:
            for key, data, good in zip(
                batch.column(0).to_pylist(), as_bytes(batch.column(1)), batch.column(2).to_pylist()
            ):
                seen[key] = min(seen.get(key, (data, good)), (data, good))
        keys = sorted(seen, key=lambda k: (crc32(str(k).encode()), str(k)))
        model = train([seen[k][0] for k in keys], np.array([seen[k][1] > 0 for k in keys], int))
        if model is not None:
            yield pa.RecordBatch.from_pydict({
                "words": [model.words.astype("<f4").tobytes()],
                "chars": [model.chars.astype("<f4").tobytes()],
                "line": [[model.intercept, model.slope, model.shift]],
            }, schema=pa.schema([
                ("words", pa.binary()), ("chars", pa.binary()), ("line", pa.list_(pa.float64())),
            ]))

    row = labelled.repartition(1).mapInArrow(run, "words binary, chars binary, line array<double>").first()
    if row is None:
        return None
    return Model(np.frombuffer(row[0], "<f4"), np.frombuffer(row[1], "<f4"), *row[2])


def assess(data: bytes, model: Model | None) -> tuple[int, int, int, int, int, bool, float | None, bool]:
    """The counts, base_failed, the calibrated probability and the verdict of one text."""
    words, distinct, ids = split(data)
    counts = base_counts(data, words, ids)
    failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEATED * counts[0]
    good = None if model is None else model.probability(score(model, data, distinct, ids))
    return (*counts, failed, good, not failed and (good is None or good >= KEEP_AT))


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, the counts, base_failed, probability and kept, per row of `docs`."""
    kind = id_type(docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            made = list(zip(*[assess(t, sent.value) for t in as_bytes(batch.column(1))]))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            return pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_type(kind)), *[pa.array(v, k) for v, k in zip(made, kinds)]],
                ["doc_id", *COUNTS, "base_failed", "probability", "kept"],
            )

        return step

    schema = (
        f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
        + ", base_failed boolean, probability double, kept boolean"
    )
    return map_rows(texts(docs), schema, make)


def keep_good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of `docs`, all columns, that pass: a filter in place, without a shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def passes(text):
        return text.map(lambda t: assess((t or "").encode(), sent.value)[-1]).astype(bool)

    return docs.filter(passes(F.coalesce(docs["text"].cast("string"), F.lit(""))))
