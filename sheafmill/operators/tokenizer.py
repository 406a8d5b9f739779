"""Byte-pair vocabulary: training, encoding, decoding, facts.

The vocabulary itself is small by contract (`vocab_size` entries), so it lives on the driver and
travels to the tasks; everything that grows with the corpus stays in DataFrames.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafmill import fixed
from sheafmill.functions import text as tx
from sheafmill.functions.text import col
from sheafmill.operators import merges
from sheafmill.operators.bpe import PairTable, merge_pieces
from sheafmill.operators.ordered import budget_prefix
from sheafmill.session import materialise

#: Pre-tokens of a batch that are encoded together.
TOGETHER = 1 << 20

VOCAB_SCHEMA = T.StructType(
    [
        T.StructField("token_id", T.IntegerType()),
        T.StructField("token", T.BinaryType()),
        T.StructField("is_special", T.BooleanType()),
    ]
)
MERGE_SCHEMA = T.StructType(
    [
        T.StructField("rank", T.IntegerType()),
        T.StructField("left", T.BinaryType()),
        T.StructField("right", T.BinaryType()),
    ]
)


@dataclass
class Vocabulary:
    """Byte tokens by id, the merges in order, and special tokens after all byte tokens."""

    tokens: list[bytes]
    merges: list[tuple[bytes, bytes]] = field(default_factory=list)
    specials: tuple[str, ...] = fixed.SPECIAL_TOKENS

    @property
    def size(self) -> int:
        return len(self.tokens) + len(self.specials)

    @property
    def bos_id(self) -> int:
        return len(self.tokens)

    def pair_table(self) -> PairTable:
        """Any two neighbours whose bytes together are a token may merge, ranked by that token."""
        ids = {t: i for i, t in enumerate(self.tokens)}
        pairs = [
            (ids[t[:cut]], ids[t[cut:]], i, i)
            for i, t in enumerate(self.tokens)
            for cut in range(1, len(t))
            if t[:cut] in ids and t[cut:] in ids
        ]
        return PairTable.of(pairs)

    def vocab_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, bytearray(t), False) for i, t in enumerate(self.tokens)]
        rows += [(self.bos_id + i, bytearray(s, "utf-8"), True) for i, s in enumerate(self.specials)]
        return token_bytes(spark.createDataFrame(rows, VOCAB_SCHEMA))

    def merges_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, bytearray(a), bytearray(b)) for i, (a, b) in enumerate(self.merges)]
        return spark.createDataFrame(rows, MERGE_SCHEMA)

    @classmethod
    def from_frames(cls, vocab: DataFrame, merges: DataFrame) -> Vocabulary:
        entries = sorted((r["token_id"], bytes(r["token"]), r["is_special"]) for r in vocab.collect())
        steps = sorted((r["rank"], bytes(r["left"]), bytes(r["right"])) for r in merges.collect())
        return cls(
            [t for _, t, special in entries if not special],
            [(a, b) for _, a, b in steps],
            tuple(t.decode() for _, t, special in entries if special),
        )


def token_bytes(vocab: DataFrame) -> DataFrame:
    """Add `nbytes`, the UTF-8 length of each token decoded alone; special tokens count zero."""
    return vocab.withColumn("nbytes", F.when(F.col("is_special"), 0).otherwise(tx.display_bytes("token")))


def with_token_bytes(tokens: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Add `nbytes` to rows with a `token_id`; the table sent along is one the driver holds anyway."""
    sizes = vocab.vocab_frame(tokens.sparkSession).select("token_id", "nbytes")
    return tokens.join(F.broadcast(sizes), "token_id")


def vocabulary_facts(vocab: DataFrame) -> DataFrame:
    specials = F.col("is_special")
    return vocab.agg(
        F.count(F.lit(1)).alias("vocab_size"),
        F.count_if(specials).alias("n_special"),
        F.min(F.when(specials, F.col("token_id"))).alias("bos_id"),
    )


# --- pre-tokens ---


def _java_pattern() -> str:
    """The split pattern with Unicode case folding and whitespace asked for where they matter.

    That is faster than the Unicode flag for the whole pattern.
    """
    spelled = fixed.SPLIT_PATTERN.replace("(?i:", "(?iu:")
    return spelled.replace(r"\s", r"\p{IsWhite_Space}").replace(r"\S", r"\P{IsWhite_Space}")


def pieces_of(text: Column | str) -> Column:
    """The pre-tokens of a text, in order; together they are the whole text."""
    return F.regexp_extract_all(col(text), F.lit(_java_pattern()), F.lit(0))


def pretokenize(docs: DataFrame, key: str) -> DataFrame:
    return docs.select(key, F.posexplode(pieces_of("text")).alias("pos", "piece"))


def piece_counts(docs: DataFrame) -> DataFrame:
    """How often each pre-token occurs; counted inside map tasks first."""
    return docs.select(F.explode(pieces_of("text")).alias("piece")).groupBy("piece").agg(
        F.count(F.lit(1)).alias("n")
    )


def pair_counts(docs: DataFrame) -> DataFrame:
    """How often each pair of neighbouring bytes occurs inside pre-tokens: what a first merge ranks."""
    words = piece_counts(docs).select(F.encode("piece", "UTF-8").alias("piece"), "n").where(F.octet_length("piece") > 1)
    starts = F.sequence(F.lit(1), F.octet_length("piece") - 1)
    pairs = words.select("piece", "n", F.explode(starts).alias("i"))
    return pairs.groupBy(F.substring("piece", F.col("i"), F.lit(2)).alias("pair")).agg(F.sum("n").alias("n"))


def training_corpus(
    sharded: DataFrame,
    max_chars: int | None = None,
    doc_cap: int | None = None,
) -> DataFrame:
    """Training documents, all and whole unless limits are asked for.

    With `doc_cap` each is cut to so many characters; with `max_chars` they are taken in order until so
    many are used up.
    """
    train = sharded.where(F.col("split") == "train")
    capped = train if doc_cap is None else train.withColumn("text", F.left("text", F.lit(doc_cap)))
    return capped if max_chars is None else budget_prefix(capped, "pos", F.char_length("text"), max_chars)


# --- training ---

def train_bpe(
    docs: DataFrame,
    vocab_size: int = fixed.VOCAB_SIZE,
    specials: tuple[str, ...] = fixed.SPECIAL_TOKENS,
) -> Vocabulary:
    """Learn merges from the `text` column until `vocab_size` tokens exist or no pair is left.

    The corpus is scanned once, for its pre-token counts; rounds then run over the distinct pre-tokens. Rank:
    count, then left bytes, then right bytes.
    """
    vocab = Vocabulary([bytes([b]) for b in range(256)], [], specials)
    # Every round reads this table, so it is spread over all cores once.
    cores = docs.sparkSession.sparkContext.defaultParallelism
    counts = piece_counts(docs).select(F.encode("piece", "UTF-8").alias("piece"), "n")
    counts = counts.repartition(cores, "piece")

    def to_bytes(batches):
        for batch in batches:
            piece = batch.column(0).cast(pa.binary())
            offsets = np.frombuffer(piece.buffers()[1], np.int32)[piece.offset : piece.offset + len(piece) + 1]
            raw = np.frombuffer(piece.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            symbols = pa.ListArray.from_arrays(pa.array(offsets - offsets[0]), pa.array(raw.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([symbols, batch.column(1)], ["symbols", "n"])

    words = materialise(counts.mapInArrow(to_bytes, merges.WORDS), "words")
    vocab.merges, _ = merges.learn(words, vocab.tokens, vocab_size - len(specials))
    return vocab


# --- encoding and decoding ---


def _bytes_of(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of some strings in a row, and where each starts and the last ends."""
    bounds = np.frombuffer(strings.buffers()[1] or bytes(4), np.int32)[strings.offset :][: len(strings) + 1]
    raw = np.frombuffer(strings.buffers()[2] or b"", np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def _slices(lists: pa.ListArray, size: int) -> Iterator[pa.ListArray]:
    """Rows of a batch in groups of at most `size` values; a longer row is a group of its own."""
    bounds = lists.offsets.to_numpy()
    at = 0
    while at < len(lists):
        end = max(int(np.searchsorted(bounds, bounds[at] + size, "right")) - 1, at + 1)
        end = min(end, len(lists))
        yield lists.slice(at, end - at)
        at = end


def encoder(vocab: Vocabulary):
    """A column function from pre-token arrays to token ids.

    Rows are taken in groups of bounded size, in which each distinct pre-token is encoded once. No shuffle: the
    merge table is small and fixed, while the pre-tokens of a corpus are many and very unevenly spread.
    """
    ids = {t: i for i, t in enumerate(vocab.tokens)}
    table = vocab.pair_table()
    byte_ids = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int32)
    spelled, numbers = pa.array(list(ids), pa.binary()), pa.array(list(ids.values()), pa.int32())

    def tokens_of(pieces: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of some rows behind each other, and how many each row has."""
        flat = pieces.flatten().dictionary_encode()
        distinct = flat.dictionary.cast(pa.binary())
        whole = pc.take(numbers, pc.index_in(distinct, spelled)).fill_null(-1).to_numpy(zero_copy_only=False)
        raw, bounds = _bytes_of(distinct)
        piece = np.repeat(np.arange(len(distinct)), np.diff(bounds))
        split = whole[piece] < 0
        symbols, piece = merge_pieces(byte_ids[raw[split]], piece[split], table, one_by_one=True)
        known = np.flatnonzero(whole >= 0)
        symbols = np.concatenate([symbols, whole[known]])
        piece = np.concatenate([piece, known])
        symbols, each = symbols[np.argsort(piece, kind="stable")], np.bincount(piece, minlength=len(distinct))

        # Put the tokens of every occurrence behind each other.
        first = np.cumsum(each) - each
        codes = flat.indices.to_numpy(zero_copy_only=False)
        sizes = each[codes]
        ends = np.append(0, np.cumsum(sizes))
        take = np.repeat((first[codes] - ends[:-1]).astype(np.int32), sizes)
        take += np.arange(ends[-1], dtype=np.int32)
        bounds = pieces.offsets.to_numpy().astype(np.int64)
        return symbols[take], np.diff(ends[bounds - bounds[0]])

    @F.arrow_udf(T.ArrayType(T.IntegerType(), False))
    def encode(pieces: pa.Array) -> pa.Array:
        # a token has a byte or more; what is not filled of the room for them takes no memory
        room = pc.sum(pc.binary_length(pieces.flatten())).as_py() or 0
        symbols, sizes, n = np.empty(room, np.int32), [[0]], 0
        for rows in _slices(pieces, TOGETHER):
            own, each = tokens_of(rows)
            symbols[n : n + len(own)] = own
            n += len(own)
            sizes.append(each)
        offsets = np.cumsum(np.concatenate(sizes)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(symbols[:n]))

    return encode


def encode(docs: DataFrame, vocab: Vocabulary, prepend_bos: bool = False, out: str = "tokens") -> DataFrame:
    """Add the token ids of `text`. The text of a special token gets no special treatment."""
    tokens = encoder(vocab)(pieces_of(F.coalesce("text", F.lit(""))))
    encoded = docs.withColumn(out, tokens)
    if not prepend_bos:
        return encoded
    return encoded.withColumn(out, F.concat(F.array(F.lit(vocab.bos_id)), F.col(out)))


def decoded(tokens: Column | str, vocab: Vocabulary) -> Column:
    """Text of a token array; malformed UTF-8 becomes U+FFFD, an unknown id is an error.

    The vocabulary travels as one constant array, so decoding needs neither join nor shuffle. Next to the encoder
    it runs in the same Python call, and the ids stay there.
    """
    table = pa.array(vocab.tokens + [s.encode() for s in vocab.specials], pa.binary())

    def texts_of(rows: pa.ListArray) -> pa.Array:
        ids = rows.flatten()
        if not pc.all(pc.and_(pc.greater_equal(ids, 0), pc.less(ids, len(table))).fill_null(False)).as_py():
            raise ValueError("token id outside the vocabulary")
        spelled = table.take(ids)
        bounds = np.cumsum(np.append(0, pc.list_value_length(rows).fill_null(0).to_numpy(zero_copy_only=False)))
        ends = np.append(0, np.cumsum(pc.binary_length(spelled).to_numpy())).astype(np.int32)[bounds]
        raw = spelled.buffers()[2] or pa.py_buffer(b"")
        whole = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), raw])
        return pc.if_else(rows.is_valid(), whole, None)

    @F.arrow_udf(T.BinaryType())
    def spell(tokens: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array([], pa.binary()), *map(texts_of, _slices(tokens, TOGETHER))])

    return F.make_valid_utf8(spell(col(tokens)).cast("string"))


def round_trip_failures(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """Documents that decoding does not give back."""
    encoded = encode(docs, vocab)
    return encoded.where(~decoded("tokens", vocab).eqNullSafe(F.coalesce("text", F.lit(""))))
