"""Whole jobs: from dumps to shards, from shards to a tokenizer, and reports on both."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.functions import text as tx
from sheafmill.operators import corpus, profile, sequence
from sheafmill.operators import tokenizer as tk
from sheafmill.operators.ordered import with_position
from sheafmill.session import materialise
from sheafmill.sources import posts as post_source
from sheafmill.sources import shards, submissions, vocab


def extract_posts(
    spark: SparkSession, dumps: str, csv_path: str, sources: Iterable[str] = fixed.SOURCES, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Merge dump files into one post table as CSV; returns the file report and the breakdown."""
    found, report = submissions.ingest(spark, dumps, sources)
    firsts = corpus.first_posts(found, ["src_file", "src_block", "src_line"], exact)
    kept = materialise(firsts.select("title", "selftext", "subreddit"), "posts")
    shuffled = kept.orderBy(tx.shuffle_key(tx.joined_key("title", "selftext")), "title", "selftext")
    post_source.write_posts_csv(shuffled, csv_path, mode="overwrite")
    return report, profile.breakdown(kept, "subreddit")


def prepare_corpus(
    posts: DataFrame, path: str, mode: str = "skip", seed: int = fixed.SEED,
    min_chars: int = fixed.MIN_CHARS, max_chars: int = fixed.MAX_CHARS,
    val_rows: int = fixed.VAL_ROWS, shard_rows: int = fixed.SHARD_ROWS, num_shards: int | None = None,
) -> bool:
    """Clean posts, shuffle and split them, and write shards; returns whether it had to."""
    spark = posts.sparkSession
    if mode == "skip" and shards.is_complete(spark, path):
        return False
    # Written once: the slice counts and the placement both read the cleaned texts.
    cleaned = materialise(corpus.clean(posts, min_chars, max_chars), "clean")
    sharded = corpus.split_and_shard(cleaned, seed, val_rows, shard_rows, num_shards)
    return shards.write_shards(sharded, path, mode)


def prepare_tokenizer(
    spark: SparkSession, corpus_path: str, vocab_path: str, mode: str = "skip",
    vocab_size: int = fixed.VOCAB_SIZE, max_chars: int | None = None,
) -> tk.Vocabulary:
    """Train on the training shards, save, check that texts survive; an existing one is reused."""
    if mode == "skip" and vocab.has_vocab(spark, vocab_path):
        return vocab.read_vocab(spark, vocab_path)
    texts = tk.training_corpus(shards.read_shards(spark, corpus_path), max_chars)
    trained = tk.train_bpe(texts, vocab_size)
    failures = tk.round_trip_failures(shards.read_shards(spark, corpus_path, "val"), trained)
    if not failures.isEmpty():
        raise ValueError("the vocabulary does not give back every held-out document")
    vocab.write_vocab(spark, trained, vocab_path, mode="reset")
    return trained


def training_table(
    shard_rows: DataFrame, vocabulary: tk.Vocabulary, batch: int, length: int = fixed.SEQ_LEN
) -> DataFrame:
    """Rows a trainer reads: inputs and targets of each document, batch by batch."""
    encoded = tk.encode(shard_rows, vocabulary, prepend_bos=True)
    rows = sequence.training_rows(encoded, vocabulary.bos_id, length)
    return sequence.assign_batches(rows, batch).select("pos", "batch_no", "row_in_batch", "inputs", "targets")


def length_report(
    docs: DataFrame, vocabulary: tk.Vocabulary, max_len: int = fixed.PACK_LEN, seed: int = fixed.SEED
) -> dict[str, DataFrame]:
    """Length profiles in characters and tokens, context fit, packing and what follows from them."""
    sized = materialise(
        tk.encode(docs, vocabulary).select(
            F.char_length("text").alias("chars"), F.size("tokens").alias("n"),
            tx.shuffle_key("text", seed).alias("k"),
        ),
        "lengths",
    )
    packed = materialise(sequence.packed_rows(with_position(sized, "k"), max_len), "packed")
    tokens = profile.length_profile(sized, F.col("n"))
    return {
        "characters": profile.length_profile(sized, F.col("chars")),
        "tokens": tokens,
        "context_fit": profile.context_fit(sized, F.col("n"), (*fixed.CONTEXT_LENGTHS[:-1], max_len)),
        "packing": sequence.packing_profile(packed),
        "packing_distribution": sequence.packing_distribution(packed),
        "implications": profile.implications(tokens),
    }
