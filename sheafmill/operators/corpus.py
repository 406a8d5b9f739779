"""From posts to a clean, shuffled, split and sharded corpus."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.functions import text as tx
from sheafmill.operators.ordered import with_position


def stripped(posts: DataFrame) -> DataFrame:
    """Posts with both text columns stripped and never NULL."""
    return tx.once(posts, {c: tx.strip(tx.text_or_empty(c)) for c in ("title", "selftext")})


def combine_json(posts: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Add the structured document `text`.

    Escaping and framing only ever lengthen the fields, so posts whose bare fields already pass
    `max_chars` are dropped before any document is built.
    """
    fields = stripped(posts)
    if max_chars is not None:
        fields = fields.where(F.char_length("title") + F.char_length("selftext") <= max_chars)
    return tx.once(fields, {"text": tx.json_document("title", "selftext")})


def combine_plain(posts: DataFrame) -> DataFrame:
    return tx.once(stripped(posts), {"text": tx.plain_document("title", "selftext")})


def within_length(
    docs: DataFrame, min_chars: int = fixed.MIN_CHARS, max_chars: int = fixed.MAX_CHARS
) -> DataFrame:
    return docs.where(F.char_length("text").between(min_chars, max_chars))


def has_content(posts: DataFrame) -> DataFrame:
    """Drop posts whose title and body are both blank."""
    return posts.where(
        (tx.strip(tx.text_or_empty("title")) != "") | (tx.strip(tx.text_or_empty("selftext")) != "")
    )


def admitted(posts: DataFrame, sources: Iterable[str], column: str = "subreddit") -> DataFrame:
    """Posts of the listed sources, compared without regard to case."""
    return posts.where(F.lower(column).isin(*[s.lower() for s in sources]))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row per text; copies are put together inside each map task before the exchange."""
    return docs.select("text").distinct()


def first_posts(posts: DataFrame, order: list[str], exact: bool = True) -> DataFrame:
    """The first post of every (title, body) in the given order, with all its columns.

    `exact=False` compares the concatenated key, under which different posts can collide. Posts are
    grouped by digest with their place in the order, so that no text is in the aggregate or in its
    shuffle; the winners then fetch their row by place. `order` must name each row uniquely.
    """
    filled = posts.withColumns({c: tx.text_or_empty(c) for c in ("title", "selftext")})
    parts = ("title", "selftext") if exact else (tx.joined_key("title", "selftext"),)
    # lengths in front keep ("a", "bc") and ("ab", "c") apart
    spelled = F.concat_ws("|", *[F.char_length(p) for p in parts], *parts)
    keyed = filled.withColumn("_digest", F.sha2(spelled, 256))
    if len(order) == 1:  # one fixed-width value: a hash aggregate
        first = keyed.groupBy("_digest").agg(F.min(order[0]).alias(order[0]))
    else:
        first = keyed.groupBy("_digest").agg(F.min(F.struct(*order)).alias("_at")).select("_digest", "_at.*")
    return keyed.join(first, ["_digest", *order], "left_semi").select(*posts.columns)


def clean(
    posts: DataFrame, min_chars: int = fixed.MIN_CHARS, max_chars: int = fixed.MAX_CHARS
) -> DataFrame:
    """Structured documents of admissible length, each once."""
    return distinct_texts(within_length(combine_json(posts, max_chars), min_chars, max_chars))


def split_and_shard(
    docs: DataFrame,
    seed: int = fixed.SEED,
    val_rows: int = fixed.VAL_ROWS,
    shard_rows: int = fixed.SHARD_ROWS,
    num_shards: int | None = None,
) -> DataFrame:
    """Shuffle distinct texts, hold out the last `val_rows`, number shards of the rest from 1.

    The held-out rows form shard 0 of split 'val'. `num_shards` keeps only the first shards.
    """
    keyed = docs.select("text", tx.shuffle_key("text", seed).alias("shuffle_key"))
    placed = with_position(keyed, "shuffle_key", total="_rows")
    is_val = F.col("pos") >= F.col("_rows") - val_rows
    sharded = placed.select(
        "text",
        "shuffle_key",
        "pos",
        F.when(is_val, "val").otherwise("train").alias("split"),
        F.when(is_val, 0).otherwise(F.floor(F.col("pos") / shard_rows) + 1).cast("int").alias("shard"),
    )
    return sharded if num_shards is None else sharded.where(F.col("shard") <= num_shards)


def split_overlap(sharded: DataFrame) -> DataFrame:
    """Texts found in both splits; a sound corpus gives none."""
    train = sharded.where(F.col("split") == "train").select("text")
    return sharded.where(F.col("split") == "val").select("text").join(train, "text", "left_semi")
