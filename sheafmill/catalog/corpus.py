"""Queries about posts, documents, splits, profiles and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.catalog.base import (
    CHUNK_ROWS,
    CLEAN_SQL,
    DIGEST_SQL,
    FIELDS_SQL,
    JSON_SQL,
    POSTS_SQL,
    digested,
    posts,
    query,
    rounded,
    table,
)
from sheafmill.functions import text as tx
from sheafmill.operators import corpus, profile
from sheafmill.operators.ordered import budget_prefix, with_position

ALLOWED = ("SRC1", "src4", "Src7", "src12", "elsewhere")
VAL_ROWS = 100
SHARD_ROWS = 100


@query("combine_json", f"WITH {JSON_SQL} SELECT doc_id, {DIGEST_SQL} FROM docs")
def combine_json(spark: SparkSession, d: str) -> DataFrame:
    return digested(corpus.combine_json(posts(spark, d)), "doc_id")


@query(
    "combine_plain",
    f"""WITH {FIELDS_SQL},
    docs AS (SELECT doc_id, CASE WHEN body IN ('[removed]', '[deleted]') THEN title
                                 WHEN title = '' THEN body WHEN body = '' THEN title
                                 ELSE title || chr(10) || body END AS text FROM fields)
    SELECT doc_id, {DIGEST_SQL} FROM docs""",
)
def combine_plain(spark: SparkSession, d: str) -> DataFrame:
    return digested(corpus.combine_plain(posts(spark, d)), "doc_id")


@query("clean_corpus", f"WITH {CLEAN_SQL} SELECT {DIGEST_SQL} FROM clean")
def clean_corpus(spark: SparkSession, d: str) -> DataFrame:
    return digested(corpus.clean(posts(spark, d)))


_PROFILE_SQL = """count(*) AS n, min(len)::BIGINT AS min_len, round(avg(len), 4) AS mean_len,
    round(quantile_cont(len, 0.5), 4) AS median, round(quantile_cont(len, 0.75), 4) AS p75,
    round(quantile_cont(len, 0.9), 4) AS p90, round(quantile_cont(len, 0.95), 4) AS p95,
    round(quantile_cont(len, 0.99), 4) AS p99, max(len)::BIGINT AS max_len"""
_PROFILE_FLOATS = ("mean_len", "median", "p75", "p90", "p95", "p99")


@query(
    "corpus_profile_by_source",
    f"""WITH {JSON_SQL},
    sized AS (SELECT *, length(text)::DOUBLE AS len FROM docs WHERE length(text) BETWEEN 40 AND 2000),
    firsts AS (SELECT * FROM sized QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1)
    SELECT subreddit, {_PROFILE_SQL} FROM firsts GROUP BY subreddit""",
)
def corpus_profile_by_source(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: clean, first-wins de-duplicated documents, profiled per source.

    Only lengths are wanted in the end, so texts are compared by digest and never shuffled.
    """
    docs = corpus.within_length(corpus.combine_json(posts(spark, d), 2000))
    digests = docs.select(
        F.sha2("text", 256).alias("digest"), F.char_length("text").alias("len"), "doc_id", "subreddit"
    )
    places = digests.groupBy("digest", "len").agg(F.min("doc_id").alias("doc_id"))
    firsts = digests.join(places.select("digest", "doc_id"), ["digest", "doc_id"], "left_semi")
    by_source = profile.length_profile(firsts, F.col("len"), ["subreddit"])
    return rounded(by_source, *_PROFILE_FLOATS, places=4)


@query("dedup_exact", f"WITH {JSON_SQL}, u AS (SELECT DISTINCT text FROM docs) SELECT {DIGEST_SQL} FROM u")
def dedup_exact(spark: SparkSession, d: str) -> DataFrame:
    return digested(corpus.distinct_texts(corpus.combine_json(posts(spark, d))))


_FIRST_SQL = """ SELECT doc_id, subreddit, md5(title || chr(10) || body) AS digest FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY doc_id) AS rn FROM filled) WHERE rn = 1"""
_FILLED_SQL = f"""WITH {POSTS_SQL}, filled AS (
    SELECT doc_id, subreddit, coalesce(title, '') AS title, coalesce(selftext, '') AS body FROM posts)"""


def _first_posts(spark: SparkSession, d: str, exact: bool) -> DataFrame:
    firsts = corpus.first_posts(posts(spark, d), ["doc_id"], exact=exact)
    whole = F.concat(tx.text_or_empty("title"), F.lit("\n"), tx.text_or_empty("selftext"))
    return firsts.select("doc_id", "subreddit", F.md5(whole.cast("binary")).alias("digest"))


@query("dedup_first_wins", _FILLED_SQL + _FIRST_SQL.format(key="title, body"))
def dedup_first_wins(spark: SparkSession, d: str) -> DataFrame:
    return _first_posts(spark, d, exact=True)


@query("dedup_concat_key", _FILLED_SQL + _FIRST_SQL.format(key="title || '|||' || body"))
def dedup_concat_key(spark: SparkSession, d: str) -> DataFrame:
    return _first_posts(spark, d, exact=False)


@query(
    "blank_posts",
    f"WITH {FIELDS_SQL} SELECT subreddit, count(*) AS n FROM fields WHERE title <> '' OR body <> '' GROUP BY 1",
)
def blank_posts(spark: SparkSession, d: str) -> DataFrame:
    return corpus.has_content(posts(spark, d)).groupBy("subreddit").agg(F.count(F.lit(1)).alias("n"))


@query(
    "source_allowlist",
    f"""WITH {POSTS_SQL} SELECT doc_id, subreddit FROM posts
    WHERE lower(subreddit) IN ({', '.join(repr(s.lower()) for s in ALLOWED)})""",
)
def source_allowlist(spark: SparkSession, d: str) -> DataFrame:
    return corpus.admitted(posts(spark, d), ALLOWED).select("doc_id", "subreddit")


@query(
    "source_breakdown",
    f"""WITH {POSTS_SQL}, c AS (SELECT subreddit, count(*) AS n FROM posts GROUP BY 1)
    SELECT subreddit, n, round(n / sum(n) OVER (), 6) AS share,
           printf('%.1f%%', 100.0 * n / sum(n) OVER ()) AS pct,
           repeat('█', floor(50.0 * n / sum(n) OVER ())::INT) AS bar FROM c""",
)
def source_breakdown(spark: SparkSession, d: str) -> DataFrame:
    counted = profile.breakdown(posts(spark, d), "subreddit")
    share = F.col("share")
    return counted.withColumns({"pct": tx.percent_text(share), "bar": tx.bar_text(share)}).withColumn(
        "share", F.round("share", 6)
    )


_PLACED_SQL = f"""{CLEAN_SQL},
placed AS (SELECT text, md5('42:' || text) AS shuffle_key,
                  row_number() OVER (ORDER BY md5('42:' || text)) - 1 AS pos, count(*) OVER () AS total FROM clean),
sharded AS (SELECT *, CASE WHEN pos >= total - {VAL_ROWS} THEN 'val' ELSE 'train' END AS split,
                   CASE WHEN pos >= total - {VAL_ROWS} THEN 0 ELSE (pos // {SHARD_ROWS} + 1)::INT END AS shard
            FROM placed)"""


def _sharded(spark: SparkSession, d: str) -> DataFrame:
    return corpus.split_and_shard(
        corpus.clean(posts(spark, d)), val_rows=VAL_ROWS, shard_rows=SHARD_ROWS
    )


@query("shuffle_order", f"WITH {_PLACED_SQL} SELECT pos, shuffle_key, md5(text) AS digest FROM placed")
def shuffle_order(spark: SparkSession, d: str) -> DataFrame:
    return _sharded(spark, d).select(
        "pos", "shuffle_key", F.md5(F.col("text").cast("binary")).alias("digest")
    )


@query("split_counts", f"WITH {_PLACED_SQL} SELECT split, count(*) AS n FROM sharded GROUP BY split")
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return _sharded(spark, d).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "shard_assign",
    f"WITH {_PLACED_SQL} SELECT md5(text) AS digest, pos, split, shard FROM sharded",
)
def shard_assign(spark: SparkSession, d: str) -> DataFrame:
    return _sharded(spark, d).select(
        F.md5(F.col("text").cast("binary")).alias("digest"), "pos", "split", "shard"
    )


@query("val_split", f"WITH {_PLACED_SQL} SELECT pos, {DIGEST_SQL} FROM sharded WHERE split = 'val'")
def val_split(spark: SparkSession, d: str) -> DataFrame:
    return digested(_sharded(spark, d).where(F.col("split") == "val"), "pos")


@query(
    "split_overlap",
    f"""WITH {_PLACED_SQL} SELECT count(*) AS n_shared FROM sharded v
    WHERE split = 'val' AND text IN (SELECT text FROM sharded WHERE split = 'train')""",
)
def split_overlap(spark: SparkSession, d: str) -> DataFrame:
    return corpus.split_overlap(_sharded(spark, d)).agg(F.count(F.lit(1)).alias("n_shared"))


@query(
    "sample_n",
    "SELECT doc_id, md5(text) AS digest FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 25",
)
def sample_n(spark: SparkSession, d: str) -> DataFrame:
    sampled = profile.sample_rows(table(spark, d, "documents"), "doc_id", 25)
    return sampled.select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(
    "sample_per_group",
    """SELECT doc_id, source, sample_no FROM (
         SELECT doc_id, source, row_number() OVER (
           PARTITION BY source ORDER BY md5('42:' || doc_id), doc_id) AS sample_no FROM documents)
       WHERE sample_no <= 5""",
)
def sample_per_group(spark: SparkSession, d: str) -> DataFrame:
    sampled = profile.sample_per_group(table(spark, d, "documents"), "source", "doc_id", 5)
    return sampled.select("doc_id", "source", "sample_no")


_PLAIN_SQL = f"""{FIELDS_SQL},
    docs AS (SELECT doc_id, subreddit, CASE WHEN body IN ('[removed]', '[deleted]') THEN title
                                 WHEN title = '' THEN body WHEN body = '' THEN title
                                 ELSE title || chr(10) || body END AS text FROM fields)"""


@query(
    "sample_display",
    f"""WITH {_PLAIN_SQL}
    SELECT doc_id, length(text)::BIGINT AS n_chars,
           CASE WHEN length(text) > 800 THEN left(text, 800) || '...[truncated]' ELSE text END AS shown
    FROM docs WHERE subreddit = 'src7' ORDER BY md5('42:' || doc_id), doc_id LIMIT 10""",
)
def sample_display(spark: SparkSession, d: str) -> DataFrame:
    one_source = corpus.combine_plain(posts(spark, d).where(F.col("subreddit") == "src7"))
    return profile.sample_rows(one_source, "doc_id", 10).select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), tx.sample_text("text").alias("shown")
    )


SHORT = 300


@query(
    "short_posts",
    f"""WITH {_PLAIN_SQL} SELECT subreddit, count(*) AS n,
    count(*) FILTER (WHERE length(text) < {SHORT}) AS n_short,
    round(avg((length(text) < {SHORT})::INT), 6) AS short_share FROM docs GROUP BY subreddit""",
)
def short_posts(spark: SparkSession, d: str) -> DataFrame:
    docs = corpus.combine_plain(posts(spark, d))
    return rounded(profile.short_share(docs, ["subreddit"], SHORT), "short_share")


@query(
    "short_samples",
    f"""WITH {_PLAIN_SQL} SELECT doc_id, subreddit, sample_no, to_json(text)::VARCHAR AS shown FROM (
      SELECT *, row_number() OVER (PARTITION BY subreddit ORDER BY md5('42:' || doc_id), doc_id) AS sample_no
      FROM docs WHERE length(text) < {SHORT}) WHERE sample_no <= 5""",
)
def short_samples(spark: SparkSession, d: str) -> DataFrame:
    short = profile.short_documents(corpus.combine_plain(posts(spark, d)), SHORT)
    return profile.sample_per_group(short, "subreddit", "doc_id", 5).select(
        "doc_id", "subreddit", "sample_no", tx.json_string("text").alias("shown")
    )


@query("source_list", "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL")
def source_list(spark: SparkSession, d: str) -> DataFrame:
    return profile.groups(table(spark, d, "documents"), "source")


@query(
    "length_profile_chars",
    f"WITH {CLEAN_SQL}, s AS (SELECT length(text)::DOUBLE AS len FROM clean) SELECT {_PROFILE_SQL} FROM s",
)
def length_profile_chars(spark: SparkSession, d: str) -> DataFrame:
    whole = profile.length_profile(corpus.clean(posts(spark, d)), F.char_length("text"))
    return rounded(whole, *_PROFILE_FLOATS, places=4)


@query(
    "context_fit_chars",
    f"""WITH {CLEAN_SQL} SELECT context, round(avg((length(text) <= context)::INT), 6) AS share
    FROM clean, (SELECT unnest([64, 128, 256, 512, 1024, 2048])::INT AS context) GROUP BY context""",
)
def context_fit_chars(spark: SparkSession, d: str) -> DataFrame:
    return rounded(profile.context_fit(corpus.clean(posts(spark, d)), F.char_length("text")), "share")


@query(
    "truncate_display",
    """SELECT doc_id, length(shown)::BIGINT AS n_shown, md5(shown) AS digest FROM (
      SELECT doc_id, CASE WHEN length(text) > 800 THEN left(text, 800) || '...[truncated]' ELSE text END AS shown
      FROM documents)""",
)
def truncate_display(spark: SparkSession, d: str) -> DataFrame:
    shown = tx.sample_text("text")
    return table(spark, d, "documents").select(
        "doc_id", F.char_length(shown).cast("long").alias("n_shown"),
        F.md5(shown.cast("binary")).alias("digest"),
    )


CAP = 3000
BUDGET_SHARE = 3  # a third of all characters


@query(
    "char_budget",
    f"""WITH capped AS (SELECT doc_id, md5('42:' || doc_id) AS k, left(text, {CAP}) AS text FROM documents),
    used AS (SELECT *, sum(length(text)) OVER (ORDER BY k) - length(text) AS before FROM capped)
    SELECT doc_id, {DIGEST_SQL} FROM used
    WHERE before < (SELECT sum(n_chars) // {BUDGET_SHARE} FROM documents)""",
)
def char_budget(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    budget = docs.agg(F.sum("n_chars")).first()[0] // BUDGET_SHARE
    capped = docs.select(
        "doc_id", F.left("text", F.lit(CAP)).alias("text"),
        tx.shuffle_key(F.col("doc_id").cast("string")).alias("k"),
    )
    placed = with_position(capped, "k")
    return digested(budget_prefix(placed, "pos", F.char_length("text"), budget, CHUNK_ROWS // 10), "doc_id")


@query(
    "document_batches",
    f"""WITH {_PLACED_SQL} SELECT split, epoch, batch_no, count(*) AS n FROM (
      SELECT split, (shard - 1) * {-(-SHARD_ROWS // 128)} + (pos - (shard - 1) * {SHARD_ROWS}) // 128 AS batch_no
      FROM sharded WHERE split = 'train'),
      (SELECT unnest([1, 2, 3])::INT AS epoch) GROUP BY ALL""",
)
def document_batches(spark: SparkSession, d: str) -> DataFrame:
    from sheafmill.operators.sequence import document_batches as batches

    batched = batches(_sharded(spark, d).where(F.col("split") == "train"), epochs=3, shard_rows=SHARD_ROWS)
    return batched.groupBy("split", "epoch", "batch_no").agg(F.count(F.lit(1)).alias("n"))
