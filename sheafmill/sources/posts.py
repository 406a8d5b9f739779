"""The post table as CSV with a header; quotes are doubled, fields may span lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill import fixed

POST_SCHEMA = "title string, selftext string, subreddit string"


def write_posts_csv(posts: DataFrame, path: str, mode: str = "errorifexists") -> None:
    (
        posts.select("title", "selftext", "subreddit")
        .write.mode(mode).option("header", True).option("escape", '"').option("quoteAll", True)
        .option("emptyValue", "").option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_posts_csv(spark: SparkSession, path: str, na_tokens: str = "none") -> DataFrame:
    """Read posts; missing text is ''.

    `na_tokens="pandas"` also blanks posts that consist of a word such as NA or null, as a
    data-frame reader with default settings does; `none` keeps them.
    """
    if na_tokens not in ("none", "pandas"):
        raise ValueError("na_tokens must be 'none' or 'pandas'")
    posts = (
        spark.read.schema(POST_SCHEMA).option("header", True).option("multiLine", True)
        .option("escape", '"').option("emptyValue", "").option("nullValue", "\0")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    if na_tokens == "pandas":
        for c in ("title", "selftext"):
            posts = posts.withColumn(c, F.when(~F.col(c).isin(*fixed.NA_TOKENS), F.col(c)))
    return posts.withColumns({c: F.coalesce(c, F.lit("")) for c in ("title", "selftext")})
