"""Registry of named queries, and the two views most of them start from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.session import spread

Query = Callable[[SparkSession, str], DataFrame]

#: Rows of a chunk in the registered queries: few, so that also small tables cross many chunk borders.
CHUNK_ROWS = 1_000

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `sql` is the same result in the reference dialect, where there is one."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def posts(spark: SparkSession, sf_dir: str, source: DataFrame | None = None) -> DataFrame:
    """`documents` as posts: first line is the title, the rest the body; some bodies removed."""
    source = documents(spark, sf_dir) if source is None else source
    return source.selectExpr(
        "doc_id",
        "source AS subreddit",
        r"split_part(text, '\n', 1) AS title",
        r"""CASE WHEN doc_id % 17 = 0 THEN '[removed]' WHEN doc_id % 19 = 0 THEN '[deleted]'
            WHEN instr(text, '\n') = 0 THEN NULL
            ELSE substring(text, instr(text, '\n') + 1) END AS selftext""",
    )


def raw_results(spark: SparkSession, sf_dir: str, events: DataFrame | None = None) -> DataFrame:
    """`events` as the experiment logs of four runs, statuses still as written."""
    events = table(spark, sf_dir, "events") if events is None else events
    return events.selectExpr(
        "event_id AS seq",
        "concat('run', user_id % 4) AS run_tag",
        "substring(md5(CAST(event_id AS STRING)), 1, 7) AS commit",
        """CASE WHEN event_type = 'error' THEN 0e0
           ELSE round(1.2e0 + value / 1000e0 - event_id / 100000e0, 6) END AS val_bpb""",
        "round(10e0 + (event_id % 70) / 10e0, 1) AS memory_gb",
        """CASE event_type WHEN 'error' THEN 'crash' WHEN 'purchase' THEN ' keep '
           WHEN 'signup' THEN 'keep-sa' ELSE 'discard' END AS status""",
        "concat('try ', event_type, ' ', event_id) AS description",
    )


POSTS_SQL = """posts AS (
  SELECT doc_id, source AS subreddit, split_part(text, chr(10), 1) AS title,
         CASE WHEN doc_id % 17 = 0 THEN '[removed]' WHEN doc_id % 19 = 0 THEN '[deleted]'
              WHEN position(chr(10) in text) = 0 THEN NULL
              ELSE substring(text, position(chr(10) in text) + 1) END AS selftext
  FROM documents)"""

_EDGE = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def strip_sql(expression: str) -> str:
    return f"regexp_replace({expression}, '^{_EDGE}|{_EDGE}$', '', 'g')"


FIELDS_SQL = f"""{POSTS_SQL},
fields AS (
  SELECT doc_id, subreddit, {strip_sql("coalesce(title, '')")} AS title,
         {strip_sql("coalesce(selftext, '')")} AS body
  FROM posts)"""

JSON_SQL = f"""{FIELDS_SQL},
docs AS (
  SELECT doc_id, subreddit,
         CASE WHEN body IN ('[removed]', '[deleted]', '')
              THEN CASE WHEN title = '' THEN '' ELSE '{{"confession": ' || to_json(title)::VARCHAR || '}}' END
              WHEN title = '' THEN '{{"confession": ' || to_json(body)::VARCHAR || '}}'
              ELSE '{{"title": ' || to_json(title)::VARCHAR || ', "confession": ' || to_json(body)::VARCHAR || '}}'
         END AS text
  FROM fields)"""

CLEAN_SQL = f"""{JSON_SQL},
clean AS (SELECT DISTINCT text FROM docs WHERE length(text) BETWEEN 40 AND 2000)"""

RESULTS_SQL = """results AS (
  SELECT event_id AS seq, concat('run', user_id % 4) AS run_tag,
         substring(md5(CAST(event_id AS VARCHAR(20))), 1, 7) AS commit,
         CASE WHEN event_type = 'error' THEN 0e0
              ELSE round(1.2e0 + value / 1000e0 - event_id / 100000e0, 6) END AS val_bpb,
         round(10e0 + (event_id % 70) / 10e0, 1) AS memory_gb,
         CASE event_type WHEN 'error' THEN 'CRASH' WHEN 'purchase' THEN 'KEEP'
              WHEN 'signup' THEN 'KEEP-SA' ELSE 'DISCARD' END AS status,
         concat('try ', event_type, ' ', event_id) AS description
  FROM events)"""


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


def digested(df: DataFrame, *keep: str) -> DataFrame:
    """Long texts as digest and length, to keep results small."""
    return df.select(
        *keep, F.md5(F.col("text").cast("binary")).alias("digest"),
        F.char_length("text").cast("long").alias("n_chars"),
    )


DIGEST_SQL = "md5(text) AS digest, length(text)::BIGINT AS n_chars"
