"""Queries that go through the sources and sinks, and through streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafmill.catalog.base import (
    CLEAN_SQL,
    DIGEST_SQL,
    POSTS_SQL,
    RESULTS_SQL,
    digested,
    posts,
    query,
    raw_results,
    table,
)
from sheafmill.catalog.corpus import _PLACED_SQL, SHARD_ROWS, VAL_ROWS
from sheafmill.operators import corpus, experiments
from sheafmill.plans import experiments as plans
from sheafmill.plans.corpus import prepare_corpus
from sheafmill.session import scratch_path, spread
from sheafmill.sources import posts as post_source
from sheafmill.sources import results as result_source
from sheafmill.sources import reports, runlogs, shards, submissions
from sheafmill.streaming import ingest, progress


@query(
    "submissions_scan",
    f"""WITH {POSTS_SQL} SELECT md5(coalesce(CASE WHEN doc_id % 13 = 0 THEN '' ELSE title END, '')) AS title_digest,
    md5(coalesce(selftext, '')) AS body_digest,
    CASE WHEN doc_id % 5 = 0 THEN 'unknown' ELSE subreddit END AS subreddit
    FROM posts WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0
      AND (trim(coalesce(CASE WHEN doc_id % 13 = 0 THEN '' ELSE title END, '')) <> '' OR trim(coalesce(selftext, '')) <> '')""",
)
def submissions_scan(spark: SparkSession, d: str) -> DataFrame:
    """Posts written as JSON lines, some broken, some no objects, some with a number as title."""
    path = scratch_path(spark, "dump")
    fields = F.struct(
        "title", "selftext", F.when(F.col("doc_id") % 5 != 0, F.col("subreddit")).alias("subreddit")
    )
    numbered = F.to_json(F.struct(F.col("doc_id").alias("title"), "selftext", fields["subreddit"].alias("subreddit")))
    good = F.when(F.col("doc_id") % 13 == 0, numbered).otherwise(F.to_json(fields))
    line = (
        F.when(F.col("doc_id") % 7 == 0, F.substring(good, F.lit(1), F.length(good) - 1))
        .when(F.col("doc_id") % 11 == 0, F.concat(F.lit("["), good, F.lit("]")))
        .otherwise(good)
    )
    posts(spark, d).select(line.alias("value")).write.option("compression", "gzip").text(path)
    parsed = submissions.parse_submissions(submissions.read_lines(spark, [path]))
    return parsed.select(
        F.md5(F.col("title").cast("binary")).alias("title_digest"),
        F.md5(F.col("selftext").cast("binary")).alias("body_digest"), "subreddit",
    )


# One file per source: the first source's is cut, the second's is in capitals and unmarked, the last's not on the list.
_DUMPED_SQL = f"""{POSTS_SQL}, names AS (
      SELECT subreddit, row_number() OVER (ORDER BY subreddit) AS k, count(*) OVER () AS n
      FROM (SELECT DISTINCT subreddit FROM posts)),
    dumped AS (SELECT posts.*, k, n FROM posts JOIN names USING (subreddit))"""


def _dumped(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Posts and report of a folder of compressed dumps, one of them cut, one renamed, one not listed."""
    folder = scratch_path(spark, "dumps")
    own = posts(spark, d)
    names = sorted(r[0] for r in own.select("subreddit").distinct().collect())  # one row per dump file
    renamed, unlisted = names[1], names[-1]
    name = F.when(F.col("subreddit") == renamed, F.concat(F.upper("subreddit"), F.lit(".zst"))).otherwise(
        F.concat("subreddit", F.lit("_submissions.zst"))
    )
    value = F.to_json(F.struct("title", "selftext", "subreddit"))
    # every third line ends with CR and LF, every third file line is followed by a broken one
    ended = F.when(F.col("doc_id") % 3 == 0, F.concat(value, F.lit("\r"))).otherwise(value)
    broken = F.when(F.col("doc_id") % 3 == 1, F.concat(ended, F.lit("\n{\"title\": "))).otherwise(ended)
    submissions.write_dumps(own.select(name.alias("file_name"), F.col("doc_id").alias("line_no"), broken.alias("value")), folder)
    files, inner = submissions._filesystem(f"{folder}/{names[0]}_submissions.zst")
    whole = files.get_file_info(inner).size
    with files.open_input_stream(inner, compression=None) as source:
        head = source.read(whole - 8)
    with files.open_output_stream(inner, compression=None) as sink:
        sink.write(head)
    return submissions.ingest(spark, folder, [n for n in names if n != unlisted])


@query(
    "dump_posts",
    f"""WITH {_DUMPED_SQL} SELECT md5(coalesce(title, '')) AS title_digest, md5(coalesce(selftext, '')) AS body_digest,
    subreddit FROM dumped WHERE k BETWEEN 2 AND n - 1
      AND (trim(coalesce(title, '')) <> '' OR trim(coalesce(selftext, '')) <> '')""",
)
def dump_posts(spark: SparkSession, d: str) -> DataFrame:
    found, _ = _dumped(spark, d)
    return found.select(
        F.md5(F.col("title").cast("binary")).alias("title_digest"),
        F.md5(F.col("selftext").cast("binary")).alias("body_digest"), "subreddit",
    )


@query(
    "dump_report",
    f"""WITH {_DUMPED_SQL}, files AS (SELECT subreddit AS source, k, n FROM dumped GROUP BY ALL)
    SELECT source, k < n AS is_listed, CASE WHEN k < n THEN k > 1 END AS is_readable,
      CASE WHEN k = 1 THEN 'EOFError: the last frame is cut off' END AS error FROM files""",
)
def dump_report(spark: SparkSession, d: str) -> DataFrame:
    _, report = _dumped(spark, d)
    return report.select("source", "is_listed", "is_readable", "error")


@query(
    "posts_csv",
    f"""WITH {POSTS_SQL} SELECT md5(coalesce(title, '')) AS title_digest, md5(coalesce(selftext, '')) AS body_digest,
    subreddit FROM posts""",
)
def posts_csv(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "posts")
    post_source.write_posts_csv(posts(spark, d), path)
    return post_source.read_posts_csv(spark, path).select(
        F.md5(F.col("title").cast("binary")).alias("title_digest"),
        F.md5(F.col("selftext").cast("binary")).alias("body_digest"), "subreddit",
    )


def _written_corpus(spark: SparkSession, d: str) -> str:
    path = scratch_path(spark, "corpus")
    prepare_corpus(posts(spark, d), path, val_rows=VAL_ROWS, shard_rows=SHARD_ROWS)
    return path


@query("shard_files", f"WITH {_PLACED_SQL} SELECT split, shard, count(*) AS n FROM sharded GROUP BY ALL")
def shard_files(spark: SparkSession, d: str) -> DataFrame:
    return shards.list_shards(spark, _written_corpus(spark, d))


@query("corpus_reset", f"WITH {_PLACED_SQL} SELECT split, shard, count(*) AS n FROM sharded GROUP BY ALL")
def corpus_reset(spark: SparkSession, d: str) -> DataFrame:
    """A finished corpus is left alone unless a reset is asked for."""
    path = scratch_path(spark, "corpus")
    made = [
        prepare_corpus(posts(spark, d), path, mode, val_rows=val, shard_rows=SHARD_ROWS)
        for mode, val in (("skip", VAL_ROWS + 1), ("skip", VAL_ROWS), ("reset", VAL_ROWS))
    ]
    if made != [True, False, True]:
        raise ValueError(f"written: {made}")
    return shards.list_shards(spark, path)


LOAD_ROWS = 250


@query(
    "load_documents",
    f"WITH {_PLACED_SQL} SELECT pos, {DIGEST_SQL} FROM sharded WHERE split = 'train' AND pos < {LOAD_ROWS}",
)
def load_documents(spark: SparkSession, d: str) -> DataFrame:
    return digested(shards.load_documents(spark, _written_corpus(spark, d), LOAD_ROWS, SHARD_ROWS), "pos")


@query(
    "results_log",
    f"""WITH {RESULTS_SQL} SELECT run_tag, row_number() OVER (PARTITION BY run_tag ORDER BY seq) - 1 AS seq,
    commit, val_bpb, memory_gb, status, description FROM results""",
)
def results_log(spark: SparkSession, d: str) -> DataFrame:
    """Written in two appends of several files each."""
    path = scratch_path(spark, "results")
    log = raw_results(spark, d)
    middle = F.broadcast(log.agg(F.floor(F.avg("seq")).alias("middle")))
    for half in (F.col("seq") <= F.col("middle"), F.col("seq") > F.col("middle")):
        result_source.write_results(log.join(middle, half).drop("middle"), path, files=8)
    return result_source.read_results(spark, path)


PREVIEW = 10


@query(
    "log_preview",
    f"""WITH {RESULTS_SQL}, n AS (
      SELECT run_tag, row_number() OVER (PARTITION BY run_tag ORDER BY seq) - 1 AS seq, status, val_bpb FROM results)
    SELECT * FROM n WHERE seq < {PREVIEW}""",
)
def log_preview(spark: SparkSession, d: str) -> DataFrame:
    """The head of each log, through the written files."""
    path = scratch_path(spark, "results")
    result_source.write_results(raw_results(spark, d), path)
    return plans.preview(result_source.read_results(spark, path), PREVIEW).select("run_tag", "seq", "status", "val_bpb")


@query(
    "report_files",
    f"""WITH {RESULTS_SQL} SELECT form, run_tag, status, count(*) AS n
    FROM results, (SELECT unnest(['json', 'parquet', 'text']) AS form) GROUP BY ALL""",
)
def report_files(spark: SparkSession, d: str) -> DataFrame:
    """One report in every form it can be written in, read back."""
    report = experiments.outcome_counts(experiments.normalised(raw_results(spark, d)))
    path, back = scratch_path(spark, "report"), None
    for form in ("json", "parquet", "text"):
        reports.write_report(report, f"{path}/{form}", form)
        reader = spark.read.schema(report.schema)
        if form == "text":
            reader = reader.option("header", True).option("sep", "\t")
        kind = "csv" if form == "text" else form
        rows = reader.format(kind).load(f"{path}/{form}").select(F.lit(form).alias("form"), "run_tag", "status", "n")
        back = rows if back is None else back.unionByName(rows)
    return back


@query(
    "run_summaries",
    """SELECT concat('order', o_orderkey) AS run_tag, o_orderkey % 10 = 0 AS is_crash,
    CASE WHEN o_orderkey % 10 = 0 THEN 0e0 ELSE round(1 + o_custkey / 100000e0, 6) END AS val_bpb,
    CASE WHEN o_orderkey % 10 = 0 THEN 0e0 ELSE round(round(o_totalprice, 1) / 1024, 1) END AS memory_gb,
    o_custkey AS num_steps, CASE WHEN o_orderkey % 3 <> 0 THEN 39.8e0 END AS mfu_percent FROM orders""",
)
def run_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Orders as the printed summaries of training runs; a tenth of them crashed."""
    texts = F.array_compact(
        F.array(
            F.lit("---"),
            F.when(
                F.col("o_orderkey") % 10 != 0,
                F.format_string("val_bpb:          %.6f", 1 + F.col("o_custkey") / 100000),
            ),
            F.format_string("peak_vram_mb:     %.1f", F.col("o_totalprice")),
            F.when(F.col("o_orderkey") % 3 != 0, F.lit("mfu_percent:      39.80")).otherwise(
                F.lit("mfu_percent:      n/a")
            ),
            F.format_string("num_steps:        %d", F.col("o_custkey")),
        )
    )
    lines = table(spark, d, "orders").select(
        F.expr("concat('order', o_orderkey)").alias("run_tag"), F.posexplode(texts).alias("line", "value")
    )
    rows = experiments.log_rows(runlogs.parse_summaries(lines))
    return rows.select("run_tag", "is_crash", "val_bpb", "memory_gb", "num_steps", "mfu_percent")


@query(
    "step_telemetry",
    """SELECT concat('run', l_suppkey % 3) AS run_tag, l_orderkey AS step, round(l_discount * 100, 1) AS pct_done,
    round(l_extendedprice / 1000, 6) AS loss, (l_quantity * 10)::INT AS dt_ms, l_partkey * 1000 AS tok_per_sec,
    CASE WHEN l_linenumber <> 1 THEN l_quantity END AS mfu, l_linenumber AS epoch FROM lineitem""",
)
def step_telemetry(spark: SparkSession, d: str) -> DataFrame:
    """Line items as the progress lines a training run prints."""
    mfu = F.when(F.col("l_linenumber") != 1, F.format_string("%.1f%%", F.col("l_quantity"))).otherwise(F.lit("n/a"))
    line = F.format_string(
        "step %05d (%.1f%%) | loss: %.6f | lrm: 1.00 | dt: %dms | tok/sec: %,d | mfu: %s | epoch: %d | remaining: 9s    ",
        "l_orderkey", F.col("l_discount") * 100, F.round(F.col("l_extendedprice") / 1000, 6),
        (F.col("l_quantity") * 10).cast("int"), F.col("l_partkey") * 1000, mfu, "l_linenumber",
    )
    items = spread(table(spark, d, "lineitem"), "l_orderkey")
    lines = items.select(F.expr("concat('run', l_suppkey % 3)").alias("run_tag"), line.alias("value"))
    return runlogs.parse_steps(lines).select(
        "run_tag", "step", "pct_done", "loss", "dt_ms", "tok_per_sec", "mfu", "epoch"
    )


def _stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    schema = table(spark, d, name).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/{name}.parque[t]")


@query("incremental_ingest", f"WITH {CLEAN_SQL} SELECT {DIGEST_SQL} FROM clean")
def incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Two streams of posts, each with its own checkpoint, that overlap in part and together are all."""
    sink = scratch_path(spark, "sink")
    for left_out in (0, 1):
        arriving = posts(spark, d, _stream(spark, d, "documents")).where(F.col("doc_id") % 3 != left_out)
        writer = ingest.ingest_stream(arriving, sink, scratch_path(spark, "offsets"))
        writer.trigger(availableNow=True).start().awaitTermination()
    return digested(ingest.read_sink(spark, sink))


@query(
    "live_progress",
    f"""WITH {RESULTS_SQL} SELECT run_tag, count(*) AS n_experiments, count(*) FILTER (WHERE status = 'KEEP') AS n_keep,
    count(*) FILTER (WHERE status = 'DISCARD') AS n_discard, count(*) FILTER (WHERE status = 'CRASH') AS n_crash,
    min(val_bpb) FILTER (WHERE status = 'KEEP') AS best_bpb FROM results GROUP BY run_tag""",
)
def live_progress(spark: SparkSession, d: str) -> DataFrame:
    log = experiments.normalised(raw_results(spark, d, _stream(spark, d, "events")))
    target = scratch_path(spark, "live")
    writer = progress.progress_stream(progress.live_progress(log), target, scratch_path(spark, "offsets"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return progress.read_progress(spark, target)
