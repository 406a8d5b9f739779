"""New dump files as they arrive: cleaned documents, each text once over the life of the sink."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sheafmill import fixed
from sheafmill.operators import corpus
from sheafmill.session import path_exists
from sheafmill.sources import versions
from sheafmill.sources.submissions import parse_submissions

SINK_SCHEMA = "text string, text_hash string, stream string, batch long"
ROW_SCHEMA = "text string, text_hash string, bucket string"
#: Leading hex digits of a text's hash that name its bucket. A batch makes a file for each bucket it has texts in, so
#: more digits spare small batches reading, and cost files.
BUCKET_DIGITS = 1


def stream_submissions(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Posts of dump files that appear in a folder."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return parse_submissions(lines)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives in the checkpoint: a restart keeps it, a fresh checkpoint has a new one."""
    path = f"{checkpoint}/stream-id"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        made = spark.createDataFrame([(uuid.uuid4().hex,)], "value string")
        made.coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first()["value"]


def bucketed(texts: DataFrame) -> DataFrame:
    """Each text once, with its hash and the bucket that hash falls into; rows without a text are left out."""
    hashed = texts.select("text").where(F.col("text").isNotNull()).distinct().withColumn("text_hash", F.sha2("text", 256))
    return hashed.withColumn("bucket", F.substring("text_hash", 1, BUCKET_DIGITS))


def commits(spark: SparkSession, sink: str, since: int = -1) -> list[tuple[int, str, int, str]]:
    """Committed batches after number `since`: number, stream, batch, folder. One small file is read for each."""
    found = [n for n in versions.numbers(spark, f"{sink}/_commits") if n > since]
    if not found:
        return []
    lines = spark.read.text([f"{sink}/_commits/{n}" for n in found]).select(F.split("value", " ").alias("v"))
    parts = lines.select(*[F.col("v")[i].alias(c) for i, c in enumerate(("number", "stream", "batch", "folder"))])
    return sorted((int(r.number), r.stream, int(r.batch), r.folder) for r in parts.collect())


def known_hashes(spark: SparkSession, sink: str, folders: list[str], buckets: list[str]) -> DataFrame:
    """Hashes that committed folders hold in some buckets; the other buckets' files are not opened."""
    rows = spark.read.schema(ROW_SCHEMA).option("basePath", sink).parquet(*[f"{sink}/{f}" for f in folders])
    return rows.where(F.col("bucket").isin(buckets)).select("text_hash")


def append_new_documents(sink: str, stream: str) -> Callable[[DataFrame, int], None]:
    """A batch writer that adds the texts the sink does not hold yet.

    No event time bounds how late a copy may come, so a stateful de-duplication would keep every
    hash for ever in executor memory. The sink itself is the memory instead: of what it holds, only the hashes
    in the buckets of this batch are read.

    A batch is written to a folder of its own and counts once it has taken the next commit number. A writer that loses
    that number to another leaves out what the other has added and tries the next one, so each text stays in
    the sink once however many streams write. A batch repeated after its commit adds nothing; a folder without a
    commit is never read.
    """
    seen: list[tuple[int, str, int, str]] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        attempt, tries = uuid.uuid4().hex, 0
        work = f"{sink}/_work/{attempt}"
        bucketed(batch).write.parquet(work)
        rows = spark.read.schema(ROW_SCHEMA).parquet(work)
        buckets = sorted(r.bucket for r in rows.select("bucket").distinct().collect())  # 16 ** BUCKET_DIGITS at most
        before, folders = rows, []
        while True:
            new = commits(spark, sink, seen[-1][0] if seen else -1)
            seen.extend(new)
            if any((s, b) == (stream, batch_id) for _, s, b, _ in seen):
                break
            others = [folder for _, _, _, folder in (new if folders else seen)]
            if others or not folders:
                if others and buckets:
                    before = before.join(known_hashes(spark, sink, others, buckets), "text_hash", "left_anti")
                folders.append(f"attempt={attempt}-{tries}")
                tries += 1
                path = f"{sink}/{folders[-1]}"
                before.repartition("bucket").write.partitionBy("bucket").parquet(path)
                before = spark.read.schema(ROW_SCHEMA).option("basePath", path).parquet(path)
            number = seen[-1][0] + 1 if seen else 0
            if versions.create_once(spark, f"{sink}/_commits/{number}", f"{number} {stream} {batch_id} {folders[-1]}\n"):
                folders.pop()
                break
        for gone in [work, *(f"{sink}/{f}" for f in folders)]:
            versions.delete(spark, gone)

    return write


def ingest_stream(
    posts: DataFrame, sink: str, checkpoint: str,
    min_chars: int = fixed.MIN_CHARS, max_chars: int = fixed.MAX_CHARS,
) -> DataStreamWriter:
    """Clean a stream of posts into the sink; call `start` on the result."""
    docs = corpus.within_length(corpus.combine_json(posts, max_chars), min_chars, max_chars)
    return (
        docs.select("text").writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(append_new_documents(sink, stream_id(posts.sparkSession, checkpoint)))
    )


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """What committed batches have added."""
    done = commits(spark, sink)
    origins = spark.createDataFrame([(f, s, b) for _, s, b, f in done], "folder string, stream string, batch long")
    if not done:
        return spark.createDataFrame([], SINK_SCHEMA)
    rows = spark.read.schema(f"attempt string, {ROW_SCHEMA}").option("basePath", sink).parquet(
        *[f"{sink}/{folder}" for *_, folder in done]
    )
    folder = F.concat(F.lit("attempt="), "attempt")
    return (
        rows.withColumn("folder", folder).join(F.broadcast(origins), "folder")  # one row per batch
        .select("text", "text_hash", "stream", "batch")
    )
