"""Compressed line-delimited JSON dumps of forum submissions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheafmill import fixed
from sheafmill.functions import text as tx
from sheafmill.session import materialise

_POSTS = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "selftext", "subreddit")]))
# What from_json makes of values that are no strings: numbers, booleans, arrays, objects, bare NaN.
_OTHER_VALUE = r'^(-?[0-9]|true$|false$|\[|\{|"([+-]?(INF|Infinity)|NaN)"$)'
# Largest window the streaming decoder opens.
MAX_WINDOW = 31
_BLOCK = 1 << 20

_STAGED = "src_file string, src_line long, value string, window_log int, n_bytes long, is_whole boolean, error string"


def source_name(file_name: Column) -> Column:
    """`TIFU_submissions.zst` and `tifu.zst` both belong to `tifu`."""
    base = F.element_at(F.split(file_name, "/"), -1)
    return F.lower(F.regexp_replace(base, r"(_submissions)?\.zst$", ""))


def discover(spark: SparkSession, folder: str, sources: Iterable[str] = fixed.SOURCES) -> DataFrame:
    """All dump files of a folder, with their source and whether it is on the list."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").load(folder)
        .select(F.col("path").alias("src_file"), F.col("length").alias("file_bytes"))
    )
    wanted = [s.lower() for s in sources]
    return files.withColumn("source", source_name(F.col("src_file"))).withColumn(
        "is_listed", F.col("source").isin(*wanted)
    )


def parse_submissions(lines: DataFrame, line: str = "value") -> DataFrame:
    """Posts from JSON lines: broken lines and posts without any text are dropped.

    Only JSON objects count. A field that is missing, empty or no string is '' (a source is
    'unknown'); the last of repeated keys wins.
    """
    trimmed = tx.once(lines, {"_line": tx.strip(F.make_valid_utf8(line))})
    if line != "_line":
        trimmed = trimmed.drop(line)
    # Read as the only element of an array: text behind the object then breaks the line.
    only = F.from_json(F.concat(F.lit("["), F.col("_line"), F.lit("]")), _POSTS, {"allowSingleQuotes": "false"})
    parsed = tx.once(trimmed.where(F.col("_line") != ""), {"_posts": only})
    kept = parsed.where(F.size("_posts") == 1).withColumn("_post", F.col("_posts")[0]).drop("_posts")

    def string_field(name: str) -> Column:
        value = F.col(f"_post.{name}")
        # from_json gives the text of other values too. Only what looks like one of them needs a
        # second look at the line, which fails where a key is repeated or NaN occurs.
        raw = F.try_variant_get(F.try_parse_json("_line"), f"$.{name}", "variant")
        is_string = F.coalesce(F.schema_of_variant(raw) == "STRING", ~value.startswith('"'))
        return F.when(value.isNull() | (value.rlike(_OTHER_VALUE) & ~is_string), F.lit("")).otherwise(value)

    posts = tx.once(
        kept,
        {
            "title": string_field("title"),
            "selftext": string_field("selftext"),
            "subreddit": tx.text_or_unknown(string_field("subreddit")),
        },
    ).drop("_post", "_line")
    return posts.where((tx.strip("title") != "") | (tx.strip("selftext") != ""))


def _filesystem(path: str):
    """The Arrow filesystem of a path or URI, and the path in it."""
    import pyarrow.fs as pafs

    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    return pafs.FileSystem.from_uri(path if "://" in path else f"file://{path}")


def _blocks(path: str) -> Iterator[tuple[int, bytes]]:
    """The window (as a power of two) and the bytes of a file, block by block; an error if its last frame is cut."""
    import zstandard

    filesystem, inner = _filesystem(path)
    with filesystem.open_input_stream(inner, compression=None) as raw:
        frames = zstandard.ZstdDecompressor(max_window_size=1 << MAX_WINDOW)
        frame, window = None, None
        while block := raw.read(_BLOCK >> 4):
            if window is None:
                window = max(zstandard.get_frame_parameters(block).window_size - 1, 1).bit_length()
            while block:
                frame = frame or frames.decompressobj()
                if text := frame.decompress(block):
                    yield window, text
                block = b""
                if frame.eof:
                    block, frame = frame.unused_data, None
        if frame is not None:
            raise EOFError("the last frame is cut off")
        if window is None:
            raise EOFError("the file is empty")


def stage(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Every file decoded once: its lines, and behind them one row that tells how it ended, written.

    A task has one file and its rows are committed together, so the last row admits or bars exactly the
    lines of the same attempt. Lines end at LF, CR or both. A row without `is_whole` is a line.
    """
    import pyarrow as pa

    fields = [("src_file", pa.string()), ("src_line", pa.int64()), ("value", pa.string()), ("window_log", pa.int32()),
              ("n_bytes", pa.int64()), ("is_whole", pa.bool_()), ("error", pa.string())]
    schema = pa.schema(fields)

    def decode(path: str) -> Iterator[pa.RecordBatch]:
        number, size, window, error, held, rest = 0, 0, None, None, [], b""

        def lines() -> pa.RecordBatch:
            nonlocal number, held
            found, held = held, []
            first, number = number, number + len(found)
            own = {"src_file": [path] * len(found), "src_line": list(range(first, number)), "value": found}
            return pa.RecordBatch.from_pydict(own | {n: [None] * len(found) for n, _ in fields[3:]}, schema)

        try:
            waiting = 0
            for window, block in _blocks(path):
                size += len(block)
                waiting += len(block)
                *whole, rest = (rest + block).replace(b"\r\n", b"\n").split(b"\n")
                for line in whole:
                    held += line.decode("utf-8", "replace").split("\r")
                if waiting >= _BLOCK:
                    yield lines()
                    waiting = 0
            held += rest.decode("utf-8", "replace").split("\r")
        except Exception as e:  # noqa: BLE001 - any failure bars the file, and none but this one
            error = f"{type(e).__name__}: {e}"
        yield lines()
        end = (path, None, None, window, size, error is None, error)
        yield pa.RecordBatch.from_pydict({n: [v] for (n, _), v in zip(fields, end)}, schema)

    def run(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                yield from decode(path)

    listed = spark.createDataFrame([(p,) for p in paths], "src_file string")
    return materialise(listed.repartition(max(1, len(paths))).mapInArrow(run, _STAGED), "dump-lines")


def write_dumps(lines: DataFrame, folder: str) -> None:
    """Compressed dump files from rows of (file_name, line_no, value), lines in order of their number.

    A file is written by one task as a stream, whatever its length.
    """

    def run(batches):
        import zstandard

        name, sink = None, None
        for batch in batches:
            for file_name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if file_name != name:
                    if sink is not None:
                        sink.close()
                    filesystem, inner = _filesystem(f"{folder}/{file_name}")
                    filesystem.create_dir(inner.rsplit("/", 1)[0])
                    raw = filesystem.open_output_stream(inner, compression=None)
                    name, sink = file_name, zstandard.ZstdCompressor().stream_writer(raw)
                sink.write(value.encode() + b"\n")
        if sink is not None:
            sink.close()
        yield from ()

    placed = lines.repartition("file_name").sortWithinPartitions("file_name", "line_no")
    placed.select("file_name", "value").mapInArrow(run, "done boolean").write.format("noop").mode("overwrite").save()


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines with file and an increasing position in it, by Spark's own text reader."""
    return spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_line"),
    )


def ingest(
    spark: SparkSession, folder: str, sources: Iterable[str] = fixed.SOURCES
) -> tuple[DataFrame, DataFrame]:
    """Posts of all listed, readable dump files, and a report with one row per file.

    A file that cannot be decoded to its end gives no posts at all; the others are unaffected. Each file is
    decoded once.
    """
    found = discover(spark, folder, sources)
    # One row per dump file, from a directory listing the driver has already made.
    listed = [r["src_file"] for r in found.where("is_listed").select("src_file").collect()]
    staged = stage(spark, listed) if listed else spark.createDataFrame([], _STAGED)
    ends = staged.where("is_whole IS NOT NULL").select(
        "src_file", "window_log", "n_bytes", F.col("is_whole").alias("is_readable"), "error"
    )
    report = found.drop("file_bytes").join(F.broadcast(ends), "src_file", "left")  # one row per file
    admitted = ends.where("is_readable").select("src_file")
    lines = staged.where("is_whole IS NULL").select("src_file", "src_line", "value")
    posts = parse_submissions(lines.join(F.broadcast(admitted), "src_file", "left_semi"))
    return posts.select("title", "selftext", "subreddit", "src_file", F.lit(0).cast("long").alias("src_block"), "src_line"), report
