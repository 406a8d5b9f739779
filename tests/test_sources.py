import csv
import io
import json
import os

import pandas as pd
import pytest
import zstandard
from pyspark.sql import functions as F

from sheafmill import fixed
from sheafmill.operators import corpus, experiments
from sheafmill.sources import posts, reports, results, runlogs, shards, submissions, vocab
from sheafmill.operators.tokenizer import Vocabulary

LINES = [
    b'{"title": "One", "selftext": "first", "subreddit": "tifu"}',
    b"",
    b"   ",
    b"{broken",
    b"[1, 2]",
    b'"text"',
    b"12",
    b"{}",
    b'{"title": 5, "selftext": "numeric title"}',
    b'{"title": "5", "selftext": "digit title"}',
    b'{"title": true, "selftext": "boolean title"}',
    b'{"title": {"a": 1}, "selftext": "object title"}',
    b'{"title": "[x] tag", "selftext": ["a"]}',
    b'{"title": "a", "title": "b", "selftext": "repeated"}',
    b'{"title": "  ", "selftext": "\\t"}',
    b'{"title": null, "selftext": "no title", "subreddit": ""}',
    b'{"title": "bad \xff byte", "selftext": "", "subreddit": "tifu"}',
    b' {"title": "padded", "selftext": ""} ',
    b'{"title": "x"} extra',
    b'{"title": "x"}{"title": "y"}',
    b'{"title": "x"},{"title": "y"}',
    b"{'title': 'single quotes'}",
    b'{"title": NaN, "selftext": "bare NaN"}',
    b'{"title": "\\"NaN\\"", "score": 1e999}',
    b'{"title": "-5 things", "nested": {"title": "y"}}',
]
EXPECTED = [
    ("One", "first", "tifu"),
    ("", "numeric title", "unknown"),
    ("5", "digit title", "unknown"),
    ("", "boolean title", "unknown"),
    ("", "object title", "unknown"),
    ("[x] tag", "", "unknown"),
    ("b", "repeated", "unknown"),
    ("", "no title", "unknown"),
    ("bad \ufffd byte", "", "tifu"),
    ("padded", "", "unknown"),
    ("", "bare NaN", "unknown"),
    ('"NaN"', "", "unknown"),
    ("-5 things", "", "unknown"),
]


@pytest.fixture(scope="module")
def dumps(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dumps")
    data = b"\n".join(LINES) + b"\n"
    (folder / "TIFU_submissions.zst").write_bytes(zstandard.compress(data))
    (folder / "offmychest.zst").write_bytes(zstandard.compress(b'{"title": "second file", "selftext": ""}\n'))
    (folder / "other_submissions.zst").write_bytes(zstandard.compress(b'{"title": "not listed"}\n'))
    whole = zstandard.compress(os.urandom(1 << 16).hex().encode() + b"\n" + b'{"title": "lost", "selftext": ""}\n' * 5000)
    (folder / "confession_submissions.zst").write_bytes(whole[: len(whole) // 2])
    params = zstandard.ZstdCompressionParameters.from_level(3, window_log=31, enable_ldm=True)
    line = b'{"title": "long window", "selftext": "z", "subreddit": "confessions"}\n'
    (folder / "confessions_submissions.zst").write_bytes(
        zstandard.ZstdCompressor(compression_params=params).compressobj().compress(line)
        + b""
    )
    sink = io.BytesIO()
    with zstandard.ZstdCompressor(compression_params=params).stream_writer(sink, closefd=False) as w:
        w.write(line * 3)
    (folder / "confessions_submissions.zst").write_bytes(sink.getvalue())
    return str(folder)


def test_ingest_isolates_failures_and_reads_long_windows(spark, dumps):
    found, report = submissions.ingest(spark, dumps)
    rows = found.collect()
    first = [tuple(r)[:3] for r in sorted(rows, key=lambda r: (r.src_file, r.src_block, r.src_line)) if "TIFU" in r.src_file]
    assert first == EXPECTED
    others = sorted(tuple(r)[:3] for r in rows if "TIFU" not in r.src_file)
    assert others == [("long window", "z", "confessions")] * 3 + [("second file", "", "unknown")]
    status = {os.path.basename(r.src_file): r for r in report.collect()}
    assert status["confession_submissions.zst"].is_readable is False
    assert status["confessions_submissions.zst"].window_log == 31
    assert status["other_submissions.zst"].is_listed is False and status["other_submissions.zst"].is_readable is None
    assert status["TIFU_submissions.zst"].source == "tifu"


def test_first_post_wins_in_file_order(spark):
    rows = [
        ("t", "b", "late", "f2", 0, 1), ("t", "b", "early", "f1", 0, 9), ("t", "b", "later", "f1", 5, 1),
        ("a", "b|||c", "x", "f1", 0, 1), ("a|||b", "c", "y", "f1", 0, 2), ("t", None, "null body", "f1", 0, 3),
        ("t", "", "empty body", "f1", 0, 4),
    ]
    table = spark.createDataFrame(rows, "title string, selftext string, subreddit string, src_file string, src_block long, src_line long")
    order = ["src_file", "src_block", "src_line"]
    exact = {r.subreddit for r in corpus.first_posts(table, order).collect()}
    joined = {r.subreddit for r in corpus.first_posts(table, order, exact=False).collect()}
    assert exact == {"early", "x", "y", "null body"}
    assert joined == {"early", "x", "null body"}


ODD = ["", "plain", 'quo"te', "comma, comma", "line\nend", "crlf\r\nend", "back\\slash", '\\"', " padded ", "é😀", "NA", "null", '""', "a\\\nb"]


def test_posts_csv_round_trip(spark, tmp_path):
    rows = [(t, b, "s") for t in ODD for b in ODD]
    path = str(tmp_path / "posts")
    posts.write_posts_csv(spark.createDataFrame(rows, posts.POST_SCHEMA), path)
    back = [tuple(r) for r in posts.read_posts_csv(spark, path).collect()]
    assert sorted(back) == sorted(rows)
    parts = [os.path.join(path, f) for f in os.listdir(path) if f.endswith(".csv")]
    with_pandas = pd.concat([pd.read_csv(p, keep_default_na=False) for p in parts])
    assert sorted(map(tuple, with_pandas.values.tolist())) == sorted(rows)


def test_posts_csv_from_other_writers(spark, tmp_path):
    rows = [("NA", "body", "s"), ("t", "None", "s"), ("x", "kept", "s"), ("", "empty", "s"), ("q\"uote", "l\nb", "s")]
    path = tmp_path / "posts.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(["title", "selftext", "subreddit"])
        writer.writerows(rows)
    keep = sorted(tuple(r) for r in posts.read_posts_csv(spark, str(path)).collect())
    assert keep == sorted(rows)
    blank = sorted(tuple(r) for r in posts.read_posts_csv(spark, str(path), "pandas").collect())
    frame = pd.read_csv(path)
    frame[["title", "selftext"]] = frame[["title", "selftext"]].fillna("")
    assert blank == sorted(map(tuple, frame.values.tolist()))
    assert len(fixed.NA_TOKENS) == 19


def texts(spark, n):
    return spark.range(n).select(F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))


@pytest.mark.parametrize("n", [101, 100 + 50 * 2, 100 + 50 * 2 + 1])
def test_shards_hold_all_rows(spark, tmp_path, n):
    sharded = corpus.split_and_shard(texts(spark, n), val_rows=100, shard_rows=50)
    path = str(tmp_path / "corpus")
    assert shards.write_shards(sharded, path)
    assert not shards.write_shards(sharded, path)
    sizes = {(r.split, r.shard): r.n for r in shards.list_shards(spark, path).collect()}
    assert sizes.pop(("val", 0)) == 100
    assert sum(sizes.values()) == n - 100 and set(sizes) == {("train", i + 1) for i in range(len(sizes))}
    assert all(v == 50 for (_, s), v in sizes.items() if s < len(sizes))
    assert shards.read_shards(spark, path).select("text").distinct().count() == n
    assert corpus.split_overlap(shards.read_shards(spark, path)).isEmpty()
    first = shards.load_documents(spark, path, 30, shard_rows=50)
    assert sorted(r.pos for r in first.collect()) == list(range(min(30, n - 100)))
    files = [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]
    assert len(files) == len(sizes) + 1


def test_no_training_rows_is_refused(spark, tmp_path):
    sharded = corpus.split_and_shard(texts(spark, 10), val_rows=10, shard_rows=5)
    with pytest.raises(ValueError):
        shards.write_shards(sharded, str(tmp_path / "corpus"))


def test_num_shards_keeps_the_held_out_rows(spark):
    sharded = corpus.split_and_shard(texts(spark, 200), val_rows=20, shard_rows=50, num_shards=2)
    sizes = {(r.split, r.shard): r.n for r in sharded.groupBy("split", "shard").agg(F.count("*").alias("n")).collect()}
    assert sizes == {("val", 0): 20, ("train", 1): 50, ("train", 2): 50}


GOLDEN = """commit\tval_bpb\tmemory_gb\tstatus\tdescription
a1b2c3d\t0.997900\t44.0\tkeep\tbaseline
b2c3d4e\t0.993200\t44.2\tkeep\tincrease LR to 0.04
c3d4e5f\t1.005000\t44.0\tdiscard\tswitch to GeLU "activation", now
d4e5f6g\t0.000000\t0.0\tcrash\tdouble model width (OOM)
"""


def test_results_log(spark, tmp_path):
    path = tmp_path / "mar5.tsv"
    path.write_text(GOLDEN)
    log = results.read_results(spark, str(path))
    rows = log.orderBy("seq").collect()
    assert [r.seq for r in rows] == [0, 1, 2, 3]
    assert rows[2].description == 'switch to GeLU "activation", now' and rows[3].status == "CRASH"
    (facts,) = experiments.summary(log).collect()
    assert (facts.n_experiments, facts.baseline_bpb, facts.best_bpb) == (4, 0.9979, 0.9932)
    assert facts.keep_rate == pytest.approx(2 / 3) and facts.improvement == pytest.approx(0.0047)
    assert facts.improvement_pct == pytest.approx(0.47, abs=0.005)
    (hit,) = experiments.top_hits(log).collect()
    assert hit["rank"] == 1 and hit.delta == pytest.approx(0.0047)

    out = str(tmp_path / "out")
    results.write_results(log.withColumn("run_tag", F.lit("mar5")), out)
    (part,) = [os.path.join(r, f) for r, _, fs in os.walk(out) for f in fs if f.endswith(".txt")]
    assert open(part).read() == GOLDEN.split("\n", 1)[1]


def test_bad_log_rows_are_refused(spark, tmp_path):
    row = [("r", 0, "c", 1.0, 1.0, "maybe", "d"), ("r", 1, "c", 1.0, 1.0, "keep", "a\tb"), ("r", 2, "c", 1.0, 1.0, " Keep ", "ok")]
    log = spark.createDataFrame(row, "run_tag string, seq long, commit string, val_bpb double, memory_gb double, status string, description string")
    assert [r.seq for r in results.invalid_rows(log).orderBy("seq").collect()] == [0, 1]
    with pytest.raises(ValueError):
        results.write_results(log, str(tmp_path / "log"))


def test_log_keeps_order_and_gaps(spark, tmp_path):
    """Several files per run and append, whatever order they are finished in; missing scores stay missing."""
    schema = "run_tag string, seq long, commit string, val_bpb double, memory_gb double, status string, description string"
    rows = [(f"r{k % 2}", k, f"c{k}", None if k % 5 == 0 else k / 100, None, "crash" if k % 7 == 0 else "keep", None) for k in range(400)]
    log, path = spark.createDataFrame(rows, schema), str(tmp_path / "log")
    results.write_results(log.where("seq < 200"), path, files=8)
    results.write_results(log.where("seq >= 200"), path, files=8)
    back = {(r.run_tag, r.seq): r for r in results.read_results(spark, path).collect()}
    assert len(back) == 400
    for k, (run, seq, commit, value, *_, status, _) in enumerate(rows):
        r = back[run, seq // 2]
        assert r.commit == commit and r.val_bpb == (0.0 if value is None and status == "crash" else value)


def test_half_written_corpus_is_not_complete(spark, tmp_path):
    for split in ("train", "val"):
        (tmp_path / f"split={split}").mkdir()
    assert not shards.is_complete(spark, str(tmp_path))


def test_last_value_counts_and_steps_match(spark):
    lines = [("a", 0, "val_bpb: 0.99"), ("a", 1, "val_bpb: 0.98"), ("b", 0, "nothing"),
             ("a", 2, "resumed at step 7 " + STEPS.strip().split("\r")[0])]
    df = spark.createDataFrame(lines, "run_tag string, line long, value string")
    found = {r.run_tag: r.val_bpb for r in runlogs.parse_summaries(df).collect()}
    assert found == {"a": 0.98, "b": None}
    assert [r.step for r in runlogs.parse_steps(df).collect()] == [0]


SUMMARY = """---
val_bpb:          0.997900
training_seconds: 300.1
total_seconds:    325.9
peak_vram_mb:     45060.2
mfu_percent:      39.80
total_tokens_M:   499.6
num_steps:        953
num_params_M:     50.3
depth:            8
"""
STEPS = (
    "\rstep 00000 (0.0%) | loss: 9.010000 | lrm: 0.00 | dt: 1200ms | tok/sec: 27,306 | mfu: n/a | epoch: 1 | remaining: 300s    "
    "\rstep 00012 (3.4%) | loss: 5.250000 | lrm: 1.00 | dt: 310ms | tok/sec: 1,105,703 | mfu: 39.8% | epoch: 2 | remaining: 289s    "
)


def test_run_logs(spark, tmp_path):
    (tmp_path / "good.log").write_text("start\n" + STEPS + "\n" + SUMMARY)
    (tmp_path / "no_rate.log").write_text(SUMMARY.replace("39.80", "n/a") + "dataset: web\n")
    (tmp_path / "crash.log").write_text("Traceback\nRuntimeError: out of memory\n")
    lines = runlogs.read_log_lines(spark, str(tmp_path))
    found = {os.path.basename(r.run_tag): r for r in runlogs.parse_summaries(lines).collect()}
    good = found["good.log"]
    assert (good.val_bpb, good.peak_vram_mb, good.num_steps, good.mfu_percent) == (0.9979, 45060.2, 953, 39.8)
    assert found["no_rate.log"].mfu_percent is None and found["no_rate.log"].dataset == "web"
    rows = {os.path.basename(r.run_tag): r for r in experiments.log_rows(runlogs.parse_summaries(lines)).collect()}
    assert (rows["good.log"].val_bpb, rows["good.log"].memory_gb, rows["good.log"].is_crash) == (0.9979, 44.0, False)
    assert (rows["crash.log"].val_bpb, rows["crash.log"].memory_gb, rows["crash.log"].is_crash) == (0.0, 0.0, True)
    steps = [tuple(r)[1:] for r in runlogs.parse_steps(lines).orderBy("step").collect()]
    assert steps == [
        (0, 0.0, 9.01, 0.0, 1200, 27306, None, 1, 300),
        (12, 3.4, 5.25, 1.0, 310, 1105703, 39.8, 2, 289),
    ]


def test_vocabulary_round_trip_and_export(spark, tmp_path):
    bytes_ = [bytes([b]) for b in range(256)]
    known = Vocabulary(bytes_ + [b"th", "é".encode()], [(b"t", b"h"), (b"\xc3", b"\xa9")])
    path = str(tmp_path / "vocab")
    assert vocab.write_vocab(spark, known, path) and not vocab.write_vocab(spark, known, path)
    assert vocab.read_vocab(spark, path) == known
    frame = vocab.read_vocab_frame(spark, path)
    assert frame.where("is_special").agg(F.sum("nbytes")).first()[0] == 0
    vocab.export_vocab_json(frame, str(tmp_path / "json"))
    (part,) = [f for f in os.listdir(tmp_path / "json") if f.endswith(".txt")]
    exported = json.loads((tmp_path / "json" / part).read_text())
    assert exported["bos_id"] == 258 and exported["vocab"]["th"] == 256 and exported["vocab"]["<|reserved_3|>"] == 261


def test_reports(spark, tmp_path):
    report = spark.createDataFrame([("a", 2), ("b", 1)], "k string, n long")
    for form in ("json", "parquet", "text"):
        reports.write_report(report, str(tmp_path / form), form)
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    assert [r.value for r in reports.display_lines(report, ["n"]).collect()] == ["k=b  n=1", "k=a  n=2"]
    with pytest.raises(ValueError):
        reports.write_report(report, str(tmp_path / "x"), "pdf")
