"""Whole jobs, streams, and every named query against its SQL."""

import csv
import threading
from concurrent.futures import ThreadPoolExecutor

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sheafmill.operators import experiments
from sheafmill.plans import corpus as plans
from sheafmill.plans import experiments as reports
from sheafmill.session import scratch_path
from sheafmill.sources import posts, shards, versions
from sheafmill.streaming import ingest, progress
from tools.check import TABLES, canonical


def dump(folder, name, titles):
    lines = "\n".join(f'{{"title": "{t}", "selftext": "a body long enough to be kept in the corpus", "subreddit": "s"}}' for t in titles)
    (folder / name).write_bytes(zstandard.compress(lines.encode()))


def test_from_dumps_to_training_rows(spark, tmp_path):
    dumps = tmp_path / "dumps"
    dumps.mkdir()
    dump(dumps, "tifu_submissions.zst", [f"title {i}" for i in range(60)])
    dump(dumps, "confession_submissions.zst", [f"title {i}" for i in range(40, 90)])
    csv_path, shard_path, vocab_path = (str(tmp_path / n) for n in ("csv", "corpus", "vocab"))
    report, breakdown = plans.extract_posts(spark, str(dumps), csv_path)
    assert report.count() == 2 and breakdown.first().n == 90
    table = posts.read_posts_csv(spark, csv_path)
    assert table.count() == 90
    assert plans.prepare_corpus(table, shard_path, val_rows=20, shard_rows=30)
    assert not plans.prepare_corpus(table, shard_path, val_rows=20, shard_rows=30)
    known = plans.prepare_tokenizer(spark, shard_path, vocab_path, vocab_size=280)
    assert known.size == 280
    assert plans.prepare_tokenizer(spark, shard_path, vocab_path) == known
    rows = plans.training_table(shards.read_shards(spark, shard_path, "train"), known, batch=8, length=16)
    batches = {r.batch_no: r.n for r in rows.groupBy("batch_no").agg(F.count("*").alias("n")).collect()}
    assert batches == {i: 8 for i in range(8)} | {8: 6}
    tables = plans.length_report(shards.load_documents(spark, shard_path, None), known, max_len=64)
    assert tables["characters"].first().n == 70 and tables["packing"].first().windows > 0
    assert sum(r.windows * r.documents for r in tables["packing_distribution"].collect()) == 70
    assert tables["implications"].first().two_per_row_len == 2 * tables["implications"].first().median_tokens


def test_experiment_report_is_complete(spark, sf_dir):
    from sheafmill.catalog.runs import results

    log = results(spark, sf_dir)
    tables = reports.experiment_report(log)
    assert all(not t.isEmpty() for t in tables.values())
    assert reports.preview(log, 5).agg(F.max("seq")).first()[0] < 5


def test_stream_adds_each_text_once_and_repeats_safely(spark, tmp_path):
    folder, sink, offsets = tmp_path / "in", str(tmp_path / "sink"), str(tmp_path / "offsets")
    folder.mkdir()

    def run():
        stream = ingest.stream_submissions(spark, str(folder))
        ingest.ingest_stream(stream, sink, offsets).trigger(availableNow=True).start().awaitTermination()
        return sorted(r.text for r in ingest.read_sink(spark, sink).collect())

    dump(folder, "a.zst", ["one", "two", "two"])
    first = run()
    assert len(first) == 2
    dump(folder, "b.zst", ["two", "three"])
    second = run()
    assert len(second) == 3 and set(first) < set(second)
    assert run() == second
    # The last batch once more, as after a failure between the write and its commit.
    again = spark.createDataFrame([(t,) for t in second if "one" not in t], "text string")
    ingest.append_new_documents(sink, ingest.stream_id(spark, offsets))(again, 1)
    assert sorted(r.text for r in ingest.read_sink(spark, sink).collect()) == second

    # Another stream, or a fresh checkpoint, begins at batch 0 again and takes nothing away.
    other = tmp_path / "other"
    other.mkdir()
    dump(other, "c.zst", ["four", "one"])
    stream = ingest.stream_submissions(spark, str(other))
    ingest.ingest_stream(stream, sink, str(tmp_path / "more")).trigger(availableNow=True).start().awaitTermination()
    third = sorted(r.text for r in ingest.read_sink(spark, sink).collect())
    assert len(third) == 4 and set(second) < set(third)


def test_streams_at_the_same_time_leave_each_text_once(spark, tmp_path, monkeypatch):
    sink = str(tmp_path / "sink")
    made = [spark.createDataFrame([(f"text {i}",) for i in range(lo, lo + 60)], "text string") for lo in (0, 40, 80)]
    meet, create = threading.Barrier(3), versions.create_once
    waited = threading.local()

    def together(session, path, content=""):
        if not getattr(waited, "yes", False):  # all three have read the same sink before the first may commit
            waited.yes = True
            meet.wait(60)
        return create(session, path, content)

    monkeypatch.setattr(ingest.versions, "create_once", together)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda i: ingest.append_new_documents(sink, f"s{i}")(made[i], 0), range(3)))
    rows = ingest.read_sink(spark, sink).collect()
    assert sorted(r.text for r in rows) == sorted(f"text {i}" for i in range(140))
    assert {r.stream for r in rows} == {"s0", "s1", "s2"}
    assert [c[0] for c in ingest.commits(spark, sink)] == [0, 1, 2]
    # nothing is left of the attempts that lost
    assert len(list((tmp_path / "sink").glob("attempt=*"))) == 3 and not list((tmp_path / "sink" / "_work").iterdir())


def test_a_batch_reads_only_its_buckets_and_dead_writers_add_nothing(spark, tmp_path, monkeypatch):
    sink = str(tmp_path / "sink")
    ingest.append_new_documents(sink, "a")(spark.createDataFrame([(f"t{i}",) for i in range(500)], "text string"), 0)
    folders = [c[3] for c in ingest.commits(spark, sink)]
    one = ingest.bucketed(spark.createDataFrame([("t7",)], "text string")).first().bucket
    known = ingest.known_hashes(spark, sink, folders, [one])
    files = {f.rsplit("/", 2)[1] for f in known.select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert files == {f"bucket={one}"}
    assert "(bucket#" in known._jdf.queryExecution().toString().split("PartitionFilters: ")[1]

    def dies(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(ingest.versions, "create_once", dies)
        with pytest.raises(RuntimeError):
            ingest.append_new_documents(sink, "b")(spark.createDataFrame([("new",), ("t7",)], "text string"), 0)
    assert ingest.read_sink(spark, sink).count() == 500
    write = ingest.append_new_documents(sink, "b")
    write(spark.createDataFrame([("new",), ("t7",), (None,)], "text string"), 0)
    write(spark.createDataFrame([], "text string"), 1)
    assert ingest.read_sink(spark, sink).count() == 501


def test_live_progress_follows_the_log(spark, tmp_path):
    folder, table = tmp_path / "log", str(tmp_path / "live")
    folder.mkdir()
    schema = "run_tag string, seq long, val_bpb double, status string"

    def run(name, rows):
        with open(folder / name, "w", newline="") as f:
            csv.writer(f).writerows(rows)
        stream = spark.readStream.schema(schema).csv(str(folder)).withColumn("status", F.upper("status"))
        writer = progress.progress_stream(progress.live_progress(stream), table, str(tmp_path / "offsets"))
        writer.trigger(availableNow=True).start().awaitTermination()
        return {r.run_tag: r for r in progress.read_progress(spark, table).collect()}

    now = run("1.csv", [("a", 0, 1.0, "keep"), ("a", 1, 0.0, "crash"), ("b", 0, 2.0, "discard")])
    assert now["a"].best_bpb == 1.0 and now["a"].n_crash == 1 and now["b"].best_bpb is None
    now = run("2.csv", [("a", 2, 0.9, "keep"), ("b", 1, 1.9, "keep")])
    assert (now["a"].best_bpb, now["a"].n_experiments, now["b"].best_bpb) == (0.9, 3, 1.9)


def test_scratch_goes_to_the_folder_the_session_names(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())
    assert scratch_path(spark, "x") != path


@pytest.fixture(scope="module")
def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns[0] == "subreddit" and not result.isEmpty()


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, oracle, sf_dir, name):
    result = entry.queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in result.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    relation = oracle.sql(sql)
    assert canonical(result.columns, rows) == canonical(list(relation.columns), relation.fetchall())
