"""State under several writers, and writers that die half way."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from sheafmill.operators import corpus
from sheafmill.operators.tokenizer import Vocabulary
from sheafmill.sources import results, shards, versions, vocab

LOG = "run_tag string, seq long, commit string, val_bpb double, memory_gb double, status string, description string"


def together(n, work):
    """`work(k)` in n threads that start at once; raises what any of them raised."""
    gate, failed = threading.Barrier(n), []

    def run(k):
        try:
            gate.wait()
            work(k)
        except Exception as e:  # handed on below
            failed.append(e)

    threads = [threading.Thread(target=run, args=(k,)) for k in range(n)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failed:
        raise failed[0]


def test_a_number_goes_to_one_taker(spark, tmp_path):
    folder, got = str(tmp_path / "claims"), []
    together(16, lambda k: got.append(versions.take_number(spark, folder)))
    assert sorted(got) == list(range(16))
    assert versions.take_number(spark, folder, 40) == 40 and versions.take_number(spark, folder) == 41


def test_appends_at_the_same_time_lose_and_mix_no_line(spark, tmp_path):
    path = str(tmp_path / "log")

    def append(k):
        rows = [("r", i, f"w{k}-{i}", 1.0, 2.0, "keep", None) for i in range(50)]
        results.write_results(spark.createDataFrame(rows, LOG), path, files=3)

    append(0)
    together(4, lambda k: append(k + 1))
    append(5)
    lines = [r.commit for r in results.read_results(spark, path).orderBy("seq").collect()]
    writers = [lines[at].split("-")[0] for at in range(0, 300, 50)]
    assert lines == [f"{w}-{i}" for w in writers for i in range(50)]
    assert writers[0] == "w0" and writers[-1] == "w5" and len(set(writers)) == 6


def test_an_append_that_died_leaves_its_number_unused(spark, tmp_path):
    path = str(tmp_path / "log")
    row = spark.createDataFrame([("r", 0, "c", 1.0, 2.0, "keep", None)], LOG)
    results.write_results(row, path)
    versions.take_number(spark, f"{path}/_claims")  # taken, never written
    results.write_results(row.withColumn("commit", F.lit("d")), path)
    assert versions.numbers(spark, path, "append=") == [0, 2]
    assert [r.commit for r in results.read_results(spark, path).orderBy("seq").collect()] == ["c", "d"]


def test_a_table_is_replaced_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "table")
    assert versions.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versions.need_current(spark, path)

    def broken(folder):
        spark.range(3).write.parquet(f"{folder}/a")
        raise RuntimeError("killed in between")

    for n in (1, 2, 3):
        versions.replace(spark, path, spark.range(n).write.parquet)
        before = versions.current(spark, path)
        with pytest.raises(RuntimeError):
            versions.replace(spark, path, broken)
        assert versions.current(spark, path) == before and spark.read.parquet(before).count() == n
    assert versions.numbers(spark, f"{path}/_commits") == [2, 4]  # the last two


def test_a_reader_under_way_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "table")
    versions.replace(spark, path, spark.range(5).write.parquet)
    reader = spark.read.parquet(versions.need_current(spark, path))
    versions.replace(spark, path, spark.range(9).write.parquet)
    assert reader.count() == 5 and spark.read.parquet(versions.need_current(spark, path)).count() == 9


def test_a_vocabulary_is_never_mixed(spark, tmp_path, monkeypatch):
    bytes_ = [bytes([b]) for b in range(256)]
    old = Vocabulary(bytes_ + [b"th"], [(b"t", b"h")])
    new = Vocabulary(bytes_ + [b"an", b"and"], [(b"a", b"n"), (b"an", b"d")])
    path = str(tmp_path / "vocab")
    assert vocab.write_vocab(spark, old, path)

    def die(self, spark):
        raise RuntimeError("killed between the tables")

    with monkeypatch.context() as m:
        m.setattr(Vocabulary, "vocab_frame", die)
        with pytest.raises(RuntimeError):
            vocab.write_vocab(spark, new, path, mode="reset")
        first = str(tmp_path / "first")
        with pytest.raises(RuntimeError):
            vocab.write_vocab(spark, new, first)
    assert vocab.read_vocab(spark, path) == old and not vocab.has_vocab(spark, first)
    assert vocab.write_vocab(spark, new, path, mode="reset") and vocab.read_vocab(spark, path) == new


def test_a_refused_reset_leaves_the_old_corpus(spark, tmp_path):
    def cut(n):
        texts = spark.range(n).select(F.concat(F.lit("text "), "id").alias("text"))
        return corpus.split_and_shard(texts, val_rows=10, shard_rows=20)

    path = str(tmp_path / "corpus")
    assert shards.write_shards(cut(50), path)
    with pytest.raises(ValueError):
        shards.write_shards(cut(10), path, mode="reset")
    assert shards.is_complete(spark, path) and shards.read_shards(spark, path).count() == 50
    assert shards.write_shards(cut(70), path, mode="reset") and shards.read_shards(spark, path).count() == 70
    assert "split=train" not in os.listdir(path)  # only whole versions
