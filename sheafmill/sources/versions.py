"""State that several writers change: numbers only one of them can take, and tables replaced as a whole.

A table lives in numbered version folders. A writer takes the next number, writes its version, and commits by
creating one small file. Readers see the greatest committed version, so a writer that dies in between changes
nothing, and several tables written as one version are never mixed. Of two writers at the same time, the one that took
the later number wins, whichever ends first.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def create_once(spark: SparkSession, path: str, content: str = "") -> bool:
    """Create a file with all of its content at once; of all who try, one gets True.

    The content is written beside it and given its name in one step, which a file system refuses when the name is
    taken. On a local disk Hadoop's rename replaces files, the operating system's link does not.
    """
    fs, at = _located(spark, path)
    beside = f"{path.rsplit('/', 1)[0]}/_new-{uuid.uuid4().hex}"
    if fs.getUri().getScheme() == "file":
        local = fs.makeQualified(at).toUri().getPath()
        beside = fs.makeQualified(_located(spark, beside)[1]).toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(beside, "w", encoding="utf-8") as f:
            f.write(content)
        try:
            os.link(beside, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(beside)
        return True
    source = _located(spark, beside)[1]
    out = fs.create(source, False)
    out.write(bytearray(content, "utf-8"))
    out.close()
    try:
        if fs.rename(source, at):
            return True
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
    fs.delete(source, False)
    if not fs.exists(at):
        raise OSError(f"{path} could not be created")
    return False


def numbers(spark: SparkSession, folder: str, prefix: str = "") -> list[int]:
    """The numbers that entries of a folder are named by, in order."""
    fs, at = _located(spark, folder)
    if not fs.exists(at):
        return []
    names = (entry.getPath().getName() for entry in fs.listStatus(at))
    ends = (n[len(prefix):] for n in names if n.startswith(prefix))
    return sorted(int(n) for n in ends if n.isdigit())


def take_number(spark: SparkSession, folder: str, least: int = 0) -> int:
    """The next free number of a folder, from `least` on; nobody else gets it."""
    number = max([least, *(n + 1 for n in numbers(spark, folder)[-1:])])
    while not create_once(spark, f"{folder}/{number}"):
        number += 1
    return number


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the version that counts, None where there is none yet."""
    done = numbers(spark, f"{path}/_commits")
    return f"{path}/version={done[-1]}" if done else None


def need_current(spark: SparkSession, path: str) -> str:
    folder = current(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no finished version in {path}")
    return folder


def replace(spark: SparkSession, path: str, write: Callable[[str], None], keep: int = 2) -> str:
    """Let `write` fill a new version's folder, then make it the one that counts.

    If `write` raises, the version before stays. The last `keep` versions are kept for readers under way.
    """
    number = take_number(spark, f"{path}/_claims")
    folder = f"{path}/version={number}"
    write(folder)
    create_once(spark, f"{path}/_commits/{number}")
    for old in numbers(spark, f"{path}/_commits")[:-keep]:
        for gone in (f"{path}/_commits/{old}", f"{path}/version={old}"):
            delete(spark, gone)
    return folder


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _located(spark, path)
    fs.delete(at, True)
