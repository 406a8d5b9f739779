"""Session settings, and the shared folder that intermediate tables go to."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def local_session(cores: int | str = "*", app: str = "sheafmill") -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("SHEAFMILL_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder in spark.checkpoint.dir.

    Where none is set, a session on one machine gets a temporary folder that goes when the process
    ends; on a cluster each executor would write to its own disk, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="sheafmill-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this process wrote to the checkpoint folder; results that read it must be written before."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write once and read back: cuts lineage and survives the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm_path.getFileSystem(conf).exists(jvm_path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give small inputs to all cores before costly per-row work.

    A small file may consist of a single row group, which one task reads. Inputs that fill every
    core with whole splits are left alone: for them an exchange would only cost.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores, *keys) if size < cores * split else df
