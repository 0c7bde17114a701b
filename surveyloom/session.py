"""Session settings and the shared working folder."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "surveyloom", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in `spark.checkpoint.dir`.

    Only a local session, where driver and executors are one process, may fall back
    to a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="surveyloom-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage in one pass, survives the loss of executors, and gives the planner
    the true size.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder and what it holds; nothing happens if it isn't there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """`materialise` for the length of a block; the files go at its end, also after an error.

    So do the shuffle files of what has run so far, which Spark keeps until the driver collects its garbage.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove_folder(spark, path)
        gc.collect()
        spark._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """Deal out a frame that reads fewer splits than there are cores.

    For text-heavy work on a few files of one row group each; a table of many splits is
    left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def fine_partitions(spark: SparkSession) -> int:
    """Partitions for a stage that holds most of its rows in memory several times over, by number so that they aren't coalesced.

    Coalesced partitions are sized by their compressed bytes, which says little of rows that repeat long texts.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's Python workers, once.

    Needed where it is not installed on them and was not given by `--py-files`.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(prefix="surveyloom-"), "surveyloom")
        context.addPyFile(shutil.make_archive(target, "zip", root, "surveyloom"))
        _SHIPPED.add(context.applicationId)
