"""Replies kept on disk by the digest of prompt and options, so that no prompt is paid for twice.

A run's tasks write what they get, a file for some batches at a time, below `<store>/run=<id>/part=<n>/`. When the run is
through, its files become one batch `<store>/batch=<id>/` and the run's folder goes. A reader takes both, so replies of a
run that was lost are there, and a task that runs again reads its own files first. Only replies are kept: a prompt whose call
failed is asked again by the next run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveyloom.session import remove_folder

SCHEMA = "_key string, _reply string"
ARROW = pa.schema([("_key", pa.string()), ("_reply", pa.string())])


def opened(folder: str) -> tuple[arrow_fs.FileSystem, str]:
    """A worker's file system and path for a folder of the shared store."""
    if folder.startswith("file:"):
        folder = "/" + folder.removeprefix("file:").lstrip("/")
    return arrow_fs.FileSystem.from_uri(folder)


def stored(spark: SparkSession, store: str) -> DataFrame:
    """One row per digest with a reply, out of finished batches and of runs that were lost."""
    target = spark._jvm.org.apache.hadoop.fs.Path(store)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], SCHEMA)
    files = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(store)
    return files.groupBy("_key").agg(F.min("_reply").alias("_reply"))


def asked_once(
    batches: Iterator[pd.DataFrame],
    folder: str,
    ask: Callable[[Sequence[str]], tuple[Sequence, Sequence]],
    batch_size: int,
    per_file: int,
) -> Iterator[pd.DataFrame]:
    """Ask for the prompts that `folder` has no reply for, write replies there, and give out the failures.

    A file holds the replies of `per_file` batches and is moved to its name when it is whole, so a lost task pays again for
    that many batches at most.
    """
    files, root = opened(folder)
    files.create_dir(root, recursive=True)
    here = [f for f in files.get_file_info(arrow_fs.FileSelector(root)) if f.base_name.endswith(".parquet") and not f.base_name.startswith("_")]
    known = set()
    for f in here:
        known.update(pq.read_table(f.path, columns=["_key"], filesystem=files).column("_key").to_pylist())
    keys, replies, waiting = [], [], 0

    def keep() -> None:
        name = uuid.uuid4().hex[:12]
        pq.write_table(pa.table([keys, replies], schema=ARROW), f"{root}/_{name}", filesystem=files)
        files.move(f"{root}/_{name}", f"{root}/{name}.parquet")

    for pdf in batches:
        pdf = pdf[~pdf["_key"].isin(known)]
        for start in range(0, len(pdf), batch_size):
            part = pdf.iloc[start : start + batch_size]
            got, status = ask(part["_prompt"].tolist())
            failed = [(k, s) for k, r, s in zip(part["_key"], got, status) if r is None]
            answered = [(k, r) for k, r in zip(part["_key"], got) if r is not None]
            keys += [k for k, _ in answered]
            replies += [r for _, r in answered]
            waiting += 1
            if waiting >= per_file and keys:
                keep()
                keys, replies, waiting = [], [], 0
            if failed:
                yield pd.DataFrame(failed, columns=["_key", "_status"])
    if keys:
        keep()


def finish(spark: SparkSession, store: str, run: str) -> None:
    """Turn a run's many files into one batch; nothing happens if the run wrote none."""
    folder = f"{store}/run={run}"
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        rows = spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(folder)
        rows.hint("rebalance").write.parquet(f"{store}/batch={run}")
        remove_folder(spark, folder)
