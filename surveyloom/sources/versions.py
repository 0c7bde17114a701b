"""Tables whose rewrites go to a new folder and then move one pointer.

The content of such a table lies in `<path>/_versions/<name>`, and the file `<path>/_current` holds the name. A reader that
resolved the pointer keeps its files until the switch after the next one. One writer at a time: a writer that finds the
pointer moved since it began gives up and leaves the table as the other one wrote it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

POINTER, VERSIONS = "_current", "_versions"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def pointed(spark: SparkSession, path: str) -> str | None:
    """The name of the table's version; None for a plain folder or nothing."""
    fs, pointer = _file_system(spark, f"{path.rstrip('/')}/{POINTER}")
    if not fs.exists(pointer):
        return None
    stream = fs.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def resolved(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's files now."""
    name = pointed(spark, path)
    return path if name is None else f"{path.rstrip('/')}/{VERSIONS}/{name}"


def _move_pointer(spark: SparkSession, path: str, name: str) -> None:
    """Write the pointer beside its place and rename it over the old one, in one step of the file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs, staged = _file_system(spark, f"{path}/{POINTER}-{name}")
    out = fs.create(staged, True)
    try:
        out.write(bytearray(name.encode()))
    finally:
        out.close()
    overwrite = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    overwrite[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(staged), fs.makeQualified(hadoop.Path(f"{path}/{POINTER}")), overwrite)


def _prune(spark: SparkSession, path: str, keep: set[str | None]) -> None:
    fs, folder = _file_system(spark, f"{path}/{VERSIONS}")
    for status in fs.listStatus(folder):
        if status.getPath().getName() not in keep:
            fs.delete(status.getPath(), True)


def switch(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let `write` fill a new folder, then make it the table. The version before stays; older ones and what failed
    writes left go. A failure before the pointer moves leaves the table as it was."""
    path = path.rstrip("/")
    before, name = pointed(spark, path), uuid.uuid4().hex[:12]
    write(f"{path}/{VERSIONS}/{name}")
    if pointed(spark, path) != before:
        raise RuntimeError(f"another writer switched {path} meanwhile")
    _move_pointer(spark, path, name)
    _prune(spark, path, {before, name})
