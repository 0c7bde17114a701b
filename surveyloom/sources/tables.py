"""Reading named sources and writing result tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveyloom.operators.merging import replace_by_key, upsert
from surveyloom.session import new_folder, remove_folder, scratch
from surveyloom.sources.versions import pointed, resolved, switch

TRANSLATIONS = T.StructType(
    [
        T.StructField("survey_h_hid", T.StringType()),
        T.StructField("invitation_date", T.TimestampType()),
        T.StructField("comment", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("result", T.StringType()),
        T.StructField("translated_comment", T.StringType()),
    ]
)

CATEGORIES = T.StructType(
    [
        T.StructField("survey_h_hid", T.StringType()),
        T.StructField("invitation_date", T.TimestampType()),
        T.StructField("comment", T.StringType()),
        T.StructField("comment_category", T.StringType()),
    ]
)


class Sources:
    """Named inputs: a parquet path, a catalog table (`table:name`), a DataFrame, or a
    function that makes one when it is asked for."""

    def __init__(
        self, spark: SparkSession, tables: Mapping[str, str | DataFrame | Callable[[], DataFrame]]
    ):
        self.spark = spark
        self.tables = dict(tables)

    def read(self, name: str) -> DataFrame:
        try:
            source = self.tables[name]
        except KeyError:
            raise KeyError(f"no source named {name!r}; known: {sorted(self.tables)}") from None
        if isinstance(source, DataFrame):
            return source
        if callable(source):
            return source()
        if source.startswith("table:"):
            return self.spark.table(source.removeprefix("table:"))
        return read_table(self.spark, source)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table by its path, plain or with versions."""
    return spark.read.parquet(resolved(spark, path))


def table_exists(spark: SparkSession, path: str) -> bool:
    """True if the path holds a readable table."""
    try:
        read_table(spark, path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return False
        raise
    return True


def ensure_table(spark: SparkSession, path: str, schema: T.StructType, versioned: bool = False) -> None:
    """Create an empty table with a declared schema unless one is there.

    With `versioned` every rewrite of the table goes to a new folder, and readers go by `read_table`; see
    `surveyloom.sources.versions`. All functions here follow the table that they find.
    """
    empty = spark.createDataFrame([], schema).write
    if not versioned:
        empty.mode("ignore").parquet(path)
    elif not table_exists(spark, path):
        switch(spark, path, empty.parquet)


def _overwrite(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Fill a new version where the table has versions, else the folder itself."""
    if pointed(spark, path) is None:
        write(path)
    else:
        switch(spark, path, write)


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Create or replace a table. `df` must not read from `path`; see `rewrite_table`."""
    if partition_by:
        write_partitioned(df, path, *partition_by)
    else:
        _overwrite(df.sparkSession, path, df.write.mode("overwrite").parquet)


def rewrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table by a frame that reads the table itself.

    A table with versions gets a new one, written once. For a plain folder the new content
    is written out in the shared folder before the old is touched; the copy goes when the
    table is complete, and a failure while the table is written leaves it.
    """
    spark = df.sparkSession
    if pointed(spark, path) is not None:
        replace_table(df, path, partition_by)
        return
    staged = new_folder(spark, "staged")
    df.write.parquet(staged)
    replace_table(spark.read.schema(df.schema).parquet(staged), path, partition_by)
    remove_folder(spark, staged)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    path = resolved(df.sparkSession, path)
    if partition_by:
        gathered(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("append").parquet(path)


def gathered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring equal values together before a partitioned write, so that not every task opens
    a file for every value. Adaptive execution splits a value that holds too many rows."""
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """One directory per value."""
    _overwrite(df.sparkSession, path, gathered(df, columns).write.mode("overwrite").partitionBy(*columns).parquet)


def write_clustered(df: DataFrame, path: str, *columns: str) -> None:
    """Range-partitioned and sorted files, so readers can skip row groups on `columns`.

    The clustering columns have few values; the rest of the sort key is a hash of the row,
    which lets a value that holds a large share of the rows spread over many files.
    """
    spread = F.xxhash64(*df.columns)
    ranged = df.repartitionByRange(*columns, spread)
    _overwrite(df.sparkSession, path, ranged.sortWithinPartitions(*columns).write.mode("overwrite").parquet)


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], **policy) -> None:
    """Keyed upsert into a parquet table that may not exist yet; rewrites the table, see `rewrite_table`.

    For large tables partition by a column of the key and use `upsert_periods`. The source
    is computed once, as it may hold model calls.
    """
    with scratch(source, "source") as rows:
        target = read_table(spark, path) if table_exists(spark, path) else spark.createDataFrame([], rows.schema)
        rewrite_table(upsert(target, rows, keys, **policy), path)


def _in_periods(target: DataFrame, batch: DataFrame, period: Sequence[str]) -> DataFrame:
    """Target rows in the periods of the batch, null equal to null.

    The periods are a subquery's one array, no longer than the list of directories the
    planner holds anyway. The test reads partition columns only, so it picks the
    directories to read, with one plan for any number of periods.
    """
    one = F.struct(*period)
    periods = batch.select(one.alias("p")).groupBy().agg(F.collect_set("p").alias("p"))
    return target.filter(F.array_contains(periods.scalar(), one))


def _rewrite_periods(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    period: Sequence[str],
    merge: Callable[[DataFrame, DataFrame], DataFrame],
) -> None:
    """Merge a batch into a table partitioned by `period`, reading and writing only the
    batch's partitions.

    The batch is written out first, as it is read several times. A dynamic partition
    overwrite drops the old files only when the new ones are complete. A batch whose columns
    aren't the table's is refused, as the rewritten periods would lose the others.
    """
    if not set(period) <= set(keys):
        raise ValueError("the period columns must be part of the key")
    path = resolved(spark, path)
    with scratch(batch, "batch") as rows:
        content = rows
        if table_exists(spark, path):
            columns = spark.read.parquet(path).columns
            if set(columns) != set(rows.columns):
                raise ValueError(f"the table has the columns {sorted(columns)}, the batch {sorted(rows.columns)}")
            target = spark.read.schema(rows.schema).parquet(path).select(*rows.columns)
            content = merge(_in_periods(target, rows, period), rows)
        (
            gathered(content, period)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*period)
            .parquet(path)
        )


def upsert_periods(
    spark: SparkSession, path: str, source: DataFrame, keys: Sequence[str], period: Sequence[str], **policy
) -> None:
    """Keyed upsert in a table partitioned by `period`, which is part of `keys`."""
    merge = lambda target, batch: upsert(target, batch, keys, **policy)
    _rewrite_periods(spark, path, source, keys, period, merge)


def replace_periods(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], period: Sequence[str]
) -> None:
    """Replace-by-key in a table partitioned by `period`, which is part of `keys`."""
    merge = lambda target, batch: replace_by_key(target, batch, keys)
    _rewrite_periods(spark, path, batch, keys, period, merge)


def drop_scratch(spark: SparkSession, table: str, if_exists: bool = False) -> None:
    """Drop a scratch table of the catalog; a missing table is an error unless asked."""
    spark.sql(f"DROP TABLE {'IF EXISTS ' if if_exists else ''}{table}")
