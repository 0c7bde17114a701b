"""Surveys as a stream: deduplicated arrival, window volumes, running cluster figures."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from surveyloom.operators.quality import window_volume


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
Trigger = Mapping[str, object]
ALL_THERE: Trigger = {"availableNow": True}


@contextmanager
def state_settings(spark: SparkSession, partitions: int | None, timers: bool = False) -> Iterator[None]:
    """Start streams with this number of state partitions, and with a state store that has timers.

    A stream keeps the number it was first started with, whatever the session says later,
    and each partition costs a state store per operator; so it is chosen per stream.
    """
    wanted = {}
    if partitions is not None:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    if timers:
        wanted["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
    before = {key: spark.conf.get(key) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def arrivals(
    stream: DataFrame, keys: Sequence[str] = ("survey_h_hid",), ts: str = "ts", delay: str = "1 day"
) -> DataFrame:
    """Drop repeats of a survey that arrive within `delay` of the first."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_volume(stream: DataFrame, ts: str = "ts", width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Volume per tumbling window and category; rows later than `delay` are cut."""
    return window_volume(stream.withWatermark(ts, delay), ts, width)


def start_table(
    stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None, timers: bool = False, trigger: Trigger = ALL_THERE
) -> StreamingQuery:
    """Append a stream to a parquet table.

    `trigger` is as for `DataStreamWriter.trigger`; by default the stream takes what is there and stops. `timers` is for operators with
    timers of their own, such as `deadlines`.
    """
    with state_settings(stream.sparkSession, partitions, timers):
        return (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start(path)
        )


def start_deltas(
    stream: DataFrame, fold: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, trigger: Trigger = ALL_THERE
) -> StreamingQuery:
    """Fold each micro-batch and keep the result under its batch number.

    A batch that runs again overwrites its own directory, so a replay changes nothing,
    and a batch never rewrites what earlier ones left. `current` adds the parts up.
    """

    def write(batch: DataFrame, number: int) -> None:
        fold(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def fold_clusters(batch: DataFrame) -> DataFrame:
    """Per cluster what a batch adds: sums, counts and extremes, which can be added again."""
    return batch.groupBy("cluster_id").agg(
        F.count("*").alias("volume"),
        F.sum("confidence").alias("confidence_sum"),
        F.max("severity").alias("severity"),
        F.min("ts").alias("first_seen"),
        F.max("ts").alias("last_seen"),
    )


def current_clusters(spark: SparkSession, path: str) -> DataFrame:
    """Cluster figures over all batches so far."""
    return (
        spark.read.parquet(path)
        .groupBy("cluster_id")
        .agg(
            F.sum("volume").alias("volume"),
            F.round(F.sum("confidence_sum") / F.sum("volume"), 6).alias("mean_confidence"),
            F.max("severity").alias("severity"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
    )


def start_upsert(
    stream: DataFrame, keys: Sequence[str], order_by: str, path: str, checkpoint: str, trigger: Trigger = ALL_THERE
) -> StreamingQuery:
    """Upsert each micro-batch into a table, the latest row per key winning.

    Rewrites the table per batch; meant for small keyed tables such as cluster states.
    """
    from surveyloom.sources.tables import upsert_table

    def write(batch: DataFrame, number: int) -> None:
        upsert_table(
            batch.sparkSession, path, batch, keys, on_duplicate="latest", order_by=order_by
        )

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
