"""Streaming writers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def _trigger(writer: DataStreamWriter, available_now: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if available_now else writer


def kafka_output(
    messages: DataFrame,
    servers: str,
    checkpoint: str,
    topic: str | None = None,
    mode: str = "append",
    available_now: bool = False,
) -> DataStreamWriter:
    """Messages to Kafka; without ``topic``, each goes where its ``topic`` column says."""
    writer = (
        messages.writeStream.format("kafka")
        .outputMode(mode)
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )
    if topic is not None:
        writer = writer.option("topic", topic)
    return _trigger(writer, available_now)


def file_output(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: str,
    available_now: bool = False,
) -> DataStreamWriter:
    """Messages to Parquet, one folder per value of ``partition_by``, exactly once."""
    writer = (
        messages.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(partition_by)
        .option("compression", "zstd")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, available_now)


def update_output(
    updates: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> DataStreamWriter:
    """Updates of an aggregation to Parquet, one folder per micro-batch.

    A micro-batch that is repeated after a failure overwrites its own folder.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    writer = (
        updates.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, available_now)


def update_outputs(
    updates: DataFrame,
    path: str,
    checkpoint: str,
    also: Callable[[DataFrame, int], None],
    available_now: bool = False,
) -> DataStreamWriter:
    """:func:`update_output` and a second output of the same query: the source is read and aggregated once.

    The batch is kept while both are written. Its files are written last: a micro-batch that failed before is
    repeated as a whole, so ``also`` gets the same batch under the same id again and must overwrite by id.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            also(batch, batch_id)
            batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    writer = (
        updates.writeStream.outputMode("update")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
    )
    return _trigger(writer, available_now)


def to_console(messages: Callable[[DataFrame], DataFrame], rows: int = 20) -> Callable[[DataFrame, int], None]:
    """A second output for :func:`update_outputs` that shows each batch on the driver's console."""

    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        messages(batch).show(rows, truncate=False)

    return show


def console_output(messages: DataFrame, mode: str = "update") -> DataStreamWriter:
    """Messages on the driver's console. A second query: it repeats all the work."""
    return messages.writeStream.format("console").outputMode(mode).option("truncate", "false")


def topic_of(route: Column, topics: dict[str, str]) -> Column:
    """The topic of each route."""
    topic = F.lit(None).cast("string")
    for name, target in topics.items():
        topic = F.when(route == name, F.lit(target)).otherwise(topic)
    return topic
