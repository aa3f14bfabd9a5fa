"""Streaming readers. All deliver ``key`` and ``value`` as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.schemas import MESSAGE


def kafka_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    **options: str,
) -> DataFrame:
    """Messages of a Kafka topic; the connector must be on the class path.

    The position in the topic is kept in the checkpoint of the query that
    reads it; ``starting_offsets`` counts on the first start only.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    loaded = reader.options(**options).load()
    return loaded.select(F.col("key").cast("string"), F.col("value").cast("string"))


def text_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages in text files that arrive in a directory, one per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select(F.lit(None).cast("string").alias("key"), "value")


def valid_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The valid messages of a validator's output folder.

    The root of the output is read, where the sink's commit log lies.
    """
    reader = spark.readStream.schema("key string, value string, route string")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path).filter("route = 'valid'").select("key", "value")


def is_routed(spark: SparkSession, path: str) -> bool:
    """Whether a folder is a validator's output: it holds folders of routes."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/route=*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return found is not None and len(found) > 0


def parquet_messages(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Messages in Parquet files with ``key`` and ``value``."""
    reader = spark.readStream.schema(MESSAGE)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
