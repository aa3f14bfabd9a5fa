"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that part words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
#: Folders of intermediate tables that :func:`release` has not deleted, and whether they are recorded.
_WRITTEN: list[str] = []
_RECORDING: list[bool] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name that the driver and all executors reach.

    It lies in ``spark.checkpoint.dir``; where that is unset, in the warehouse of a local session. On a
    cluster the warehouse may be a folder of the driver's machine, so there the setting must be given.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if re.match(r"local(\[|$)", spark.conf.get("spark.master", "")) is None:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm-{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the lineage."""
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.parquet(path)
    if _RECORDING:
        _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def recorded():
    """What :func:`stored` writes meanwhile is an intermediate table that :func:`release` may delete."""
    _RECORDING.append(True)
    try:
        yield
    finally:
        _RECORDING.pop()


def release(docs: DataFrame) -> None:
    """Delete the recorded intermediate tables, but for those that ``docs`` is read from.

    For a stage of a pipeline whose documents are the stored result of the stage before it.
    """
    used = docs.inputFiles()
    names = [path.rsplit("/", 1)[-1] for path in _WRITTEN]
    gateway = docs.sparkSession.sparkContext._jvm.org.apache.hadoop.fs
    settings = docs.sparkSession.sparkContext._jsc.hadoopConfiguration()
    kept = []
    for path, name in zip(_WRITTEN, names, strict=True):
        if any(f"/{name}/" in file for file in used):
            kept.append(path)
        else:
            folder = gateway.Path(path)
            folder.getFileSystem(settings).delete(folder, True)
    _WRITTEN[:] = kept


def text_of(column: str | Column) -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """All words of a text that is not null, in order."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """All columns as one struct ``row``, so that none can clash with ``more``."""
    return df.select(F.struct(*[df[f"`{name}`"] for name in df.columns]).alias("row"), *more)
