"""Quoted multi-line CSV read in parallel, also within one file.

A line break inside quotes is no record end, so a reader that starts in the middle of a file can't tell where the
next record begins, and Spark reads such a file in one task. Whether a place is inside quotes follows from the
parity of the quotes before it. So the file is read twice, and not more often, as physical lines, which Spark splits
into byte ranges; a task takes several ranges if they are small:

1. every range counts its quotes; the parities of the ranges before it, a row per range, are combined into the
   parity at its start;
2. every range joins its lines into records, from the first record end to the last; what is left at its two
   ends, a piece of one record each, meets the pieces of its neighbours by range.

What comes out is stored (see :func:`~orderflow.sinks.workspace.workspace`), since it is used more than once.
Records are then parsed by Spark's own CSV expression, with the options of the whole-file reader.

The parity holds for files whose quotes stand around whole fields and are doubled inside them, as every CSV writer has
them. A file with a record of another kind (a bare quote within a field, an open quote at the end) is read by the
whole-file reader instead, so the rows are the same for any file.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.sinks.workspace import workspace

# Tasks get the code below with the job, wherever the package lies.
register_pickle_by_value(sys.modules[__name__])

#: Fields that are quoted as a whole, or hold no quote; possessive, so that long fields need no stack.
_SOUND = r'(?s)\A(?:"(?:[^"]++|"")*+"|[^",]*+)(?:,(?:"(?:[^"]++|"")*+"|[^",]*+))*+\z'
#: Ranges whose start parities may be sent to all tasks; with more of them the lines are sorted by range.
BROADCAST_RANGES = 200_000
#: Ranges that a task takes at most, beyond four tasks per core.
RANGES_PER_TASK = 128

_PIECES = "file string, begin long, place int, kind string, record string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, value): physical lines, by file and the first byte of their range, in order within a range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value"
    )


def range_parities(lines: DataFrame) -> DataFrame:
    """(file, begin, inside): 1 for ranges that start inside quotes."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "begin").agg(F.sum(quotes).alias("quotes"))
    before = W.partitionBy("file").orderBy("begin").rowsBetween(W.unboundedPreceding, -1)
    return counted.select(
        "file", "begin", F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2)).cast("int").alias("inside")
    )


class _Range:
    """The lines of one range, joined into records as they come."""

    def __init__(self, file: str, begin: int, inside: int):
        self.file, self.begin = file, begin
        self.inside = inside
        self.open: list[str] = []  # lines of the record that has not ended
        self.started = not inside  # whether that record began in this range
        self.place = 0
        self.out: list[tuple] = []

    def add(self, lines: pa.Array) -> None:
        """Lines are joined up to where the parity of the quotes so far is even."""
        parity = (self.inside + np.cumsum(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False))) % 2
        ends = np.flatnonzero(parity == 0)
        values, begin = lines.to_pylist(), 0
        for end in ends.tolist():
            text = values[end] if end == begin and not self.open else "\n".join([*self.open, *values[begin : end + 1]])
            if text.rstrip("\r") or not self.started:  # blank lines are no records
                self.out.append((self.file, self.begin, self.place, "record" if self.started else "head", text))
                self.place += 1
            self.started, self.open, begin = True, [], end + 1
        self.open += values[begin:]
        if len(parity):
            self.inside = int(parity[-1])

    def close(self) -> None:
        """What is left began here and goes on in the next range, or goes through this one as a whole."""
        if self.open:
            kind = "tail" if self.started else "middle"
            self.out.append((self.file, self.begin, self.place, kind, "\n".join(self.open)))
            self.open = []

    def taken(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        names = ("file", "begin", "place", "kind", "record")
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], list(names))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own: _Range | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        begins = batch.column("begin").to_numpy(zero_copy_only=False)
        files = batch.column("file").dictionary_encode()
        codes = files.indices.to_numpy(zero_copy_only=False)
        cuts = 1 + np.flatnonzero((begins[1:] != begins[:-1]) | (codes[1:] != codes[:-1]))
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(begins)], strict=True):
            key = (files.dictionary[int(codes[a])].as_py(), int(begins[a]))
            if own is None or (own.file, own.begin) != key:
                if own is not None:
                    own.close()
                    yield own.taken()
                own = _Range(*key, int(batch.column("inside")[a].as_py()))
            own.add(batch.column("value")[a:b])
            yield own.taken()
    if own is not None:
        own.close()
        yield own.taken()


def _stored(df: DataFrame, purpose: str) -> DataFrame:
    path = workspace(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, begin, place, record): the records of all files, in no order; header records are among them."""
    lines = _lines(spark, path)
    # Ranges of a task are read one after the other, each under its own first byte.
    splits = lines.rdd.getNumPartitions()
    lines = lines.coalesce(max(1, -(-splits // RANGES_PER_TASK), min(splits, 4 * spark.sparkContext.defaultParallelism)))
    parities = _stored(range_parities(lines), "csv-parities")
    ranges = parities.count()
    if ranges <= BROADCAST_RANGES:
        known = lines.join(F.broadcast(parities), ["file", "begin"])
    else:
        placed = lines.withColumn("line", F.monotonically_increasing_id()).join(parities, ["file", "begin"])
        known = placed.repartition("file", "begin").sortWithinPartitions("file", "begin", "line")
    found = known.select("file", "begin", "inside", "value").mapInArrow(_joined, _PIECES)
    found = _stored(found, "csv-records")
    whole = found.filter("kind = 'record'").select("file", "begin", "place", "record")
    # A tail, and the pieces up to the next one, are one record; there are two pieces per range at most.
    upto = W.partitionBy("file").orderBy("begin", "place")
    pieces = found.filter("kind <> 'record'").withColumn("group", F.sum(F.when(F.col("kind") == "tail", 1).otherwise(0)).over(upto))
    parts = F.array_sort(F.collect_list(F.struct("begin", "place", "record")))
    stitched = pieces.groupBy("file", "group").agg(parts.alias("parts")).select(
        "file",
        F.col("parts")[0]["begin"].alias("begin"),
        F.col("parts")[0]["place"].alias("place"),
        F.array_join(F.expr("transform(parts, p -> p.record)"), "\n").alias("record"),
    )
    return whole.unionByName(stitched)


def read_csv_ranges(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """The rows that ``spark.read.schema(schema).options(**options).csv(path)`` gives, read by byte ranges.

    For comma-separated UTF-8 files with a header each and double quotes.
    """
    found = records(spark, path)
    # Windows line ends: before a record's end they belong to it, inside quotes the reader makes them plain.
    text = F.regexp_replace(F.regexp_replace("record", "\r\n", "\n"), "\r$", "")
    found = found.select("file", "begin", "place", text.alias("record"))
    odd = found.filter(~F.col("record").rlike(_SOUND)).select("file").distinct()
    wrong = [row.file for row in odd.collect()]
    body = found.filter("not (begin = 0 and place = 0)")
    if wrong:
        body = body.filter(~F.col("file").isin(wrong))
    row = F.from_csv("record", _ddl(schema), _expression(options))
    rows = body.select(row.alias("row")).select("row.*")
    if not wrong:
        return rows
    return rows.unionByName(spark.read.schema(schema).options(**options).csv(wrong))


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _expression(options: dict[str, str]) -> dict[str, str]:
    """The options that a single record takes."""
    return {k: v for k, v in options.items() if k not in ("header", "multiLine", "encoding")}
