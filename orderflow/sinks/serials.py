"""Dense numbers for rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.sinks.tables import land

_AT = (1 << 33) - 1


def with_serials(rows: DataFrame, order: list[str], name: str, folder: str, partitions: int | None = None) -> DataFrame:
    """``rows`` with a long column ``name``: 0 to n - 1 in the order of the columns ``order``, NULLs first.

    Rows are ranged by ``order`` and numbered within their range as they are written to ``folder``; the
    sizes of the ranges, one number for each of ``partitions`` (by default the number of shuffle
    partitions), give the first number of each. No task sees more than a range. The input is written
    first, so that a row has one place whatever is computed twice; rows equal in ``order`` are told apart
    by that place and split between ranges, in no defined order. An existing column of the name
    (in any case) is replaced. Without rows the result is empty.
    """
    spark = rows.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in rows.columns if c.lower() != name.lower()]
    packed = rows.select(
        F.struct(*[F.col(f"`{c}`").alias(f"o{k}") for k, c in enumerate(order)]).alias("by"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row") if kept else F.struct(F.lit(0)).alias("row"),
    )
    placed = land(packed.withColumn("place", F.monotonically_increasing_id()), f"{folder}/placed")
    ranged = placed.repartitionByRange(partitions, "by", "place").sortWithinPartitions("by", "place")
    at = F.monotonically_increasing_id()
    numbered = ranged.select("row", F.shiftright(at, 33).alias("range"), at.bitwiseAND(F.lit(_AT)).alias("at"))
    numbered = land(numbered, f"{folder}/numbered")
    # At most one row per partition.
    sizes = numbered.groupBy("range").agg(F.count(F.lit(1)).alias("n")).collect()
    start, starts = 0, []
    for size in sorted(sizes):
        starts.append((size["range"], start))
        start += size["n"]
    offsets = spark.createDataFrame(starts, "range long, start long")
    serial = (F.col("start") + F.col("at")).alias(name)
    columns = [F.col(f"row.`{c}`") for c in kept]
    return numbered.join(F.broadcast(offsets), "range").select(serial, *columns)
