"""Table output: landing, all-or-nothing loads, publishing."""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from orderflow import schemas
from orderflow.constants import CITY_COLUMN, TYPE_COLUMN
from orderflow.operators import normalize
from orderflow.sinks import keyindex
from orderflow.sinks.claims import create_new

TABLES = {
    "locations": ("location_id", schemas.LOCATIONS),
    "restaurants": ("restaurant_id", schemas.RESTAURANTS),
    "metrics": ("metric_id", schemas.METRICS),
}
_PUBLISHED = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("compacted", T.BooleanType()),
        T.StructField("counted", T.BooleanType()),
    ]
)
#: Beside the columns of a table, in its files: for the first new row of those that are equal, how many of them
#: were known and how many are new. The index is made from them.
_COUNTS = T.StructType([T.StructField("known_copies", T.LongType()), T.StructField("copies", T.LongType())])
#: Columns that tell a metric from another, as the listing has them: none is cleaned on the way.
_SLICED_BY = ("name", "address", "location", CITY_COLUMN, "rest_type", "cuisines", "menu_item", TYPE_COLUMN)
#: Ids of 32 hex digits.
_IDS = ("location_id", "restaurant_id", "metric_id")
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleaning: dict[SparkSession, list] = {}
_lock = threading.Lock()


def land(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Replace the table at ``path`` and return it as written."""
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the shuffle files of an execution go when it ends, not when the driver next collects garbage.

    For steps that each write a table: the disk then holds the tables and the shuffles of one step.
    """
    with _lock:
        before = _cleaning.setdefault(spark, [0, spark.conf.get(_CLEANUP, None)])
        before[0] += 1
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            before[0] -= 1
            if not before[0]:
                del _cleaning[spark]
                spark.conf.set(_CLEANUP, before[1]) if before[1] is not None else spark.conf.unset(_CLEANUP)


def published_log(spark: SparkSession, root: str) -> list[Row]:
    """The completed loads in the order of their publication; one short record per load.

    Records of earlier versions of this package have a ``run_id`` only, and come first.
    """
    try:
        found = spark.read.schema(_PUBLISHED).json(f"{root}/published").distinct().collect()
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted(found, key=lambda row: (row.version or 0, row.run_id))


def published_runs(spark: SparkSession, root: str) -> list[str]:
    """Ids of the loads that completed."""
    return sorted(row.run_id for row in published_log(spark, root))


def _folder(root: str, row: Row) -> str:
    return f"{root}/{row.folder or f'run={row.run_id}'}"


def _rows_of(spark: SparkSession, root: str, table: str, log: list[Row]) -> DataFrame:
    schema = TABLES[table][1]
    if not log:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{_folder(root, row)}/{table}" for row in log])


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table as of its published loads."""
    return _rows_of(spark, root, table, published_log(spark, root))


@dataclass(frozen=True)
class LoadResult:
    run_id: str
    rows: dict[str, int]


def load_listing(
    staging: DataFrame,
    root: str,
    run_id: str,
    match: str = "venue",
    buckets: int | None = None,
    compact_after: int = 8,
    slice_rows: int = 128_000_000,
) -> LoadResult:
    """Normalise a landed listing and add what is new to the three tables.

    Every load writes only its new rows, to a folder of its own, and the keys
    of these rows to an index in ``buckets`` hash buckets, in which the next
    loads look for their own keys. The first load sets their number, by default
    the number of shuffle partitions. Every ``compact_after`` loads the index is
    written anew as a whole, so a load reads at most that many. Readers look at
    published loads only, and publishing, one small file, comes last: a load
    that fails halfway leaves nothing to see and can be repeated under its
    ``run_id``; its folder may be deleted. Loading the same listing twice adds
    nothing. Row counts are taken while writing.

    Metrics are added in slices of about ``slice_rows`` listing rows, told apart
    by a hash of what they say, and shuffle files go with the step that wrote
    them: so many rows are on the move at a time, however long the listing. Every
    slice reads the listing, so it should be stored.

    Loads may run at once. Publishing creates the file of the next version,
    which only one of them can; the others start again from the tables that
    include it, so a new row is published once.
    """
    spark = staging.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    while True:
        log = published_log(spark, root)
        if any(row.run_id == run_id for row in log):
            raise ValueError(f"run {run_id!r} is already published")
        width = next((row.buckets for row in reversed(log) if row.buckets), buckets)
        chain = keyindex.chain(log)
        record = {
            "run_id": run_id,
            "version": 1 + max((row.version or 0 for row in log), default=0),
            "folder": f"run={run_id}/{uuid.uuid4().hex}",
            "buckets": width,
            "compacted": len(chain) >= compact_after,
            "counted": True,
        }
        with shuffles_released(spark):
            counts = _write_new(staging, root, log, record, match, slice_rows)
        if create_new(spark, f"{root}/published/v{record['version']:012d}.json", json.dumps(record) + "\n"):
            return LoadResult(run_id, counts)


def _base_key(table: str) -> Column:
    """The key that equal rows have in common; the rows of a table have keys of their own."""
    return normalize.metric_id() if table == "metrics" else F.col(TABLES[table][0])


def _slices(staging: DataFrame, parts: int) -> list[DataFrame]:
    """Parts of a listing, rows that may become equal metrics in the same one."""
    if parts < 2:
        return [staging]
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in _SLICED_BY]), F.lit(parts))
    return [staging.filter(part == k) for k in range(parts)]


def _write_new(
    staging: DataFrame, root: str, log: list[Row], record: dict, match: str, slice_rows: int
) -> dict[str, int]:
    """Write the rows that the published loads lack, and the index of their keys; rows per table."""
    spark, width = staging.sparkSession, record["buckets"]
    chain = keyindex.chain(log)
    bare = [row for row in log if not row.counted] if not any(row.compacted for row in chain) else []
    counts = dict.fromkeys(TABLES, 0)

    def known_keys(table: str) -> list[DataFrame]:
        """Published keys with their numbers of copies; no key twice in one of the tables."""
        known = [index.read(f"{_folder(root, row)}/keys/{table}", width) for row in chain]
        if bare:
            # Rows of earlier versions; copies may have the key of the first or keys of their own.
            keys = _rows_of(spark, root, table, bare).select(_base_key(table).alias("key"))
            known.append(keys.groupBy("key").agg(F.count(F.lit(1)).alias("copies")))
        return known

    def append(table: str, rows: DataFrame, spread: bool = False) -> None:
        """Add the new ones of rows that come ``_copies`` times; equal rows must be in one call.

        With ``spread`` equal rows may have many copies, and their number may come in pieces.
        """
        key, schema = TABLES[table]
        names = schema.fieldNames()
        fresh = keyindex.dealt_by_key(rows.select(*names, "_copies"), width, key, ids=_IDS)
        if spread or bare:
            # Tables of earlier versions may hold a restaurant twice, and its metrics then come twice.
            fresh = fresh.groupBy(*names).agg(F.sum("_copies").alias("_copies"))
        fresh = fresh.withColumn("_known", F.lit(0).cast("long"))
        for known in known_keys(table):
            held = known.select(F.col("key").alias(key), F.col("copies").alias("_held"))
            fresh = fresh.join(held, key, "left").withColumn("_known", F.col("_known") + F.coalesce("_held", F.lit(0)))
            fresh = fresh.drop("_held")
        runs = normalize.runs_of_copies(fresh, "_copies", "_known")
        if spread:
            # Copies of a hot row are laid out, and written, by many tasks.
            runs = runs.repartition(width, key, "_run")
        laid = normalize.laid_out(runs, key, "_copies", "_known")
        first = F.col("_copy") == F.col("_known")
        added = (F.when(first, F.col("_known")), F.when(first, F.col("_copies") - F.col("_known")))
        added = laid.select(*names, *[c.alias(f.name) for c, f in zip(added, _COUNTS, strict=True)])
        seen = Observation(table)
        written = added.observe(seen, F.count(F.lit(1)).alias("rows"))
        written.write.mode("append").parquet(path_of(table), compression="zstd")
        counts[table] += seen.get["rows"]

    def path_of(table: str) -> str:
        return f"{root}/{record['folder']}/{table}"

    def finish(table: str) -> DataFrame:
        """Write the index of the rows added; the table with them."""
        key, schema = TABLES[table]
        firsts = spark.read.schema(T.StructType([*schema, *_COUNTS])).parquet(path_of(table)).filter("copies > 0")
        own = F.when(F.col("known_copies") == 0, F.col(key)).otherwise(_base_key(table))
        keys = firsts.select(own.alias("key"), "copies")
        if record["compacted"]:
            for known in known_keys(table):
                keys = keys.unionByName(known)
            keys = keys.groupBy("key").agg(F.sum("copies").alias("copies"))
        index.write(keys, f"{root}/{record['folder']}/keys/{table}", width)
        return _rows_of(spark, root, table, log).unionByName(spark.read.schema(schema).parquet(path_of(table)))

    def add(table: str, rows: DataFrame) -> DataFrame:
        append(table, rows.withColumn("_copies", F.lit(1).cast("long")))
        return finish(table)

    with keyindex.Index(spark) as index:
        keys = land(normalize.listing_keys(staging, "_copies"), f"{root}/{record['folder']}/listing_keys", "zstd")
        locations = add("locations", normalize.locations(keys))
        restaurants = add("restaurants", normalize.restaurants(keys, locations))
        hot = normalize.hot_venues(keys, "_copies") if match == "venue" else None
        spread = hot is None or not hot.isEmpty()
        listed = keys.agg(F.sum("_copies")).first()[0] or 0
        for part in _slices(staging, -(-listed // slice_rows)):
            rows = normalize.metrics(part, restaurants, match, dealt=True, hot=hot, copies="_copies")
            append("metrics", rows, spread)
        finish("metrics")
    return counts
