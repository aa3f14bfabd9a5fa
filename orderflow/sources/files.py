"""File readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.constants import LISTING_COLUMNS
from orderflow.schemas import CORRUPT_COLUMN, LISTING, ORDER
from orderflow.sources.csv_ranges import read_csv_ranges

_CSV = {
    "header": "true",
    "multiLine": "true",  # phones and menus hold line breaks
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
}

#: Messages in a compressed file, about 25 MB of orders.
MESSAGES_PER_FILE = 250_000


def read_orders(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = ORDER,
    sampling_ratio: float = 1.0,
) -> DataFrame:
    """Order history, one JSON object per line.

    ``schema=None`` infers the schema with an extra pass over the input, of
    which ``sampling_ratio`` may read a part. Lines that do not parse come back
    with ``_corrupt_record`` set. A missing path is an error of the reader.
    """
    if schema is None:
        return spark.read.option("samplingRatio", sampling_ratio).json(path)
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    return (
        spark.read.schema(with_corrupt)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
    )


def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Order history with items of any shape: :func:`read_orders` with ``item_values``, the items as VARIANT.

    ``items`` holds the typed items; it is null if any item of the order is none. An item outside a list is a list of one.
    """
    fields = [T.StructField(f.name, T.VariantType()) if f.name == "items" else f for f in ORDER]
    found = read_orders(spark, path, T.StructType(fields))
    values = """coalesce(try_variant_get(items, '$', 'array<variant>'),
        if(items is null or is_variant_null(items), null, array(items)))"""
    typed = ORDER["items"].dataType.elementType
    struct = ", ".join(f"'{f.name}', try_variant_get(x, '$.{f.name}', '{f.dataType.simpleString()}')" for f in typed)
    of_type = """is_variant_null(x) or (schema_of_variant(x) like 'OBJECT%'
        and coalesce(schema_of_variant(try_variant_get(x, '$.quantity', 'variant')) in ('BIGINT', 'VOID'), true)
        and coalesce(schema_of_variant(try_variant_get(x, '$.unit_price', 'variant'))
            rlike '^(BIGINT|DECIMAL|DOUBLE|VOID)', true))"""
    found = found.withColumn("item_values", F.expr(values))
    items = f"""if(forall(item_values, x -> {of_type}),
        transform(item_values, x -> if(is_variant_null(x), null, named_struct({struct}))), null)"""
    return found.withColumn("items", F.expr(items))


def unparsed_lines(orders: DataFrame) -> int:
    """How many lines of an order history the reader could not parse."""
    if CORRUPT_COLUMN not in orders.columns:
        return 0
    # The reader refuses to be asked for that column alone.
    others = [F.count(F.col(f"`{c}`")) for c in orders.columns if c != CORRUPT_COLUMN][:1]
    return orders.agg(F.count(CORRUPT_COLUMN).alias("n"), *others).first().n


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """Restaurant listing by position: short rows are padded, long rows cut.

    Quoted line breaks keep a CSV file from being split, so each file is one
    task; :func:`read_listing_ranges` reads large files in many. Land it as Parquet
    once (:func:`orderflow.sinks.tables.land`) and work from there.
    """
    return spark.read.schema(LISTING).options(**_CSV).csv(path)


def read_listing_ranges(spark: SparkSession, path: str) -> DataFrame:
    """:func:`read_listing` by byte ranges: the same rows, a large file by many tasks."""
    return read_csv_ranges(spark, path, LISTING, _CSV)


def write_listing(listing: DataFrame, path: str) -> None:
    """The listing as CSV files that :func:`read_listing` reads back unchanged."""
    keep_blanks = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    listing.write.options(**_CSV, **keep_blanks).csv(path)


def write_messages(messages: DataFrame, path: str) -> None:
    """Messages as compressed text files, one message per line.

    A compressed file is read by one task, so a file ends after a fixed number of messages.
    """
    fast = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(MESSAGES_PER_FILE)}
    messages.select("value").write.options(**fast).text(path)


def read_listing_by_header(spark: SparkSession, path: str) -> DataFrame:
    """Restaurant listing by header name, in any column order, all text.

    Files may differ in their headers: files of one header are read together, each group by its own names.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = lines.filter(r"value rlike '[^\\r]'").select(
        F.col("_metadata.file_path").alias("file"),
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"),
        "value",
    )
    headers = placed.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups = headers.groupBy(F.rtrim("header").alias("header")).agg(F.collect_list("file").alias("files")).collect()
    found = None
    for _, files in sorted(groups):
        part = spark.read.options(**_CSV).csv(sorted(files))
        part = part.select(
            *[
                F.col(f"`{name}`") if name in part.columns else F.lit(None).cast("string").alias(name)
                for name in LISTING_COLUMNS
            ]
        )
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], LISTING) if found is None else found


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages in text files, one per line, in the shape of a broker source."""
    return spark.read.text(path).select(F.lit(None).cast("string").alias("key"), "value")
