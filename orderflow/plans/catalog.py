"""The registered queries.

Each takes a session and a folder of sample tables and returns a DataFrame of
plain columns: decimals become doubles and lists become text on the way out.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.constants import CITY_COLUMN
from orderflow.operators import audit, dimension, fraud, history, items, normalize, validate
from orderflow.plans import restaurant_reports as reports
from orderflow.sinks import serials
from orderflow.sinks.streams import file_output, update_output
from orderflow.sinks.tables import TABLES, land, load_listing, read_table, shuffles_released
from orderflow.sinks.workspace import workspace
from orderflow.sources import files, sample_tables, streams
from orderflow.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that give rows on the sample tables.
SAMPLE_WINDOWS = fraud.Windows("30 minutes", "10 minutes", "60 minutes", "20 minutes", threshold=2)
SAMPLE_MIN_RATING = Decimal("3.95")
SAMPLE_MIN_RESTAURANTS = 3


def plain(df: DataFrame) -> DataFrame:
    """Types that any engine compares alike."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.ArrayType):
            column = F.array_join(column, "|")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.unix_seconds(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


# --- inputs ------------------------------------------------------------------


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_tables.orders(spark, sf_dir)


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return items.resolve_items(sample_tables.orders(spark, sf_dir))


def _timed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sample_tables.table(spark, sf_dir, "events")
    return fraud.with_event_time(sample_tables.event_orders(events))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.check_messages(sample_tables.order_messages(spark, sf_dir))


def _listing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = normalize.listing_keys(sample_tables.listing(spark, sf_dir))
    return land(keys, workspace(spark, "listing-keys"))


def _restaurant_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Metrics, restaurants and locations of the listing."""
    keys = _listing_keys(spark, sf_dir)
    restaurant_table = normalize.restaurants(keys)
    staging = sample_tables.listing(spark, sf_dir)
    return (
        normalize.metrics(staging, restaurant_table),
        restaurant_table,
        normalize.locations(keys),
    )


def _dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.restaurant_dimension(sample_tables.listing(spark, sf_dir))


# --- queries -----------------------------------------------------------------


def orders_json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages written as JSON lines and read back with the order schema."""
    path = workspace(spark, "orders-json")
    files.write_messages(sample_tables.order_messages(spark, sf_dir), path)
    found = files.read_orders(spark, path)
    return found.select(
        "order_id",
        "restaurant_id",
        "restaurant_city",
        "request_online",
        "order_price",
        F.array_size("items").alias("item_count"),
        F.col("_corrupt_record").isNotNull().alias("is_corrupt"),
    )


def items_exploded(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = sample_tables.orders(spark, sf_dir)
    return items.explode_items(orders).select("order_id", "item.*")


def items_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _items(spark, sf_dir).select("order_id", "item_name", "item_quantity")


def staging_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing written as CSV, read back and landed as Parquet."""
    path = workspace(spark, "listing-csv")
    files.write_listing(sample_tables.listing(spark, sf_dir), path)
    return land(files.read_listing(spark, path), workspace(spark, "staging"))


def csv_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing written as CSV, a file per task, and read by byte ranges of 1 MB."""
    path = workspace(spark, "listing-csv")
    files.write_listing(sample_tables.listing(spark, sf_dir), path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    try:
        found = files.read_listing_ranges(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return land(found, workspace(spark, "ranges"))


def normalize_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.locations(sample_tables.listing(spark, sf_dir))


def normalize_restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _listing_keys(spark, sf_dir)
    location_table = normalize.locations(keys)
    return normalize.restaurants(keys, location_table).join(location_table, "location_id")


def normalize_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _restaurant_tables(spark, sf_dir)[0]


def normalize_metrics_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.metrics(sample_tables.listing(spark, sf_dir), match="exact")


def locations_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations of the listing, added to those known from suppliers in debt."""
    known = (
        sample_tables.table(spark, sf_dir, "supplier")
        .filter("s_acctbal < 0")
        .join(sample_tables.table(spark, sf_dir, "nation"), F.expr("s_nationkey = n_nationkey"))
        .join(sample_tables.table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"))
        .select(F.col("n_name").alias("location"), F.col("r_name").alias(CITY_COLUMN))
    )
    target = normalize.locations(known).withColumn("is_new", F.lit(False))
    found = normalize.locations(sample_tables.listing(spark, sf_dir))
    return normalize.upsert_ignore(found.withColumn("is_new", F.lit(True)), target, "location_id")


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.load_audit(sample_tables.listing(spark, sf_dir))


def normalize_metrics_dealt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the landed listing, rows of large venues in many tasks."""
    staging = land(sample_tables.listing(spark, sf_dir), workspace(spark, "staging"))
    return normalize.metrics(staging, normalize.restaurants(staging), dealt=True)


def load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two loads add: the listing, then every row of it twice."""
    root = workspace(spark, "loads")
    with shuffles_released(spark):
        staging = land(sample_tables.listing(spark, sf_dir), workspace(spark, "staging"), "zstd")
    loads = {"first": staging, "second": staging.unionByName(staging)}
    added = {name: load_listing(rows, root, name).rows for name, rows in loads.items()}
    counts = []
    for table, (key, _) in TABLES.items():
        # Keys are hex digits.
        seen = read_table(spark, root, table).groupBy(F.unhex(key)).agg(F.count(F.lit(1)).alias("n"))
        counts.append(
            seen.agg(F.count(F.lit(1)).alias("key_count"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count")).select(
                F.lit(table).alias("table_name"),
                *[F.lit(added[name][table]).cast("long").alias(f"{name}_load") for name in loads],
                "key_count",
                "row_count",
            )
        )
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def restaurant_serials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distinct restaurants of the listing, numbered from 0 in the order of their naming columns."""
    keys = _listing_keys(spark, sf_dir)
    return serials.with_serials(keys, keys.columns, "restaurant_no", workspace(spark, "serials"))


def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys after suppliers in debt and one region were taken away."""
    metric_table, restaurant_table, location_table = _restaurant_tables(spark, sf_dir)
    in_debt = (
        sample_tables.table(spark, sf_dir, "supplier")
        .filter("s_acctbal < 0")
        .select(F.col("s_name").alias("name"))
    )
    kept_restaurants = restaurant_table.join(in_debt, "name", "left_anti")
    kept_locations = location_table.filter(F.col("listed_in_city") != "ASIA")
    return audit.fk_orphans(metric_table, kept_restaurants, kept_locations)


def top_neighborhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.top_neighborhoods(
        *_restaurant_tables(spark, sf_dir), SAMPLE_MIN_RATING, SAMPLE_MIN_RESTAURANTS
    )


def validate_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = validate.routed_messages(_checked(spark, sf_dir))
    return routed.filter(F.col("route") == validate.VALID).select("key", "value")


def validate_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = validate.routed_messages(_checked(spark, sf_dir))
    return routed.filter(F.col("route") == validate.ERROR).select("key", "value")


def validate_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = _checked(spark, sf_dir)
    return checked.filter(F.col("route") == validate.MALFORMED).select("reason", "value")


def validate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City revenue of the valid orders only."""
    orders = sample_tables.orders(spark, sf_dir)
    return history.city_revenue(validate.only_valid(orders))


def validate_stream_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages routed by one streaming query, counted per route."""
    source = workspace(spark, "messages")
    files.write_messages(sample_tables.order_messages(spark, sf_dir), source)
    routed = jobs.route_orders(streams.text_messages(spark, source))
    path = workspace(spark, "routed")
    run = file_output(routed, path, workspace(spark, "routed-checkpoint"), "route", True).start()
    run.awaitTermination()
    return (
        spark.read.schema("key string, value string, route string")
        .parquet(path)
        .groupBy("route")
        .agg(
            F.count(F.lit(1)).alias("message_count"),
            F.count("key").alias("key_count"),
            F.sum(F.length("value")).alias("value_length"),
        )
    )


def geo_impossible(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = SAMPLE_WINDOWS
    return fraud.geo_impossible(_timed_orders(spark, sf_dir), w.geo_size, w.geo_slide)


def velocity_spam(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = SAMPLE_WINDOWS
    return fraud.velocity_spam(
        _timed_orders(spark, sf_dir), w.velocity_size, w.velocity_slide, w.threshold
    )


def fraud_alerts_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.fraud_alerts(_timed_orders(spark, sf_dir), SAMPLE_WINDOWS)


def fraud_alert_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fraud.alert_messages(fraud_alerts_batch(spark, sf_dir))


def fraud_alerts_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts over messages some of which name no user, have no time or can't be read."""
    messages = sample_tables.event_messages(sample_tables.table(spark, sf_dir, "events"))
    return fraud.fraud_alerts(fraud.with_event_time(fraud.parse_orders(messages)), SAMPLE_WINDOWS)


def fraud_left_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of these messages the rules do not see, and why."""
    return fraud.left_out(sample_tables.event_messages(sample_tables.table(spark, sf_dir, "events")))


def fraud_alerts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts of a streaming query over order messages, last state of each."""
    schema = sample_tables.table(spark, sf_dir, "events").schema
    # As a pattern, the path may be one file as well as a folder of files.
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events.parquet}}")
    orders = sample_tables.event_orders(events)
    messages = orders.select(
        F.col("order_id").alias("key"), F.to_json(F.struct("*")).alias("value")
    )
    alerts = jobs.detect_fraud(messages, SAMPLE_WINDOWS)
    path = workspace(spark, "alerts")
    run = update_output(alerts, path, workspace(spark, "alerts-checkpoint"), True).start()
    run.awaitTermination()
    return fraud.latest_alerts(spark.read.parquet(path))


def restaurant_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dimension(spark, sf_dir)


def popularity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension.popularity_rank(_dimension(spark, sf_dir)).drop("restaurant_id")


def _registered() -> dict[str, Query]:
    return {
        # order history
        "top_revenue_restaurants": lambda s, d: history.top_revenue_restaurants(_orders(s, d)),
        "top_items": lambda s, d: history.top_items(_items(s, d)),
        "channel_leaders": lambda s, d: history.channel_leaders(_orders(s, d)),
        "city_revenue": lambda s, d: history.city_revenue(_orders(s, d)),
        "hourly_pattern": lambda s, d: history.hourly_pattern(_timed_orders(s, d)),
        "peak_hours": lambda s, d: history.peak_hours(history.hourly_pattern(_timed_orders(s, d))),
        "demand_bands": lambda s, d: history.demand_bands(_timed_orders(s, d)),
        "regional_favorites": lambda s, d: history.regional_favorites(_items(s, d)),
        "items_exploded": items_exploded,
        "items_resolved": items_resolved,
        "keyword_items": lambda s, d: items.bread_or_drink_items(_items(s, d)),
        "orders_json_scan": orders_json_scan,
        # restaurant tables
        "staging_scan": staging_scan,
        "csv_ranges": csv_ranges,
        "normalize_locations": normalize_locations,
        "normalize_restaurants": normalize_restaurants,
        "normalize_metrics": normalize_metrics,
        "normalize_metrics_exact": normalize_metrics_exact,
        "locations_upsert": locations_upsert,
        "load_audit": load_audit,
        "normalize_metrics_dealt": normalize_metrics_dealt,
        "load_twice": load_twice,
        "restaurant_serials": restaurant_serials,
        "fk_orphans": fk_orphans,
        # restaurant reports
        "delivery_summary": lambda s, d: reports.delivery_summary(_restaurant_tables(s, d)[0]),
        "online_order_by_city": lambda s, d: reports.online_order_by_city(
            *_restaurant_tables(s, d)
        ),
        "top_neighborhoods": top_neighborhoods,
        "pricing_tiers": lambda s, d: reports.pricing_tiers(*_restaurant_tables(s, d)),
        # order validation
        "validate_valid": validate_valid,
        "validate_errors": validate_errors,
        "validate_malformed": validate_malformed,
        "validate_history": validate_history,
        "validate_stream_route": validate_stream_route,
        # fraud alerts
        "geo_impossible": geo_impossible,
        "velocity_spam": velocity_spam,
        "fraud_alerts_batch": fraud_alerts_batch,
        "fraud_alert_payload": fraud_alert_payload,
        "fraud_alerts_stream": fraud_alerts_stream,
        "fraud_alerts_messages": fraud_alerts_messages,
        "fraud_left_out": fraud_left_out,
        # restaurant dimension
        "restaurant_dimension": restaurant_dimension,
        "restaurants_by_city": lambda s, d: dimension.restaurants_by_city(
            _dimension(s, d)
        ),
        "popularity_rank": popularity_rank,
    }


def queries() -> dict[str, Query]:
    def checked(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(spark, sf_dir))

    return {name: checked(query) for name, query in _registered().items()}
