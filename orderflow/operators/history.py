"""Reports over the order history.

All of them are partial aggregations followed by one exchange of partial
results, so a restaurant, city or item that holds a large share of the orders
costs one row per task in the shuffle. Ties are ordered by the group key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.constants import DEMAND_BANDS, OTHER_BAND, TOP_CITIES, TOP_ROWS
from orderflow.functions.numbers import money_total
from orderflow.functions.times import event_time, utc_hour

RESTAURANT = ("restaurant_id", "restaurant_name")


def top_items(items: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    """Most sold items; ``items`` comes from :func:`resolve_items`."""
    return (
        items.groupBy("item_name")
        .agg(F.sum("item_quantity").alias("total_units_sold"))
        .orderBy(F.desc("total_units_sold"), "item_name")
        .limit(k)
    )


def top_revenue_restaurants(orders: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    return (
        orders.groupBy(*RESTAURANT)
        .agg(money_total("order_price").alias("total_earnings"))
        .orderBy(F.desc("total_earnings"), *RESTAURANT)
        .limit(k)
    )


def channel_leaders(orders: DataFrame, k: int = TOP_ROWS) -> DataFrame:
    """Online and dine-in orders per restaurant; an order may be in both."""
    online, dine_in = F.col("online_delivery_count"), F.col("dine_in_traffic_count")
    return (
        orders.groupBy(*RESTAURANT)
        .agg(
            F.count_if("request_online").alias("online_delivery_count"),
            F.count_if("request_table").alias("dine_in_traffic_count"),
        )
        .orderBy((online + dine_in).desc(), *RESTAURANT)
        .limit(k)
    )


def with_order_hour(orders: DataFrame) -> DataFrame:
    return orders.withColumn("order_hour", utc_hour(event_time("order_time")))


def hourly_pattern(orders: DataFrame, densify: bool = False) -> DataFrame:
    """Orders per hour of day; orders without a readable time are left out."""
    counts = (
        with_order_hour(orders)
        .filter(F.col("order_hour").isNotNull())
        .groupBy("order_hour")
        .agg(F.count("order_id").alias("transaction_volume"))
    )
    if densify:
        hours = counts.sparkSession.range(24).select(F.col("id").cast("int").alias("order_hour"))
        counts = hours.join(counts, "order_hour", "left").select(
            "order_hour",
            F.coalesce("transaction_volume", F.lit(0).cast("bigint")).alias("transaction_volume"),
        )
    return counts.orderBy("order_hour")


def peak_hours(hourly: DataFrame) -> DataFrame:
    """Busiest and quietest hour of an hourly pattern; ties go to the earlier hour."""
    volume, hour = F.col("transaction_volume"), F.col("order_hour")
    busiest = F.max(F.struct(volume, (-hour).alias("earliness")))
    quietest = F.min(F.struct(volume, hour))
    return hourly.agg(busiest.alias("b"), quietest.alias("q")).select(
        (-F.col("b.earliness")).alias("peak_hour"),
        F.col("b.transaction_volume").alias("peak_volume"),
        F.col("q.order_hour").alias("off_peak_hour"),
        F.col("q.transaction_volume").alias("off_peak_volume"),
    )


def city_revenue(orders: DataFrame, k: int = TOP_CITIES) -> DataFrame:
    return (
        orders.groupBy("restaurant_city")
        .agg(money_total("order_price").alias("total_city_revenue"))
        .orderBy(F.desc("total_city_revenue"), "restaurant_city")
        .limit(k)
    )


def regional_favorites(items: DataFrame) -> DataFrame:
    """Items of rank 1 by units in each city, ties included.

    ``rank() = 1`` is "has the city's largest quantity", so the largest value
    is aggregated per city and joined back by equality. A window would sort
    all items of a city in one task; here nothing larger than one row per city
    is gathered, however many items tie.
    """
    totals = items.groupBy("restaurant_city", "item_name").agg(
        F.sum("item_quantity").alias("item_city_quantity")
    )
    best = totals.groupBy("restaurant_city").agg(
        F.max("item_city_quantity").alias("item_city_quantity")
    )
    same_city = F.col("t.restaurant_city").eqNullSafe(F.col("b.restaurant_city"))
    same_quantity = F.col("t.item_city_quantity") == F.col("b.item_city_quantity")
    return (
        totals.alias("t")
        .join(best.alias("b"), same_city & same_quantity)
        .select("t.restaurant_city", "t.item_name", "t.item_city_quantity", F.lit(1).alias("rank"))
        .orderBy("restaurant_city", "item_name")
    )


def demand_band(hour: Column) -> tuple[Column, Column]:
    """Name and factor of the demand band of an hour of day."""
    name, factor = F.lit(OTHER_BAND[0]), F.lit(OTHER_BAND[1])
    for band, start, end, weight in DEMAND_BANDS:
        after, before = hour >= start, hour < end
        inside = (after & before) if start < end else (after | before)
        name = F.when(inside, F.lit(band)).otherwise(name)
        factor = F.when(inside, F.lit(weight)).otherwise(factor)
    return name, factor


def day_band(hour: Column) -> Column:
    """Name of the band of the day that an hour lies in."""
    return demand_band(hour)[0]


def demand_bands(orders: DataFrame) -> DataFrame:
    """Orders per demand band of the day."""
    name, factor = demand_band(F.col("order_hour"))
    return (
        hourly_pattern(orders)
        .select(name.alias("band"), factor.alias("demand_factor"), "transaction_volume")
        .groupBy("band", "demand_factor")
        .agg(F.sum("transaction_volume").alias("order_count"))
        .orderBy("band")
    )
