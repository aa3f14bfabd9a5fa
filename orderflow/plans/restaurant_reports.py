"""Four reports over the normalised restaurant tables.

Metrics are summed up per restaurant before they meet the restaurant table,
and per location before they meet the location table. Both joins are then
between tables with unique keys, so a restaurant or a location that holds a
large share of the rows costs no more than any other, and counting distinct
restaurants becomes counting rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.constants import (
    BUDGET_MAX_COST,
    DELIVERY,
    NO,
    PREMIUM_MIN_COST,
    TIER_BUDGET,
    TIER_MID,
    TIER_PREMIUM,
    TOP_MIN_RESTAURANTS,
    TOP_RATING,
    YES,
)
from orderflow.functions.numbers import hundredths, mean_to_cents

# What is added up along the way, all whole numbers, and the rows behind it.
_SUMS = ("cost_sum", "cost_count", "votes_sum", "rate_sum", "rate_count")


def _group_sums(group: Column) -> dict[str, Column]:
    """The sums over the metric rows of one group."""
    cost = F.when(group, F.col("approx_cost_two").cast("bigint"))
    rate = F.when(group, hundredths("rate"))
    votes = F.when(group, F.col("votes").cast("bigint"))
    columns = (F.sum(cost), F.count(cost), F.sum(votes), F.sum(rate), F.count(rate))
    return dict(zip(_SUMS, columns, strict=True)) | {"listed": F.count_if(group)}


def _per_restaurant(
    metrics: DataFrame, groups: Sequence[tuple[object, Column]], names: Sequence[str]
) -> DataFrame:
    """Measures per restaurant and group, in one aggregation per restaurant.

    Each group is a column of sums, so the exchange is by restaurant alone and
    the join that follows needs no second one.
    """
    wanted = [*names, "listed"]
    sums = [
        column.alias(f"{name}_{position}")
        for position, (_, condition) in enumerate(groups)
        for name, column in _group_sums(condition).items()
        if name in wanted
    ]
    rows = [
        F.struct(
            F.lit(label).alias("bucket"),
            *[F.col(f"{name}_{position}").alias(name) for name in wanted],
        )
        for position, (label, _) in enumerate(groups)
    ]
    return (
        metrics.groupBy("restaurant_id")
        .agg(*sums)
        .select("restaurant_id", F.inline(F.array(*rows)))
        .filter(F.col("listed") > 0)
        .drop("listed")
    )


def _per_location(
    per_restaurant: DataFrame, restaurants: DataFrame, names: Sequence[str]
) -> DataFrame:
    return (
        per_restaurant.join(restaurants.select("restaurant_id", "location_id"), "restaurant_id")
        .groupBy("location_id", "bucket")
        .agg(
            *[F.sum(name).alias(name) for name in names],
            F.count(F.lit(1)).alias("restaurants"),
        )
    )


def _per_city(per_location: DataFrame, locations: DataFrame, names: Sequence[str]) -> DataFrame:
    return (
        per_location.join(locations.select("location_id", "listed_in_city"), "location_id")
        .groupBy(F.col("listed_in_city").alias("city"), "bucket")
        .agg(
            *[F.sum(name).alias(name) for name in names],
            F.sum("restaurants").alias("restaurants"),
        )
    )


def delivery_summary(metrics: DataFrame, listed_in_type: str = DELIVERY) -> DataFrame:
    """Restaurants of a listing type and their average cost for two."""
    per_restaurant = (
        metrics.filter(F.col("listed_in_type") == listed_in_type)
        .groupBy("restaurant_id")
        .agg(
            F.sum(F.col("approx_cost_two").cast("bigint")).alias("cost_sum"),
            F.count("approx_cost_two").alias("cost_count"),
        )
    )
    return per_restaurant.agg(
        F.count("restaurant_id").alias("total_restaurants"),
        mean_to_cents(F.sum("cost_sum") * F.lit(100), F.sum("cost_count")).alias(
            "avg_approx_cost_for_two"
        ),
    )


def online_order_by_city(
    metrics: DataFrame, restaurants: DataFrame, locations: DataFrame
) -> DataFrame:
    """Average cost and votes by city, with and without online ordering."""
    names = ["cost_sum", "cost_count", "votes_sum"]
    online = F.col("online_order")
    # The first two groups are the column's values; rows without one form a third.
    groups = [(1, online), (0, ~online), (-1, online.isNull())]
    totals = _per_city(
        _per_location(_per_restaurant(metrics, groups, names), restaurants, names),
        locations,
        names,
    )
    return totals.select(
        "city",
        F.when(F.col("bucket") == 1, F.lit(YES)).otherwise(F.lit(NO)).alias("online_order_status"),
        mean_to_cents(F.col("cost_sum") * F.lit(100), F.col("cost_count")).alias(
            "avg_approx_cost_for_two"
        ),
        F.col("votes_sum").alias("total_votes"),
    ).orderBy(F.asc("city"), F.desc("online_order_status"))


def top_neighborhoods(
    metrics: DataFrame,
    restaurants: DataFrame,
    locations: DataFrame,
    min_rating: Decimal = TOP_RATING,
    min_restaurants: int = TOP_MIN_RESTAURANTS,
) -> DataFrame:
    """Neighbourhoods with enough restaurants and a rating above a limit.

    The limit is compared with the exact average, by cross-multiplication.
    """
    names = ["rate_sum", "rate_count"]
    everything = [(0, F.lit(True))]
    totals = _per_location(_per_restaurant(metrics, everything, names), restaurants, names)
    limit = F.col("rate_count") * F.lit(Decimal(min_rating) * 100)
    chosen = totals.filter(
        (F.col("rate_sum") > limit) & (F.col("restaurants") >= min_restaurants)
    )
    return chosen.join(locations, "location_id").select(
        F.col("location_name").alias("neighborhood"),
        mean_to_cents(F.col("rate_sum"), F.col("rate_count")).alias("average_rating"),
        F.col("restaurants").alias("total_restaurants"),
    )


def pricing_tiers(metrics: DataFrame, restaurants: DataFrame, locations: DataFrame) -> DataFrame:
    """Restaurants and average rating by city and price tier."""
    names = ["rate_sum", "rate_count"]
    cost = F.col("approx_cost_two")
    groups = [
        (TIER_BUDGET, cost <= BUDGET_MAX_COST),
        (TIER_MID, (cost > BUDGET_MAX_COST) & (cost < PREMIUM_MIN_COST)),
        (TIER_PREMIUM, cost >= PREMIUM_MIN_COST),
    ]
    priced = metrics.filter(cost.isNotNull())
    totals = _per_city(
        _per_location(_per_restaurant(priced, groups, names), restaurants, names),
        locations,
        names,
    )
    return totals.select(
        "city",
        F.col("bucket").alias("pricing_tier"),
        F.col("restaurants").alias("total_restaurants"),
        mean_to_cents(F.col("rate_sum"), F.col("rate_count")).alias("average_rating"),
    ).orderBy(F.asc("city"), F.desc("total_restaurants"), F.asc("pricing_tier"))
