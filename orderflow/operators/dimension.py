"""Typed restaurant dimension from the listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderflow.constants import (
    CITY_COLUMN,
    COST_COLUMN,
    DEFAULT_COST,
    DEFAULT_RATE,
    DEFAULT_VOTES,
    LISTING_COLUMNS,
)
from orderflow.functions.keys import stable_id
from orderflow.functions.text import (
    comma_list,
    cost_or_default,
    dial_number,
    is_any_case_yes,
    menu_list,
    menu_of_fixed_size,
    phone_list,
    rate_or_default,
    strip,
    votes_or_default,
)


def restaurant_dimension(
    listing: DataFrame,
    default_rate: float = DEFAULT_RATE,
    default_votes: int = DEFAULT_VOTES,
    default_cost: int = DEFAULT_COST,
) -> DataFrame:
    """One typed row per listing row that has a name."""
    col = F.col
    phones = phone_list(col("phone"))
    return listing.filter(strip(col("name")) != "").select(
        stable_id(*LISTING_COLUMNS).alias("restaurant_id"),
        strip(col("name")).alias("name"),
        is_any_case_yes(col("online_order")).alias("online_order"),
        is_any_case_yes(col("book_table")).alias("book_table"),
        rate_or_default(col("rate"), default_rate).alias("rate"),
        votes_or_default(col("votes"), default_votes).alias("votes"),
        phones.alias("phone_numbers"),
        F.transform(phones, dial_number).alias("dial_numbers"),
        F.coalesce(strip(col(CITY_COLUMN)), F.lit("")).alias("city"),
        comma_list(col("cuisines")).alias("cuisines"),
        cost_or_default(col(COST_COLUMN), default_cost).alias("approx_cost"),
        menu_of_fixed_size(menu_list(col("menu_item"))).alias("menu_items"),
    )


def restaurants_by_city(dimension: DataFrame) -> DataFrame:
    return dimension.groupBy("city").agg(F.count(F.lit(1)).alias("restaurant_count"))


def popularity_rank(dimension: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most popular restaurants of each city.

    The row number is unique within a city, so the window keeps at most ``k``
    rows per city and task before anything is shuffled.
    """
    weight = F.greatest(F.lit(1.0), F.col("rate")) * F.greatest(F.lit(1), F.col("votes"))
    by_weight = Window.partitionBy("city").orderBy(
        F.desc("popularity"), F.asc("name"), F.asc("restaurant_id")
    )
    return (
        dimension.select("city", "name", "restaurant_id", weight.alias("popularity"))
        .withColumn("place", F.row_number().over(by_weight))
        .filter(F.col("place") <= k)
    )
