"""Checks around the restaurant load.

Counts only: every check is a partial aggregation, and joins take place on
pre-aggregated keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.constants import CITY_COLUMN, COST_COLUMN, MAX_LENGTHS, TYPE_COLUMN
from orderflow.functions.text import digits_to_int, rate_decimal, rate_text

_DIGIT = r"\d"


def _row_checks() -> dict[str, Column]:
    """Conditions counted in one pass over the listing."""
    col = F.col
    figure = rate_text(col("rate"))
    limits = {
        "location": "location_name",
        CITY_COLUMN: "listed_in_city",
        "name": "name",
        "phone": "phone",
        "rest_type": "rest_type",
        TYPE_COLUMN: "listed_in_type",
    }
    too_long = reduce(
        lambda left, right: left | right,
        [
            F.coalesce(F.length(column) > MAX_LENGTHS[limit], F.lit(False))
            for column, limit in limits.items()
        ],
    )
    return {
        "staged_rows": F.lit(True),
        "rows_without_location": col("location").isNull() | col(CITY_COLUMN).isNull(),
        "rows_without_name_or_address": col("name").isNull() | col("address").isNull(),
        "unreadable_rates": figure.isNotNull() & rate_decimal(col("rate")).isNull(),
        "unreadable_votes": col("votes").rlike(_DIGIT) & digits_to_int(col("votes")).isNull(),
        "unreadable_costs": col(COST_COLUMN).rlike(_DIGIT)
        & digits_to_int(col(COST_COLUMN)).isNull(),
        "over_long_rows": too_long,
    }


def _rows_of(summary: DataFrame, names: list[str]) -> DataFrame:
    """One wide row of counts as (check_name, row_count) rows."""
    pairs = [
        F.struct(F.lit(name).alias("check_name"), F.col(name).alias("row_count")) for name in names
    ]
    return summary.select(F.inline(F.array(*pairs)))


def load_audit(staging: DataFrame) -> DataFrame:
    """Row counts of each load step, and of values the load could not read.

    The metric rows of the ``venue`` match are counted without the join:
    a venue's listing rows times its phones.
    """
    checks = _row_checks()
    row_counts = staging.agg(*[F.count_if(check).alias(name) for name, check in checks.items()])

    places = ["name", "address", "location", CITY_COLUMN]
    located = staging.dropna(subset=["location", CITY_COLUMN])
    venues = located.groupBy(*places, "phone").agg(F.count(F.lit(1)).alias("listed"))
    per_place = venues.groupBy(*places).agg(
        F.sum("listed").alias("listed"), F.count(F.lit(1)).alias("phones")
    )
    joinable = F.col("name").isNotNull() & F.col("address").isNotNull()
    per_location = per_place.groupBy("location", CITY_COLUMN).agg(
        F.sum("phones").alias("restaurants"),
        F.coalesce(F.sum(F.when(joinable, F.col("listed") * F.col("phones"))), F.lit(0)).alias(
            "metrics"
        ),
    )
    table_counts = per_location.agg(
        F.count(F.lit(1)).alias("location_rows"),
        F.coalesce(F.sum("restaurants"), F.lit(0)).alias("restaurant_rows"),
        F.coalesce(F.sum("metrics"), F.lit(0)).alias("metric_rows"),
    )
    return _rows_of(row_counts, list(checks)).unionByName(
        _rows_of(table_counts, ["location_rows", "restaurant_rows", "metric_rows"])
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows per key that has no parent; rows without a key are no orphans."""
    per_key = child.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("orphan_rows")
    )
    return per_key.join(parent.select(key), key, "left_anti")


def fk_orphans(
    metric_table: DataFrame, restaurant_table: DataFrame, location_table: DataFrame
) -> DataFrame:
    """Keys and rows on the child side of each foreign key without a parent."""
    checks = [
        ("restaurants.location_id", restaurant_table, location_table, "location_id"),
        ("metrics.restaurant_id", metric_table, restaurant_table, "restaurant_id"),
    ]
    results = [
        orphans(child, parent, key).agg(
            F.lit(name).alias("foreign_key"),
            F.count(F.lit(1)).alias("orphan_keys"),
            F.coalesce(F.sum("orphan_rows"), F.lit(0)).alias("orphan_rows"),
        )
        for name, child, parent, key in checks
    ]
    return reduce(DataFrame.unionByName, results)
