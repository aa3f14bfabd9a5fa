"""Fraud rules over sliding event-time windows, for batch and streaming alike."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.constants import (
    GEO_ALERT,
    GEO_REASON,
    VELOCITY_ALERT,
    VELOCITY_REASON,
    VELOCITY_THRESHOLD,
)
from orderflow.functions.times import event_time
from orderflow.schemas import ORDER

ALERT_ID = ("alert_type", "user_id", "window_start")


@dataclass(frozen=True)
class Windows:
    """Window size and slide of both rules, and the velocity threshold."""

    geo_size: str
    geo_slide: str
    velocity_size: str
    velocity_slide: str
    threshold: int = VELOCITY_THRESHOLD


# Event time is simulated time. DOCUMENTED states the spans in that time;
# AS_CODED has the same spans in wall time, 300 times shorter.
DOCUMENTED = Windows("30 minutes", "10 minutes", "60 minutes", "20 minutes")
AS_CODED = Windows("6 seconds", "2 seconds", "12 seconds", "4 seconds")


def parse_orders(messages: DataFrame) -> DataFrame:
    """JSON order messages as typed columns."""
    text = F.col("value").cast("string")
    return messages.select(F.from_json(text, ORDER).alias("order")).select("order.*")


def with_event_time(orders: DataFrame) -> DataFrame:
    return orders.withColumn("event_time", event_time("order_time"))


def attributed(orders: DataFrame) -> DataFrame:
    """Orders that say who ordered: the others are not orders of one user, and would all meet in one group."""
    return orders.filter(F.col("user_id").isNotNull())


def left_out(messages: DataFrame) -> DataFrame:
    """How many messages the fraud rules do not see, by ``reason``: one pass, one row per reason.

    A message counts once, under the first that holds: it is no JSON object, names no user, has no readable time.
    """
    text = F.col("value").cast("string")
    order = F.from_json(text, ORDER)
    parsed = messages.select(
        F.coalesce(F.expr("try_variant_get(try_parse_json(value), '$', 'map<string,variant>')").isNull(), F.lit(True)).alias("bad"),
        order["user_id"].alias("user_id"),
        event_time(order["order_time"]).alias("event_time"),
    )
    reason = (
        F.when(F.col("bad"), "unreadable")
        .when(F.col("user_id").isNull(), "no user")
        .when(F.col("event_time").isNull(), "no time")
    )
    return (
        parsed.select(reason.alias("reason"))
        .filter("reason is not null")
        .groupBy("reason")
        .agg(F.count(F.lit(1)).alias("message_count"))
    )


def geo_impossible(orders: DataFrame, size: str, slide: str) -> DataFrame:
    """Users who order from more than one city within a window.

    The state of a window is the set of its cities; order ids are not kept.
    """
    return (
        attributed(orders)
        .groupBy(F.window("event_time", size, slide), "user_id")
        .agg(F.collect_set("restaurant_city").alias("cities"))
        .filter(F.size("cities") > 1)
        .select(
            "user_id",
            F.lit(GEO_ALERT).alias("alert_type"),
            F.concat(F.lit(GEO_REASON), F.sort_array("cities").cast("string")).alias(
                "trigger_reason"
            ),
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
    )


def velocity_spam(
    orders: DataFrame, size: str, slide: str, threshold: int = VELOCITY_THRESHOLD
) -> DataFrame:
    """Users with more than ``threshold`` orders within a window."""
    return (
        attributed(orders)
        .groupBy(F.window("event_time", size, slide), "user_id")
        .agg(F.count("order_id").alias("order_count"))
        .filter(F.col("order_count") > threshold)
        .select(
            "user_id",
            F.lit(VELOCITY_ALERT).alias("alert_type"),
            F.concat(F.lit(VELOCITY_REASON), F.col("order_count").cast("string")).alias(
                "trigger_reason"
            ),
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
    )


_UNITS = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def micros(span: str) -> int:
    """A span such as ``30 minutes`` or ``1 hour 30 minutes`` in microseconds."""
    words = span.lower().split()
    parts = list(zip(words[::2], (unit.removesuffix("s") for unit in words[1::2]), strict=False))
    if not parts or len(words) % 2 or not all(n.isdigit() and unit in _UNITS for n, unit in parts):
        raise ValueError(f"no span of fixed length: {span!r}")
    return sum(int(n) * _UNITS[unit] for n, unit in parts)


def panes(orders: DataFrame, step: int) -> DataFrame:
    """Orders and cities of each user per pane of ``step`` microseconds: ``user_id, pane, order_count, cities``.

    ``pane`` is the start. Rows without a user or a readable time are in no pane.
    """
    at = F.unix_micros("event_time")
    return (
        attributed(orders)
        .filter("event_time is not null")
        .groupBy("user_id", (at - F.pmod(at, F.lit(step))).alias("pane"))
        .agg(F.count("order_id").alias("order_count"), F.collect_set("restaurant_city").alias("cities"))
    )


def _starts(size: int, slide: int, rule: str) -> Column:
    """The starts of the windows that hold ``pane``: multiples of the slide from over ``pane - size`` to ``pane``."""
    first = f"pane - {size} - pmod(pane - {size}, {slide}) + {slide}"
    every = f"if({first} <= pane, sequence({first}, pane, cast({slide} as bigint)), array())"
    return F.expr(f"transform({every}, s -> struct('{rule}' as alert_type, s as start, {size} as size))")


def alerts_of_panes(found: DataFrame, windows: Windows = DOCUMENTED) -> DataFrame:
    """Alerts of both rules from panes whose step divides all spans of ``windows``.

    A pane goes into the windows of both rules at once: what is exchanged by window are panes, a row
    per user, task and window, however many orders they hold.
    """
    rules = F.concat(
        _starts(micros(windows.geo_size), micros(windows.geo_slide), GEO_ALERT),
        _starts(micros(windows.velocity_size), micros(windows.velocity_slide), VELOCITY_ALERT),
    )
    is_geo = F.col("w.alert_type") == GEO_ALERT
    whole = (
        found.select("user_id", "order_count", "cities", F.explode(rules).alias("w"))
        .groupBy("user_id", "w")
        .agg(
            F.sum(F.when(~is_geo, F.col("order_count"))).alias("order_count"),
            F.array_distinct(F.flatten(F.collect_list(F.when(is_geo, F.col("cities"))))).alias("cities"),
        )
    )
    cities = F.concat(F.lit(GEO_REASON), F.sort_array("cities").cast("string"))
    orders = F.concat(F.lit(VELOCITY_REASON), F.col("order_count").cast("string"))
    return whole.filter(
        F.when(is_geo, F.size("cities") > 1).otherwise(F.col("order_count") > windows.threshold)
    ).select(
        "user_id",
        "w.alert_type",
        F.when(is_geo, cities).otherwise(orders).alias("trigger_reason"),
        F.timestamp_micros("w.start").alias("window_start"),
        F.timestamp_micros(F.col("w.start") + F.col("w.size")).alias("window_end"),
    )


def fraud_alerts(orders: DataFrame, windows: Windows = DOCUMENTED) -> DataFrame:
    """Alerts of both rules; ``orders`` carries an ``event_time``.

    In batch both rules share one scan and one aggregation, to panes of the largest step that all spans are
    multiples of. A stream keeps a state per rule, as the watermark can end windows only.
    """
    if not orders.isStreaming:
        spans = (windows.geo_size, windows.geo_slide, windows.velocity_size, windows.velocity_slide)
        return alerts_of_panes(panes(orders, math.gcd(*map(micros, spans))), windows)
    geo = geo_impossible(orders, windows.geo_size, windows.geo_slide)
    velocity = velocity_spam(
        orders, windows.velocity_size, windows.velocity_slide, windows.threshold
    )
    return geo.unionByName(velocity)


def alert_messages(alerts: DataFrame, with_window: bool = False) -> DataFrame:
    """Alerts as ``key, value`` messages; the window bounds are optional."""
    fields = ["user_id", "alert_type", "trigger_reason"]
    if with_window:
        fields += ["window_start", "window_end"]
    return alerts.select(
        F.col("user_id").cast("string").alias("key"), F.to_json(F.struct(*fields)).alias("value")
    )


def latest_alerts(updates: DataFrame, version: str = "batch_id") -> DataFrame:
    """Last state of every alert in the output of an update-mode stream."""
    payload = F.struct("trigger_reason", "window_end")
    return (
        updates.groupBy(*ALERT_ID)
        .agg(F.max_by(payload, F.col(version)).alias("last"))
        .select(
            "user_id", "alert_type", "last.trigger_reason", "window_start", "last.window_end"
        )
    )
