"""Streaming jobs. Each is one query over one source."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.constants import PRICE_TOLERANCE, WATERMARK_DELAY
from orderflow.operators import fraud, validate
from orderflow.sinks.streams import topic_of

DEFAULT_TOPICS = {
    validate.VALID: "orders.valid",
    validate.ERROR: "orders.errors",
    validate.MALFORMED: "orders.malformed",
}


def route_orders(messages: DataFrame, tolerance: Decimal = PRICE_TOLERANCE) -> DataFrame:
    """Messages as ``route, key, value``.

    The rules keep no state, and a route is a column: one pass over the input
    feeds all outputs, through a partitioned file sink or Kafka's topic column.
    """
    return validate.routed_messages(validate.check_messages(messages, tolerance))


def to_topics(routed: DataFrame, topics: dict[str, str] | None = None) -> DataFrame:
    topic = topic_of(F.col("route"), topics or DEFAULT_TOPICS)
    return routed.select("key", "value", topic.alias("topic"))


def detect_fraud(
    messages: DataFrame,
    windows: fraud.Windows = fraud.DOCUMENTED,
    watermark: str = WATERMARK_DELAY,
) -> DataFrame:
    """Alerts over a stream of valid order messages, for update mode.

    Rows behind the watermark are dropped. Both rules read the source; to read
    a costly source once, land the messages as Parquet and start from there.
    """
    orders = fraud.with_event_time(fraud.parse_orders(messages))
    return fraud.fraud_alerts(orders.withWatermark("event_time", watermark), windows)
