"""Order rules as column expressions, for batch and streaming alike.

A message is parsed once, with the types the rules need; absent and null fields
are the same. The original text is what gets routed, so fields unknown to us
survive.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.constants import (
    INVALID_PHONE,
    MODE_CONFLICT,
    MULTIPLE_ERRORS,
    PHONE_PREFIXES,
    PRICE_MISMATCH,
    PRICE_TOLERANCE,
    UNKNOWN_ORDER_ID,
)

VALID, ERROR, MALFORMED = "valid", "error", "malformed"
NOT_JSON, NOT_OBJECT, BAD_FIELD_TYPE = "NOT_JSON", "NOT_OBJECT", "BAD_FIELD_TYPE"

PRICE = "decimal(20,6)"
QUANTITY = "decimal(12,3)"
TOTAL = "decimal(36,9)"


# --- the three rules, over typed columns -------------------------------------


def _number(value: Column, kind: str) -> Column:
    """A JSON number as a decimal: 0 if absent, NULL if it does not fit."""
    return F.when(value.isNull(), F.lit(0).cast(kind)).otherwise(value.try_cast(kind))


def items_total(items: Column) -> Column:
    """Sum of unit price times quantity within one order, to cents.

    An absent price or quantity counts as 0; one too large for a decimal makes
    the total NULL, which no reported price equals.
    """

    def add(total: Column, item: Column) -> Column:
        price = _number(item.getField("unit_price"), PRICE)
        count = _number(item.getField("quantity"), QUANTITY)
        return F.try_add(total, price * count).try_cast(TOTAL)

    zero = F.lit(0).cast(TOTAL)
    total = F.when(items.isNull(), zero).otherwise(F.aggregate(items, zero, add))
    return F.round(total, 2)


def error_codes(
    phone: Column,
    online: Column,
    table: Column,
    price: Column,
    calculated: Column,
    tolerance: Decimal = PRICE_TOLERANCE,
) -> Column:
    """Codes of the broken rules, in the order phone, mode, price."""
    phone_text = F.coalesce(phone, F.lit(""))
    phone_ok = F.lit(False)
    for prefix in PHONE_PREFIXES:
        phone_ok = phone_ok | phone_text.startswith(prefix)
    both_modes = F.coalesce(online, F.lit(False)) & F.coalesce(table, F.lit(False))
    # A price or total beyond the decimal range cannot be confirmed: not equal.
    price_ok = F.coalesce(F.abs(price - calculated) <= F.lit(tolerance), F.lit(False))
    return F.array_compact(
        F.array(
            F.when(~phone_ok, F.lit(INVALID_PHONE)),
            F.when(both_modes, F.lit(MODE_CONFLICT)),
            F.when(~price_ok, F.lit(PRICE_MISMATCH)),
        )
    )


def with_errors(orders: DataFrame, tolerance: Decimal = PRICE_TOLERANCE) -> DataFrame:
    """Typed orders with an ``errors`` column."""
    codes = error_codes(
        F.col("phone_number"),
        F.col("request_online"),
        F.col("request_table"),
        _number(F.col("order_price"), PRICE),
        items_total(F.col("items")),
        tolerance,
    )
    return orders.withColumn("errors", codes)


def only_valid(orders: DataFrame, tolerance: Decimal = PRICE_TOLERANCE) -> DataFrame:
    """Orders without a broken rule; records that the reader could not type are not valid."""
    if "_corrupt_record" in orders.columns:
        orders = orders.filter(F.col("_corrupt_record").isNull())
    return with_errors(orders, tolerance).filter(F.size("errors") == 0).drop("errors")


# --- messages ----------------------------------------------------------------

# The texts stay VARIANT, because a typed parse turns a number into text. A flag,
# price or item of the wrong type makes the reader report the record as corrupt.
_ORDER = """order_id variant, phone_number variant, request_online boolean,
    request_table boolean, order_price double,
    items array<struct<unit_price:double,quantity:double>>"""
_ENVELOPE = f"messages array<struct<{_ORDER}, end string>>, corrupt string"


def _is_text(value: Column) -> Column:
    return value.isNull() | F.is_variant_null(value) | (F.schema_of_variant(value) == "STRING")


def check_messages(messages: DataFrame, tolerance: Decimal = PRICE_TOLERANCE) -> DataFrame:
    """Route every message of a ``value`` column.

    Adds ``route`` (valid, error or malformed), ``order_id``, ``errors`` (the
    broken rules) and ``reason`` (why a message is malformed).
    """
    # A parser stops after the first JSON value. In an envelope, anything left
    # over after it is a parse error or shifts the end mark. The mark is a hash of
    # the whole text, which the text cannot hold.
    value, mark = F.col("value"), F.col("_mark")
    end = F.concat(F.lit(',{"end":"'), mark, F.lit('"}]'))
    wrapped = F.concat(F.lit('{"messages":['), value, end, F.lit("}"))
    envelope = F.from_json(wrapped, _ENVELOPE, {
        "columnNameOfCorruptRecord": "corrupt",
        "allowNonNumericNumbers": "false",
    })
    parsed = messages.withColumn("_mark", F.md5("value")).withColumn("envelope", envelope).select(
        *messages.columns,
        "_mark",
        F.get("envelope.messages", F.lit(0)).alias("order"),
        F.coalesce(
            F.col("envelope.corrupt").isNull()
            & (F.size("envelope.messages") == 2)
            & (F.get("envelope.messages", F.lit(1)).getField("end") == mark),
            F.lit(False),
        ).alias("is_typed"),
    )
    typed = parsed.select(
        *messages.columns,
        "_mark",
        "is_typed",
        F.col("order").isNotNull().alias("is_order"),
        "order.*",
    )

    # Only a message that did not parse as typed is looked at again, to say why.
    as_list = F.try_parse_json(F.concat(F.lit("["), value, end))
    is_json = F.coalesce(F.try_variant_get(as_list, "$[1].end", "string") == mark, F.lit(False))
    is_object = value.rlike(r"^[ \t\r\n]*\{")
    fields_ok = (
        _is_text(F.col("order_id"))
        & _is_text(F.col("phone_number"))
        & F.coalesce(F.forall("items", lambda item: item.isNotNull()), F.lit(True))
    )
    reason = (
        F.when(F.col("is_typed") & F.col("is_order") & fields_ok, F.lit(None).cast("string"))
        .when(~F.col("is_typed") & ~is_json, F.lit(NOT_JSON))
        .when(~is_object, F.lit(NOT_OBJECT))
        .otherwise(F.lit(BAD_FIELD_TYPE))
    )
    codes = error_codes(
        F.try_variant_get("phone_number", "$", "string"),
        F.col("request_online"),
        F.col("request_table"),
        _number(F.col("order_price"), PRICE),
        items_total(F.col("items")),
        tolerance,
    )
    # The reason is a step of its own, for what stands in one expression may be evaluated at each mention.
    judged = typed.withColumn("_reason", reason).select(
        *messages.columns,
        F.coalesce(
            F.try_variant_get("order_id", "$", "string"), F.lit(UNKNOWN_ORDER_ID)
        ).alias("order_id"),
        F.col("_reason").alias("reason"),
        F.when(F.col("_reason").isNull(), codes).alias("errors"),
    )
    route = (
        F.when(F.col("reason").isNotNull(), F.lit(MALFORMED))
        .when(F.size("errors") > 0, F.lit(ERROR))
        .otherwise(F.lit(VALID))
    )
    # A caller's filter on the route would be pushed below these projections,
    # where Catalyst repeats the parse for every mention of a field. It stops
    # at a generator, here one that yields exactly one row per message.
    verdict = F.struct(route.alias("route"), "order_id", "errors", "reason")
    return judged.select(*messages.columns, F.inline(F.array(verdict)))


def error_payload(value: Column, errors: Column) -> Column:
    """Error record around the untouched original text."""
    kind = F.when(F.size(errors) > 1, F.lit(MULTIPLE_ERRORS)).otherwise(errors[0])
    return F.concat(
        F.lit('{"original_order":'),
        value,
        F.lit(',"errors":'),
        F.to_json(errors),
        F.lit(',"error_count_type":"'),
        kind,
        F.lit('"}'),
    )


def routed_messages(checked: DataFrame) -> DataFrame:
    """Checked messages as ``route, key, value``: what each output receives."""
    route = F.col("route")
    value = F.when(route == ERROR, error_payload(F.col("value"), F.col("errors")))
    return checked.select(
        "route",
        F.when(route != MALFORMED, F.col("order_id")).alias("key"),
        value.otherwise(F.col("value")).alias("value"),
    )
