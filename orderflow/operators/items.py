"""Items of nested orders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.constants import ITEM_ID_FIELDS, ITEM_QUANTITY_FIELD, UNKNOWN_ITEM
from orderflow.functions.text import is_bread_or_drink


def explode_items(orders: DataFrame, column: str = "items") -> DataFrame:
    """One row per order item, in column ``item``; orders without items vanish."""
    return orders.withColumn("item", F.explode(column))


def resolve_items(
    orders: DataFrame,
    column: str = "items",
    id_fields: Sequence[str] = ITEM_ID_FIELDS,
    quantity_field: str = ITEM_QUANTITY_FIELD,
) -> DataFrame:
    """Explode the items and give each an ``item_name`` and an ``item_quantity``.

    The item shape is taken from the schema while the plan is built: the first
    of ``id_fields`` that exists names the item (else the first field), and
    ``quantity_field`` counts it (else the second field). Plain values count
    once. An unreadable quantity counts once as well. Items that are VARIANT are resolved each by its own shape.
    """
    item_type = orders.schema[column].dataType.elementType
    exploded = explode_items(orders, column)
    if isinstance(item_type, T.VariantType):
        return _resolve_variants(exploded, id_fields, quantity_field)
    if not isinstance(item_type, T.StructType):
        return exploded.select(
            "*", F.col("item").cast("string").alias("item_name"), F.lit(1).alias("item_quantity")
        )

    fields = item_type.fieldNames()
    id_field = next((name for name in id_fields if name in fields), fields[0])
    if quantity_field not in fields:
        quantity_field = fields[1] if len(fields) > 1 else None
    quantity = F.lit(1)
    if quantity_field is not None:
        quantity = F.coalesce(F.col("item").getField(quantity_field).try_cast("int"), F.lit(1))
    name = F.col("item").getField(id_field).cast("string")
    return exploded.select(
        "*",
        F.coalesce(name, F.lit(UNKNOWN_ITEM)).alias("item_name"),
        quantity.alias("item_quantity"),
    )


def _resolve_variants(exploded: DataFrame, id_fields: Sequence[str], quantity_field: str) -> DataFrame:
    """Name and quantity of VARIANT items, whatever the shape of each.

    A field that is null or absent gives way to the next of ``id_fields``. An object with none of them and fields
    that no order item has is named by the first and counted by the second.
    """
    is_object = F.schema_of_variant("item").startswith("OBJECT")
    fields = F.when(is_object, F.from_json(F.to_json("item"), "map<string,string>"))
    known = ["category", "unit_price", quantity_field, *id_fields]
    others = F.filter(F.map_keys(fields), lambda k: ~k.isin(*known))
    nameless = F.size(F.filter(F.map_keys(fields), lambda k: k.isin(*known))) == 0
    first, second = (F.when(nameless, F.element_at(fields, F.get(others, i))) for i in (0, 1))
    name = F.when(is_object, F.coalesce(*[F.element_at(fields, f) for f in id_fields], first)).otherwise(
        F.try_variant_get("item", "$", "string")
    )
    text = F.coalesce(F.element_at(fields, quantity_field), second)
    quantity = F.coalesce(text.try_cast("int"), text.try_cast("double").try_cast("int"), F.lit(1))
    return exploded.select(
        "*", F.coalesce(name, F.lit(UNKNOWN_ITEM)).alias("item_name"), quantity.alias("item_quantity")
    )


def bread_or_drink_items(items: DataFrame) -> DataFrame:
    """Units per item name, with the bread-or-drink mark of the name."""
    totals = items.groupBy("item_name").agg(F.sum("item_quantity").alias("units"))
    return totals.withColumn("bread_or_drink", is_bread_or_drink(F.col("item_name")))
