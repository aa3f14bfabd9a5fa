"""Reports over the order history."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from orderflow.functions.times import event_time, utc_hour
from orderflow.operators import history, items
from orderflow.schemas import ORDER
from orderflow.sources.files import read_orders


def nested(spark, item_type, values):
    schema = f"order_id string, restaurant_city string, items array<{item_type}>"
    return spark.createDataFrame(values, schema)


@pytest.mark.parametrize(
    ("item_type", "item", "expected"),
    [
        ("struct<item_id:string,item_name:string,quantity:int>", ("i", "n", 3), ("i", 3)),
        ("struct<item_name:string,food_item:string,quantity:int>", ("n", "f", 3), ("n", 3)),
        ("struct<category:string,food_item:string,quantity:string>", ("c", "f", "4"), ("f", 4)),
        ("struct<category:string,food_item:string,quantity:string>", ("c", "f", "x"), ("f", 1)),
        ("struct<label:string,number:int>", ("l", 5), ("l", 5)),
        ("struct<label:string>", ("l",), ("l", 1)),
        ("struct<item_id:int,quantity:double>", (7, 2.0), ("7", 2)),
        ("struct<item_id:string,quantity:int>", (None, None), ("Unknown Item", 1)),
        ("string", "plain", ("plain", 1)),
        ("int", 9, ("9", 1)),
    ],
)
def test_item_shapes(spark, item_type, item, expected):
    (row,) = items.resolve_items(nested(spark, item_type, [("o", "c", [item])])).collect()
    assert (row.item_name, row.item_quantity) == expected


def test_orders_without_items_vanish(spark):
    orders = nested(spark, "string", [("a", "c", ["x"]), ("b", "c", []), ("c", "c", None)])
    assert [r.order_id for r in items.explode_items(orders).collect()] == ["a"]


def test_inferred_schema_sorts_fields_yet_the_dish_is_found(spark, tmp_path):
    (tmp_path / "h.json").write_text(
        '{"items":[{"food_item":"naan","category":"bread","unit_price":2.5,"quantity":3}]}\n'
    )
    orders = read_orders(spark, str(tmp_path), schema=None)
    (row,) = items.resolve_items(orders).collect()
    assert (row.item_name, row.item_quantity) == ("naan", 3)


def test_unreadable_lines_are_marked_and_kept_out_of_the_hours(spark, tmp_path):
    (tmp_path / "h.json").write_text(
        '{"order_id":"a","order_time":"2024-05-01T09:10:00Z"}\n'
        '{"order_id":"b","order_time":"2024-05-01T09:50:00Z"}\n'
        '{"order_id":"c","order_time":"2024-05-01T23:30:00Z"}\n'
        '{"order_id":"d","order_time":"soon"}\n'
        "{broken\n"
    )
    orders = read_orders(spark, str(tmp_path)).cache()
    assert orders.filter("_corrupt_record is not null").count() == 1
    pattern = history.hourly_pattern(orders)
    assert [tuple(r) for r in pattern.collect()] == [(9, 2), (23, 1)]
    assert tuple(history.peak_hours(pattern).first()) == (9, 2, 23, 1)
    dense = history.hourly_pattern(orders, densify=True).collect()
    assert [r.order_hour for r in dense] == list(range(24))
    assert sum(r.transaction_volume for r in dense) == 3


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_orders(spark, str(tmp_path / "none"))


def test_peak_ties_go_to_the_earlier_hour(spark):
    hourly = spark.createDataFrame(
        [(h, n) for h, n in [(5, 7), (3, 7), (9, 2), (8, 2)]],
        "order_hour int, transaction_volume bigint",
    )
    assert tuple(history.peak_hours(hourly).first()) == (3, 7, 8, 2)


@pytest.mark.parametrize(
    ("text", "hour"),
    [
        ("2024-05-01T05:00:00Z", 5),
        ("2024-05-01T05:00:00+05:30", 23),
        ("2024-05-01T05:00:00.123456Z", 5),
        ("1969-12-31T22:59:59Z", 22),
        ("zzz", None),
        (None, None),
    ],
)
@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata"])
def test_hours_do_not_depend_on_the_session_zone(spark, text, hour, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(utc_hour(event_time("t"))).first()[0] == hour
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def orders_of(spark, rows):
    names = ["order_id", "restaurant_id", "restaurant_name", "restaurant_city"]
    names += ["request_online", "request_table", "order_price"]
    schema = T.StructType([ORDER[name] for name in names])
    return spark.createDataFrame(rows, schema)


def test_revenue_is_exact_and_ties_follow_the_key(spark):
    rows = [(str(n), n % 3, f"r{n % 3}", f"c{n % 2}", True, False, 0.1) for n in range(30)]
    orders = orders_of(spark, rows)
    found = history.top_revenue_restaurants(orders, 2).collect()
    assert [(r.restaurant_id, float(r.total_earnings)) for r in found] == [(0, 1.0), (1, 1.0)]
    cities = history.city_revenue(orders).collect()
    assert [(r.restaurant_city, float(r.total_city_revenue)) for r in cities] == [
        ("c0", 1.5),
        ("c1", 1.5),
    ]


def test_conflicting_modes_count_in_both_channels(spark):
    rows = [("a", 1, "r", "c", True, True, 1.0), ("b", 1, "r", "c", None, True, 1.0)]
    (row,) = history.channel_leaders(orders_of(spark, rows)).collect()
    assert (row.online_delivery_count, row.dine_in_traffic_count) == (1, 2)


def test_favorites_keep_all_ties(spark):
    values = [("o", "north", ["tea", "tea", "naan", "naan", "rice"]), ("p", "south", ["rice"])]
    values.append(("q", None, ["soda"]))
    found = history.regional_favorites(items.resolve_items(nested(spark, "string", values)))
    assert [tuple(r) for r in found.collect()] == [
        (None, "soda", 1, 1),
        ("north", "naan", 2, 1),
        ("north", "tea", 2, 1),
        ("south", "rice", 1, 1),
    ]


def test_demand_bands_cover_the_day(spark):
    hours = spark.range(24).select(F.col("id").cast("int").alias("hour"))
    found = hours.select("hour", history.day_band(F.col("hour")).alias("band")).collect()
    expected = {
        "morning": {8, 9, 10},
        "lunch": {12, 13, 14},
        "dinner": {19, 20, 21},
        "night": {23, 0, 1, 2, 3, 4, 5},
        "other": {6, 7, 11, 15, 16, 17, 18, 22},
    }
    assert {band: {r.hour for r in found if r.band == band} for band in expected} == expected


def test_demand_bands_have_factors(spark):
    orders = spark.range(24).select(
        F.col("id").cast("string").alias("order_id"),
        F.format_string("2024-05-01T%02d:00:00Z", "id").alias("order_time"),
    )
    found = {r.band: (r.demand_factor, r.order_count) for r in history.demand_bands(orders).collect()}
    assert found == {
        "morning": (0.6, 3),
        "lunch": (3.0, 3),
        "dinner": (1.2 * 3.0, 3),
        "night": (0.3, 7),
        "other": (1.0, 8),
    }


def test_bread_or_drink(spark):
    names = ["Butter NAAN", "Iced Tea", "steak", "rice", "Sweet lassi", "rotisserie"]
    rows = nested(spark, "string", [("o", "c", names)])
    found = items.bread_or_drink_items(items.resolve_items(rows)).collect()
    # "steak" holds "tea" and "rotisserie" holds "roti": the test is for substrings.
    assert {r.item_name for r in found if not r.bread_or_drink} == {"rice"}
