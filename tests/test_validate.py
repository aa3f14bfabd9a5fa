"""Order rules and routes."""

import json
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.operators import validate
from orderflow.schemas import ORDER


def order(**fields):
    base = {
        "order_id": "o1",
        "phone_number": "+9198",
        "request_online": True,
        "request_table": False,
        "items": [{"food_item": "tea", "unit_price": 1.5, "quantity": 2}],
        "order_price": 3.0,
    }
    return json.dumps({k: v for k, v in (base | fields).items() if v != "absent"})


def check(spark, *values):
    rows = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    return validate.check_messages(rows).orderBy("n").collect()


@pytest.mark.parametrize(
    ("fields", "errors"),
    [
        ({}, []),
        ({"phone_number": "08012"}, []),
        ({"phone_number": "09112"}, ["INVALID_PHONE"]),
        ({"phone_number": "0712"}, ["INVALID_PHONE"]),
        ({"phone_number": "12345"}, ["INVALID_PHONE"]),
        ({"phone_number": "++9112"}, ["INVALID_PHONE"]),
        ({"phone_number": None}, ["INVALID_PHONE"]),
        ({"phone_number": "absent"}, ["INVALID_PHONE"]),
        ({"request_table": True}, ["MODE_CONFLICT"]),
        ({"request_online": None, "request_table": True}, []),
        ({"request_online": False}, []),
        ({"order_price": 3.01}, []),
        ({"order_price": 2.99}, []),
        ({"order_price": 3.02}, ["PRICE_MISMATCH"]),
        ({"order_price": -3.0}, ["PRICE_MISMATCH"]),
        ({"order_price": 150.0}, ["PRICE_MISMATCH"]),
        ({"order_price": 1e30}, ["PRICE_MISMATCH"]),
        ({"items": []}, ["PRICE_MISMATCH"]),
        ({"items": None, "order_price": None}, []),
        ({"items": "absent", "order_price": "absent"}, []),
        ({"items": [{"unit_price": 2.5}], "order_price": 0}, []),
        ({"items": [{"quantity": 2}], "order_price": 0}, []),
        ({"items": [{"unit_price": None, "quantity": 2}], "order_price": 0}, []),
        ({"items": [{"unit_price": 2.0, "quantity": 0.5}], "order_price": 1}, []),
        ({"items": [{"unit_price": 0.1, "quantity": 3}], "order_price": 0.3}, []),
        ({"items": [{"unit_price": 100.01, "quantity": 1}], "order_price": 100.0}, []),
        (
            {"phone_number": "1", "request_table": True, "order_price": 9},
            ["INVALID_PHONE", "MODE_CONFLICT", "PRICE_MISMATCH"],
        ),
    ],
)
def test_rules(spark, fields, errors):
    (row,) = check(spark, order(**fields))
    assert row.errors == errors
    assert row.route == ("error" if errors else "valid")
    assert row.reason is None


@pytest.mark.parametrize(
    ("value", "reason"),
    [
        ('{"order_id":', "NOT_JSON"),
        ("plain text", "NOT_JSON"),
        ("", "NOT_JSON"),
        (None, "NOT_JSON"),
        (order() + " tail", "NOT_JSON"),
        (order() + order(), "NOT_JSON"),
        (order() + "," + order(), "NOT_JSON"),
        ("[" + order() + "]", "NOT_OBJECT"),
        ("null", "NOT_OBJECT"),
        ("12", "NOT_OBJECT"),
        ('"text"', "NOT_OBJECT"),
        (order(phone_number=12), "BAD_FIELD_TYPE"),
        (order(order_id=12), "BAD_FIELD_TYPE"),
        (order(request_online="false"), "BAD_FIELD_TYPE"),
        (order(request_table=1), "BAD_FIELD_TYPE"),
        (order(order_price="3.0"), "BAD_FIELD_TYPE"),
        (order(items={"unit_price": 1}), "BAD_FIELD_TYPE"),
        (order(items=[1, 2]), "BAD_FIELD_TYPE"),
        (order(items=[None]), "BAD_FIELD_TYPE"),
        (order(items=[{"unit_price": "1.5"}]), "BAD_FIELD_TYPE"),
    ],
)
def test_malformed(spark, value, reason):
    (row,) = check(spark, value)
    assert (row.route, row.reason, row.errors) == ("malformed", reason, None)


def test_a_bad_message_does_not_touch_the_others(spark):
    rows = check(spark, order(), "{", order(order_price=9))
    assert [row.route for row in rows] == ["valid", "malformed", "error"]


def test_default_id_and_surrounding_blanks(spark):
    rows = check(spark, order(order_id="absent"), order(order_id=None), f" \n{order()} ")
    assert [row.order_id for row in rows] == ["UNKNOWN_ID", "UNKNOWN_ID", "o1"]


def test_messages_keep_the_original_text(spark):
    odd = '{ "extra": {"b":1,  "a":[1]}, "phone_number":"12", "order_id":"x" }'
    good = '{"phone_number":"080", "unknown": "kept"}'
    rows = spark.createDataFrame([(odd,), (good,), ("[]",)], "value string")
    routed = validate.routed_messages(validate.check_messages(rows))
    found = {row.route: row for row in routed.collect()}
    assert (found["valid"].key, found["valid"].value) == ("UNKNOWN_ID", good)
    assert (found["malformed"].key, found["malformed"].value) == (None, "[]")
    assert found["error"].key == "x"
    assert odd in found["error"].value
    assert json.loads(found["error"].value) == {
        "original_order": json.loads(odd),
        "errors": ["INVALID_PHONE"],
        "error_count_type": "INVALID_PHONE",
    }


def test_several_errors_are_marked_as_such(spark):
    rows = spark.createDataFrame([(order(phone_number="1", order_price=9),)], "value string")
    (row,) = validate.routed_messages(validate.check_messages(rows)).collect()
    assert json.loads(row.value)["error_count_type"] == "MULTI"


def test_typed_orders_follow_the_same_rules(spark):
    values = [order(order_id=str(n), order_price=p) for n, p in enumerate([3.0, 3.02, -3.0, None])]
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    typed = rows.select(F.from_json("value", ORDER).alias("o")).select("o.*")
    assert [r.order_id for r in validate.only_valid(typed).collect()] == ["0"]
    by_message = {r.order_id: r.errors for r in validate.check_messages(rows).collect()}
    by_type = {r.order_id: r.errors for r in validate.with_errors(typed).collect()}
    assert by_message == by_type


def test_tolerance_is_a_parameter(spark):
    rows = spark.createDataFrame([(order(order_price=3.5),)], "value string")
    (row,) = validate.check_messages(rows, tolerance=0.5).collect()
    assert row.route == "valid"


def test_random_orders_follow_a_plain_statement_of_the_rules(spark):
    draw = random.Random(11)
    expected, values = {}, []
    for number in range(400):
        basket = [
            {"unit_price": draw.randrange(1, 90000) / 100, "quantity": draw.randrange(0, 5)}
            for _ in range(draw.randrange(0, 6))
        ]
        total = sum((Decimal(str(i["unit_price"])) * i["quantity"] for i in basket), Decimal(0))
        off = draw.choice([0, 0, 0, 1, -1, 2, -2, 500]) / Decimal(100)
        phone = draw.choice(["+91", "080", "91", "0+91", ""]) + "555"
        online, table = draw.random() < 0.5, draw.random() < 0.5
        rules = {
            "INVALID_PHONE": phone[:3] not in ("+91", "080"),
            "MODE_CONFLICT": online and table,
            "PRICE_MISMATCH": abs(off) > Decimal("0.01"),
        }
        expected[str(number)] = [code for code, broken in rules.items() if broken]
        fields = {"phone_number": phone, "request_online": online, "request_table": table}
        values.append(
            order(order_id=str(number), items=basket, order_price=float(total + off), **fields)
        )
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    found = {r.order_id: r.errors for r in validate.check_messages(rows).collect()}
    assert found == expected


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ('{"order_id":"x","phone_number":"+91 1","order_price":0,"items":[]},{"end":true}],"x":[0', "NOT_JSON"),
        ('{"order_id":"x","phone_number":"+91 1","order_price":0,"items":[]},{"end":true}', "NOT_JSON"),
        ('{"order_id":"x","phone_number":"+91 1","order_price":"NaN","items":[]}', "BAD_FIELD_TYPE"),
        ('{"order_id":"x","phone_number":"+91 1","order_price":"Infinity","items":[]}', "BAD_FIELD_TYPE"),
        ('{"order_id":"x","phone_number":"+91 1","order_price":0,"items":[]}', None),
    ],
)
def test_only_one_json_object_is_a_message(spark, text, reason):
    found = validate.check_messages(spark.createDataFrame([(text,)], "value string")).first()
    assert found.reason == reason
    assert (found.route == "malformed") == (reason is not None)


def test_untyped_records_are_not_valid(spark):
    rows = [("1", "+91 1", None), ("2", "+91 1", "{...}")]
    orders = spark.createDataFrame(rows, "order_id string, phone_number string, _corrupt_record string").selectExpr(
        "*", "false as request_online", "false as request_table", "0d as order_price",
        "cast(array() as array<struct<unit_price:double,quantity:int>>) as items",
    )
    assert [r.order_id for r in validate.only_valid(orders).collect()] == ["1"]
