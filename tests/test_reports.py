"""The four restaurant reports."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow import schemas
from orderflow.functions.numbers import mean_to_cents
from orderflow.plans import restaurant_reports as reports


@pytest.fixture
def star(spark):
    """Tables from (restaurant, location, rate, cost, votes, online, type) rows."""

    def build(rows, places=None):
        places = places or {}
        metrics, venues, spots = [], {}, {}
        for number, (rid, lid, rate, cost, votes, online, kind) in enumerate(rows):
            flags, score = (online, False), rate and Decimal(rate)
            metrics.append((str(number), rid, *flags, score, votes, None, None, cost, None, kind))
            venues[rid] = (rid, f"name {rid}", None, None, lid)
            spots[lid] = (lid, *places.get(lid, (f"spot {lid}", f"city {lid}")))
        return (
            spark.createDataFrame(metrics, schemas.METRICS),
            spark.createDataFrame(list(venues.values()), schemas.RESTAURANTS),
            spark.createDataFrame(list(spots.values()), schemas.LOCATIONS),
        )

    return build


def test_means_round_the_exact_quotient(spark):
    # 1/8 = 0.125 rounds up; 4999999/1000000000 = 0.004999999 must not round twice.
    rows = [(100, 800), (10050, 100), (-50, 100), (499999900, 1000000000), (7, 0)]
    df = spark.createDataFrame(rows, "t bigint, n bigint")
    found = [r[0] for r in df.select(mean_to_cents(F.col("t"), F.col("n"))).collect()]
    assert found == [Decimal("0.00"), Decimal("1.01"), Decimal("-0.01"), Decimal("0.00"), None]


def test_delivery(spark, star):
    rows = [
        ("r1", "l", None, 100, 1, True, "Delivery"),
        ("r1", "l", None, 101, 1, True, "Delivery"),
        ("r2", "l", None, None, 1, True, "Delivery"),
        ("r3", "l", None, 999, 1, True, "Buffet"),
    ]
    (row,) = reports.delivery_summary(star(rows)[0]).collect()
    assert tuple(row) == (2, Decimal("100.50"))
    (none,) = reports.delivery_summary(star(rows)[0], "Pubs").collect()
    assert tuple(none) == (0, None)


def test_online_by_city(star):
    rows = [
        ("r1", "a", None, 100, 5, True, "x"),
        ("r1", "a", None, 200, 5, False, "x"),
        ("r2", "a", None, 300, None, True, "x"),
        ("r3", "b", None, None, 7, False, "x"),
        ("r4", None, None, 50, 7, False, "x"),
    ]
    found = reports.online_order_by_city(*star(rows)).collect()
    assert [tuple(r) for r in found] == [
        ("city a", "Yes", Decimal("200.00"), 5),
        ("city a", "No", Decimal("200.00"), 5),
        ("city b", "No", None, 7),
    ]


def test_tier_limits(star):
    rows = [
        (f"r{cost}", "a", "4.00", cost, 1, True, "x") for cost in (1, 500, 501, 999, 1000, None)
    ]
    rows.append(("r500", "a", "5.00", 100, 1, True, "x"))
    found = reports.pricing_tiers(*star(rows)).collect()
    assert [tuple(r) for r in found] == [
        ("city a", "Budget", 2, Decimal("4.33")),
        ("city a", "Mid-Range", 2, Decimal("4.00")),
        ("city a", "Premium", 1, Decimal("4.00")),
    ]


def test_neighborhood_limits_are_strict_and_per_location(star):
    def block(lid, n, rate):
        return [(f"{lid}{i}", lid, rate, 1, 1, True, "x") for i in range(n)]

    rows = block("a", 50, "4.20") + block("b", 50, "4.21") + block("c", 49, "4.90")
    rows += block("d", 50, "4.30") + [("d0", "d", None, 1, 1, True, "x")]
    places = {"b": ("Same Name", "North"), "d": ("Same Name", "South")}
    found = reports.top_neighborhoods(*star(rows, places)).collect()
    assert sorted(tuple(r) for r in found) == [
        ("Same Name", Decimal("4.21"), 50),
        ("Same Name", Decimal("4.30"), 50),
    ]
    assert reports.top_neighborhoods(*star(rows, places), "4.1", 49).count() == 4
