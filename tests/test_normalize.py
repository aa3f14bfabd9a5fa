"""Listing to tables, audits and idempotent loads."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderflow.functions.keys import stable_id
from orderflow.functions.text import commas_to_int, digits_to_int, rate_decimal
from orderflow.operators import audit, normalize
from orderflow.sinks import tables
from orderflow.sources import files


def apply(spark, function, *values):
    df = spark.createDataFrame(list(enumerate(values)), "n int, v string")
    return [r[0] for r in df.orderBy("n").select(function(F.col("v"))).collect()]


def test_rates(spark):
    texts = ["4.1/5", " 3.9 /5", "NEW", "-", "", None, "abc", "4.256/5", "4", "12.5/5", "-3/5"]
    found = apply(spark, rate_decimal, *texts)
    d = Decimal
    assert found == [
        d("4.10"), d("3.90"), None, None, None, None, None, d("4.26"), d("4.00"), None, d("-3.00"),
    ]


def test_whole_numbers(spark):
    assert apply(spark, digits_to_int, "1,200", "300.5", "", "n/a", None, "99999999999") == [
        1200, 3005, None, None, None, None,
    ]
    assert apply(spark, commas_to_int, "1,200", " 300 ", "300.5", "", None, "-5") == [
        1200, 300, None, None, None, -5,
    ]


def test_keys_tell_null_empty_and_boundaries_apart(spark):
    pairs = [("a", None), ("a", ""), ("", "a"), (None, "a"), ("a,1:b", ""), ("a", "1:b")]
    df = spark.createDataFrame(pairs, "x string, y string")
    assert df.select(stable_id("x", "y")).distinct().count() == len(pairs)


def test_locations_need_both_parts(spark, listing):
    staging = listing({}, {}, {"location": None}, {"city": None}, {"city": "South"})
    found = normalize.locations(staging).collect()
    assert sorted((r.location_name, r.listed_in_city) for r in found) == [
        ("Hill Side", "North"),
        ("Hill Side", "South"),
    ]


def test_null_phones_are_equal_and_names_may_be_missing(spark, listing):
    staging = listing({"phone": None}, {"phone": None}, {"name": None}, {"address": None})
    assert normalize.restaurants(staging).count() == 3
    with_table = normalize.restaurants(staging, normalize.locations(staging))
    assert with_table.exceptAll(normalize.restaurants(staging)).count() == 0


def test_two_phones_fan_out_by_default_only(spark, listing):
    staging = listing({"phone": "1"}, {"phone": "2"}, {"name": None}, {"phone": None, "name": "B"})
    venues = normalize.restaurants(staging)
    assert normalize.metrics(staging, venues).count() == 5  # 2 rows x 2 phones, and B
    assert normalize.metrics(staging, match="exact").count() == 4
    with pytest.raises(ValueError, match="unknown match"):
        normalize.metrics(staging, venues, match="other")


def test_metric_values(spark, listing):
    staging = listing({"online_order": "yes", "book_table": "Yes", "cost": "1,500", "votes": "x"})
    row = normalize.metrics(staging, normalize.restaurants(staging)).first()
    assert (row.online_order, row.book_table, row.votes) == (False, True, None)
    assert (row.rate, row.approx_cost_two) == (Decimal("4.10"), 1500)


def test_exact_copies_stay_rows(spark, listing):
    staging = listing({}, {}, {})
    assert normalize.metrics(staging, normalize.restaurants(staging)).count() == 3


def test_loading_twice_adds_nothing(spark, listing, tmp_path):
    root = str(tmp_path)
    staging = listing({}, {}, {"phone": "2"}, {"city": "South"}, {"rate": "NEW"})
    first = tables.load_listing(staging, root, "a")
    assert first.rows == {"locations": 2, "restaurants": 3, "metrics": 9}
    before = {t: tables.read_table(spark, root, t).collect() for t in tables.TABLES}
    assert tables.load_listing(staging, root, "b").rows == {
        "locations": 0, "restaurants": 0, "metrics": 0,
    }
    more = staging.unionByName(listing({"name": "New Place"}))
    assert tables.load_listing(more, root, "c").rows == {
        "locations": 0, "restaurants": 1, "metrics": 1,
    }
    for table, rows in before.items():
        after = tables.read_table(spark, root, table)
        added = 1 if table != "locations" else 0
        assert after.count() == len(rows) + added
    with pytest.raises(ValueError, match="already published"):
        tables.load_listing(staging, root, "c")


def test_a_failed_load_shows_nothing_and_can_be_repeated(spark, listing, tmp_path):
    root = str(tmp_path)
    staging = listing({})
    broken = staging.withColumn("votes", F.raise_error(F.lit("disk full")).cast("string"))
    with pytest.raises(Exception, match="disk full"):
        tables.load_listing(broken, root, "a")
    assert all(tables.read_table(spark, root, table).count() == 0 for table in tables.TABLES)
    assert tables.load_listing(staging, root, "a").rows["metrics"] == 1
    assert tables.published_runs(spark, root) == ["a"]


def test_upsert_ignores_known_rows(spark, listing):
    target = normalize.locations(listing({}))
    rows = normalize.locations(listing({}, {"city": "South"}))
    assert normalize.upsert_ignore(rows, target, "location_id").count() == 2


def test_audit_counts(spark, listing):
    staging = listing(
        {},
        {"phone": "2"},
        {"location": None},
        {"rate": "abc"},
        {"rate": "99/5"},
        {"rate": "NEW"},
        {"votes": "99999999999"},
        {"cost": "99,999,999,999"},
        {"votes": "none"},
        {"name": None},
        {"phone": "9" * 101, "city": "South"},
    )
    found = {r.check_name: r.row_count for r in audit.load_audit(staging).collect()}
    venues = normalize.restaurants(staging)
    assert found == {
        "staged_rows": 11,
        "rows_without_location": 1,
        "rows_without_name_or_address": 1,
        "unreadable_rates": 2,
        "unreadable_votes": 1,
        "unreadable_costs": 1,
        "over_long_rows": 1,
        "location_rows": normalize.locations(staging).count(),
        "restaurant_rows": venues.count(),
        "metric_rows": normalize.metrics(staging, venues).count(),
    }


def test_copies_count_alike_in_every_load(spark, listing, tmp_path):
    root = str(tmp_path / "root")
    assert tables.load_listing(listing({}), root, "one").rows["metrics"] == 1
    assert tables.load_listing(listing({}, {}, {}), root, "two").rows["metrics"] == 2
    assert tables.load_listing(listing({}, {}), root, "three").rows["metrics"] == 0
    found = tables.read_table(spark, root, "metrics")
    assert (found.count(), found.select("metric_id").distinct().count()) == (3, 3)
    many = normalize.numbered_copies(spark.range(10_000).selectExpr("'a' metric_id", "'b' c"))
    assert many.distinct().count() == many.count() == 10_000


def test_audit_of_an_empty_listing(spark, listing):
    found = audit.load_audit(listing({}).limit(0)).collect()
    assert {r.row_count for r in found} == {0}


def test_orphans(spark):
    parent = spark.createDataFrame([("p1",)], "k string")
    child = spark.createDataFrame([("p1",), ("p2",), ("p2",), (None,)], "k string")
    assert [tuple(r) for r in audit.orphans(child, parent, "k").collect()] == [("p2", 2)]


CSV = (
    "address,name,online_order,book_table,rate,votes,phone,location,rest_type,cuisines,"
    "approx_cost(for two people),menu_item,listed_in(type),listed_in(city)\n"
    '"1 Road, Hill",Say ""Hi"",Yes,No,4.1/5,10,"080 1\n080 2",Hill,Cafe,"Thai, Wok",'
    '"1,200","[\'a\', ""b\'s""]",Delivery,North\n'
    "short,row\n"
    '2,Two,Yes,No,NEW,1,"",Hill,Cafe,Thai,100,[],Buffet,North,extra,more\n'
)


def test_ragged_and_multiline_csv(spark, tmp_path):
    (tmp_path / "in.csv").write_text(CSV.replace('Say ""Hi""', '"Say ""Hi"""'), encoding="utf-8")
    rows = {r.name: r for r in files.read_listing(spark, str(tmp_path / "in.csv")).collect()}
    assert set(rows) == {'Say "Hi"', "row", "Two"}
    first = rows['Say "Hi"']
    assert first.address == "1 Road, Hill"
    assert first.phone == "080 1\n080 2"
    assert first.menu_item == "['a', \"b's\"]"
    assert first["listed_in(city)"] == "North"
    assert rows["row"].rate is None
    assert (rows["Two"].phone, rows["Two"]["listed_in(city)"]) == (None, "North")


def test_csv_by_header_name(spark, tmp_path):
    (tmp_path / "in.csv").write_text("rate,name,unused\n4.0/5,Here,x\n", encoding="utf-8")
    (row,) = files.read_listing_by_header(spark, str(tmp_path / "in.csv")).collect()
    assert (row.name, row.rate, row.phone) == ("Here", "4.0/5", None)


def test_csv_round_trip(spark, listing, tmp_path):
    staging = listing({"name": "  two  blanks ", "phone": 'a\n"b",c'}, {"menu_item": None})
    files.write_listing(staging, str(tmp_path / "csv"))
    again = tables.land(files.read_listing(spark, str(tmp_path / "csv")), str(tmp_path / "pq"))
    assert again.exceptAll(staging).count() == staging.exceptAll(again).count() == 0
