"""Jobs end to end through the command line."""

import json

import pytest

from orderflow.__main__ import main
from orderflow.sources import files, streams


def lines(path, rows):
    path.mkdir()
    (path / "part.txt").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    return str(path)


def order(number, **fields):
    base = {
        "order_id": str(number),
        "user_id": "u",
        "restaurant_id": 1,
        "restaurant_name": "Spice Room",
        "restaurant_city": "north",
        "phone_number": "080",
        "request_online": True,
        "order_time": f"2024-05-01T12:{number:02d}:00Z",
        "items": [{"food_item": "naan", "unit_price": 2.5, "quantity": 2}],
        "order_price": 5.0,
    }
    return base | fields


@pytest.mark.parametrize("options", [[], ["--infer"], ["--only-valid", "--all-hours"]])
def test_history(spark, tmp_path, capsys, options):
    rows = [order(1), order(2, order_price=7.5), order(3, request_table=False)]
    source = lines(tmp_path / "in", rows)
    main(["history", source, *options])
    printed = capsys.readouterr().out
    assert "naan" in printed
    assert ("10.00" if "--only-valid" in options else "17.50") in printed


@pytest.mark.parametrize("parquet", [False, True])
def test_history_items_of_every_shape(spark, tmp_path, capsys, parquet):
    shapes = [
        {"food_item": "naan", "unit_price": 2.5, "quantity": "5"},
        {"item_id": 7, "quantity": 2},
        {"item_name": "dal", "quantity": 3.0},
        {"label": "rice", "number": 4},
        {"food_item": "tea", "unit_price": 9.0},
        "naan",
    ]
    rows = [order(k, items=[item]) for k, item in enumerate(shapes)] + [order(8, items=["dal", {"item_name": "dal"}])]
    source = lines(tmp_path / "in", rows)
    with open(f"{source}/part.txt", "a") as file:
        file.write("{broken\n")
    output = str(tmp_path / "out")
    main(["history", source, "--output", output, *(["--parquet", str(tmp_path / "pq")] if parquet else [])])
    assert "lines that did not parse: 1" in capsys.readouterr().out
    found = spark.read.parquet(f"{output}/most-sold-items")
    assert {tuple(r) for r in found.collect()} == {("naan", 6), ("dal", 5), ("rice", 4), ("7", 2), ("tea", 1)}


def test_history_as_parquet(spark, tmp_path, capsys):
    source = lines(tmp_path / "in", [order(1)])
    main(["history", source, "--parquet", str(tmp_path / "pq")])
    assert spark.read.parquet(str(tmp_path / "pq")).count() == 1


def test_load_and_reports(spark, listing, tmp_path, capsys):
    files.write_listing(listing({}, {"name": "B", "rate": "NEW"}), str(tmp_path / "csv"))
    main(["load", str(tmp_path / "csv"), str(tmp_path / "root"), "first"])
    assert "metrics: 2 new rows" in capsys.readouterr().out
    main(["load", str(tmp_path / "csv"), str(tmp_path / "root"), "second"])
    assert "metrics: 0 new rows" in capsys.readouterr().out
    main(["reports", str(tmp_path / "root"), "--min-rating", "4", "--min-restaurants", "2"])
    printed = capsys.readouterr().out
    assert "Hill Side" in printed and "Mid-Range" in printed
    main(["dimension", str(tmp_path / "csv"), str(tmp_path / "dim")])
    assert spark.read.parquet(str(tmp_path / "dim")).count() == 2


def test_validate_then_fraud(spark, tmp_path):
    rows = [order(1), order(2, restaurant_city="south"), order(3, phone_number="1")]
    source = lines(tmp_path / "in", rows)
    routed = str(tmp_path / "routed")
    main(["validate", source, routed, str(tmp_path / "c1"), "--available-now"])
    found = spark.read.parquet(routed)
    assert {r.route: r["count"] for r in found.groupBy("route").count().collect()} == {
        "valid": 2, "error": 1,
    }
    found = {}
    for name, flags in {"told": ["--routed"], "seen": []}.items():
        alerts = str(tmp_path / name)
        main(["fraud", routed, alerts, str(tmp_path / f"c-{name}"), "--available-now", *flags])
        found[name] = sorted(map(str, spark.read.parquet(alerts).drop("batch_id").collect()))
        assert spark.read.parquet(alerts).select("user_id").distinct().count() == 1
    assert found["told"] == found["seen"]


def test_only_valid_messages_are_read(spark, tmp_path):
    routes = ["valid", "error", "malformed", "valid"]
    rows = spark.createDataFrame([(f"k{n}", f"v{n}", r) for n, r in enumerate(routes)], "key string, value string, route string")
    rows.write.partitionBy("route").parquet(str(tmp_path / "routed"))
    assert streams.is_routed(spark, str(tmp_path / "routed"))
    assert not streams.is_routed(spark, str(tmp_path)) and not streams.is_routed(spark, str(tmp_path / "none"))
    query = (
        streams.valid_messages(spark, str(tmp_path / "routed"), 1).writeStream.format("memory")
        .queryName("valid_only").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(map(tuple, spark.table("valid_only").collect())) == [("k0", "v0"), ("k3", "v3")]
