"""Fraud rules in batch and as streams."""

import datetime as dt
import json
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from orderflow.operators import fraud, validate
from orderflow.plans.catalog import SAMPLE_WINDOWS
from orderflow.sinks.streams import console_output, file_output, kafka_output, update_output, update_outputs
from orderflow.sources import streams
from orderflow.sources.files import read_messages
from orderflow.streaming import jobs
from orderflow.streaming.monitor import ProgressLog

START = dt.datetime(2024, 5, 1, 12, 0, tzinfo=dt.UTC)
WINDOWS = fraud.Windows("30 minutes", "10 minutes", "60 minutes", "20 minutes", threshold=5)


def message(number, user, minutes, city="north", **fields):
    moment = START + dt.timedelta(minutes=minutes)
    body = {
        "order_id": str(number),
        "user_id": user,
        "restaurant_city": city,
        "order_time": moment.isoformat().replace("+00:00", "Z"),
    }
    return json.dumps(body | fields)


def alerts_of(spark, values, windows=WINDOWS):
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    return fraud.fraud_alerts(fraud.with_event_time(fraud.parse_orders(rows)), windows)


def keys(alerts):
    """Alerts as (rule, user, minutes from the start of the test to the window's)."""

    def minutes(time):
        return int((time.replace(tzinfo=dt.UTC) - START).total_seconds() // 60)

    return sorted(
        (r.alert_type[:3], r.user_id, minutes(r.window_start)) for r in alerts.collect()
    )


def test_two_cities_within_the_window(spark):
    near = [message(1, "u", 0), message(2, "u", 29, "south")]
    assert keys(alerts_of(spark, near)) == [("GEO", "u", 0)]
    edge = [message(1, "u", 0), message(2, "u", 30, "south")]
    assert keys(alerts_of(spark, edge)) == []
    close = [message(1, "u", 25), message(2, "u", 26, "south"), message(3, "u", 27)]
    assert keys(alerts_of(spark, close)) == [("GEO", "u", 0), ("GEO", "u", 10), ("GEO", "u", 20)]


def test_reasons_list_each_city_once_in_order(spark):
    rows = [message(n, "u", n, city) for n, city in enumerate(["south", "north", "south", "east"])]
    reason = alerts_of(spark, rows).first().trigger_reason
    assert reason == "User placed orders across cities: [east, north, south]"


def test_more_than_five_orders(spark):
    assert keys(alerts_of(spark, [message(n, "u", n) for n in range(5)])) == []
    found = alerts_of(spark, [message(n, "u", n) for n in range(6)])
    assert keys(found) == [("VEL", "u", -40), ("VEL", "u", -20), ("VEL", "u", 0)]
    assert {r.trigger_reason for r in found.collect()} == {
        "User exceeded checkout rate with frequency count: 6"
    }


def test_missing_values(spark):
    rows = [message(1, "u", 0), message(2, "u", 1, None), message(3, "u", 2, order_time="soon")]
    rows += ["{broken", message(4, "u", 3, "south", order_time=None)]
    rows += [message(None, "v", n, order_id=None) for n in range(9)]
    assert keys(alerts_of(spark, rows)) == []


def test_coded_windows_are_seconds(spark):
    rows = [message(1, "u", 0), message(2, "u", 0.05, "south"), message(3, "u", 5, "south")]
    assert len(keys(alerts_of(spark, rows, fraud.AS_CODED))) == 2


def test_payload(spark):
    rows = [message(1, "u", 0), message(2, "u", 29, "south")]
    alerts = alerts_of(spark, rows)
    (row,) = fraud.alert_messages(alerts).collect()
    assert row.key == "u"
    assert json.loads(row.value) == {
        "user_id": "u",
        "alert_type": "GEOGRAPHICAL_IMPOSSIBILITY",
        "trigger_reason": "User placed orders across cities: [north, south]",
    }
    (wide,) = fraud.alert_messages(alerts, with_window=True).collect()
    assert json.loads(wide.value).keys() >= {"window_start", "window_end"}


def test_alerts_equal_a_plain_count(spark):
    """Brute force over random orders, one user with a third of them."""
    draw = random.Random(7)
    users = ["hot"] * 10 + [f"u{n}" for n in range(20)]
    orders = [
        (draw.choice(users), round(draw.uniform(0, 300), 3), draw.choice("abc"))
        for _ in range(600)
    ]
    values = [message(n, *order) for n, order in enumerate(orders)]

    def windows(size, slide):
        for start in range(-size, 301, slide):
            for user in {u for u, _, _ in orders}:
                inside = (o for o in orders if o[0] == user and start <= o[1] < start + size)
                yield start, user, [city for _, _, city in inside]

    expected = [("GEO", u, s) for s, u, c in windows(30, 10) if len(set(c)) > 1]
    expected += [("VEL", u, s) for s, u, c in windows(60, 20) if len(c) > 5]
    assert keys(alerts_of(spark, values)) == sorted(expected)


# --- streams -----------------------------------------------------------------


def write_files(folder, *groups):
    """One file per group; the file source reads them by modification time."""
    folder.mkdir(exist_ok=True)
    for values in groups:
        number = len(list(folder.iterdir()))
        file = folder / f"{number:03d}.txt"
        file.write_text("\n".join(values) + "\n")
        os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))


def run_alerts(spark, tmp_path, per_batch=1, windows=WINDOWS):
    source = streams.text_messages(spark, str(tmp_path / "in"), per_batch)
    alerts = jobs.detect_fraud(source, windows)
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    query = update_output(alerts, out, checkpoint, available_now=True).start()
    query.awaitTermination()
    return query, fraud.latest_alerts(spark.read.parquet(out))


def in_order(count, users=5, seed=3):
    draw = random.Random(seed)
    return [
        message(n, f"u{draw.randrange(users)}", n * 2, draw.choice(["north", "south"]))
        for n in range(count)
    ]


def test_stream_equals_batch(spark, tmp_path):
    values = in_order(120)
    write_files(tmp_path / "in", values[:30], values[30:70], values[70:100], values[100:])
    _, found = run_alerts(spark, tmp_path)
    expected = alerts_of(spark, values)
    assert expected.count() > 20
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_restart_continues(spark, tmp_path):
    values = in_order(120, seed=5)
    write_files(tmp_path / "in", values[:40], values[40:80])
    run_alerts(spark, tmp_path)
    write_files(tmp_path / "in", values[80:])
    query, found = run_alerts(spark, tmp_path)
    assert query.lastProgress is not None
    expected = alerts_of(spark, values)
    assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0


def test_late_rows_change_nothing_and_are_counted(spark, tmp_path):
    on_time = [message(1, "u", 0), message(2, "w", 200)]
    late = [message(4, "u", 5, "south"), message(5, "w", 202)]
    # A batch is held against the watermark that held before the last one.
    write_files(tmp_path / "in", on_time, [message(3, "w", 201)], late)
    query, found = run_alerts(spark, tmp_path)
    assert found.count() == 0
    dropped = [
        state["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for state in json.loads(progress.json)["stateOperators"]
    ]
    # One late order is in three windows of each rule.
    assert sum(dropped) == 6


def test_alert_spread_over_two_files_is_reported_once(spark, tmp_path):
    write_files(
        tmp_path / "in",
        [message(1, "u", 0), message(2, "u", 1, "south")],
        [message(3, "u", 2, "east")],
    )
    _, found = run_alerts(spark, tmp_path)
    reasons = {r.trigger_reason for r in found.collect()}
    assert reasons == {"User placed orders across cities: [east, north, south]"}
    assert found.count() == 3


def test_routes_are_written_exactly_once(spark, tmp_path):
    good = {"phone_number": "080", "order_price": 0}
    batches = [
        [message(n, "u", n, **good) for n in range(5)] + ["{", message(9, "u", 9)],
        [message(n, "u", n, **good) for n in range(20, 23)] + ["[]"],
    ]
    source, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        routed = jobs.route_orders(streams.text_messages(spark, str(source), 1))
        checkpoint = str(tmp_path / "checkpoint")
        file_output(routed, out, checkpoint, "route", available_now=True).start().awaitTermination()
        return spark.read.parquet(out)

    write_files(source, batches[0])
    assert run().count() == 7
    write_files(source, batches[1])
    stream = run().select("route", "key", "value")
    batch = validate.routed_messages(validate.check_messages(read_messages(spark, str(source))))
    assert stream.exceptAll(batch).count() == batch.exceptAll(stream).count() == 0
    counts = {r.route: r["count"] for r in stream.groupBy("route").count().collect()}
    assert counts == {"valid": 8, "error": 1, "malformed": 2}


def test_valid_messages_feed_the_alerts(spark, tmp_path):
    good = {"phone_number": "080", "order_price": 0}
    values = [message(1, "u", 0, **good), message(2, "u", 1, "south", **good)]
    values += [message(3, "v", 0, **good), message(4, "v", 1, "south")]
    rows = spark.createDataFrame([(v,) for v in values], "value string")
    routed = jobs.route_orders(rows).filter(F.col("route") == "valid")
    alerts = fraud.fraud_alerts(fraud.with_event_time(fraud.parse_orders(routed)), WINDOWS)
    assert {r.user_id for r in alerts.collect()} == {"u"}


def test_topics(spark):
    rows = spark.createDataFrame([("{",), ("{}",)], "value string")
    found = {r.topic: r.value for r in jobs.to_topics(jobs.route_orders(rows)).collect()}
    assert set(found) == {"orders.malformed", "orders.errors"}


def test_parquet_messages(spark, tmp_path):
    write = spark.createDataFrame([("k", "{}")], "key string, value string").write
    write.parquet(str(tmp_path / "in"))
    source = streams.parquet_messages(spark, str(tmp_path / "in"), 1)
    assert source.isStreaming and source.columns == ["key", "value"]


def test_broker_source_needs_its_connector(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.kafka_messages(spark, "host:1", "orders.raw")
    source = jobs.to_topics(jobs.route_orders(streams.text_messages(spark, str(tmp_path))))
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_output(source, "host:1", str(tmp_path / "c")).start()


def test_console(spark, tmp_path):
    write_files(tmp_path / "in", [message(1, "u", 0), message(2, "u", 1, "south")])
    alerts = jobs.detect_fraud(streams.text_messages(spark, str(tmp_path / "in")), SAMPLE_WINDOWS)
    writer = console_output(fraud.alert_messages(alerts)).trigger(availableNow=True)
    query = writer.option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    assert query.exception() is None


def test_failures_are_logged(spark, tmp_path, caplog):
    listener = ProgressLog()
    spark.streams.addListener(listener)
    try:
        write_files(tmp_path / "in", ["x"])
        source = streams.text_messages(spark, str(tmp_path / "in"))
        bad = source.withColumn("value", F.raise_error(F.lit("sink is gone")).cast("string"))
        out, checkpoint = str(tmp_path / "o"), str(tmp_path / "c")
        writer = file_output(bad.withColumn("p", F.lit(1)), out, checkpoint, "p", True)
        with caplog.at_level("INFO"), pytest.raises(Exception, match="sink is gone"):
            writer.start().awaitTermination()
        for _ in range(50):
            if "failed" in caplog.text:
                break
            time.sleep(0.1)
        assert "sink is gone" in caplog.text
    finally:
        spark.streams.removeListener(listener)


def test_orders_without_a_user_raise_no_alert(spark):
    rows = [message(1, None, 0), message(2, None, 1, "south"), *[message(n, None, n) for n in range(3, 12)]]
    assert keys(alerts_of(spark, rows)) == []
    rows += ["{broken", "[1]", "7", "", message(30, "u", 0, order_time="soon"), message(31, "u", 0)]
    messages = spark.createDataFrame([(r,) for r in [*rows, None]], "value string")
    found = {r.reason: r.message_count for r in fraud.left_out(messages).collect()}
    assert found == {"unreadable": 5, "no user": 11, "no time": 1}


@pytest.mark.parametrize("seed", range(6))
def test_panes_give_the_alerts_of_windows(spark, seed):
    draw = random.Random(seed)
    spans = []
    for _ in range(2):
        slide = draw.choice([7, 10, 15, 20])
        spans += [f"{slide * draw.randrange(1, 4) + draw.choice([0, 5, 3])} minutes", f"{slide} minutes"]
    windows = fraud.Windows(*spans, threshold=3)
    users = ["hot"] * 4 + [f"u{n}" for n in range(6)] + [None]
    values = [
        message(None if n % 50 == 7 else n, draw.choice(users), draw.uniform(-90, 200), draw.choice(["a", "b", None]))
        for n in range(250)
    ]
    rows = spark.createDataFrame([(v,) for v in [*values, *values[:9]]], "value string")
    orders = fraud.with_event_time(fraud.parse_orders(rows))
    apart = fraud.geo_impossible(orders, windows.geo_size, windows.geo_slide).unionByName(
        fraud.velocity_spam(orders, windows.velocity_size, windows.velocity_slide, windows.threshold)
    )
    together = fraud.fraud_alerts(orders, windows)
    assert together.columns == apart.columns and together.dtypes == apart.dtypes
    assert sorted(map(str, together.collect())) == sorted(map(str, apart.collect()))
    assert apart.count() > 5


def test_both_rules_share_one_scan(spark, sf_dir):
    from orderflow.plans import catalog
    from test_plans import plan_of

    plan = plan_of(catalog.queries()["fraud_alerts_batch"](spark, sf_dir), "simple")
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 2 and "Expand" not in plan


def test_spans():
    assert fraud.micros("30 minutes") == 1_800_000_000
    assert fraud.micros("1 hour 30 minutes") == 5_400_000_000
    assert fraud.micros("1 Second") == 1_000_000
    for wrong in ("", "1 month", "minutes", "5", "-1 minutes"):
        with pytest.raises(ValueError, match="span"):
            fraud.micros(wrong)


def test_one_query_feeds_two_outputs(spark, tmp_path):
    source, seen = tmp_path / "in", []
    source.mkdir()
    (source / "a.txt").write_text("\n".join([message(1, "u", 0), message(2, "u", 1, "south")]))
    alerts = jobs.detect_fraud(streams.text_messages(spark, str(source)), WINDOWS)

    def also(batch, batch_id):
        seen.append((batch_id, sorted(r.user_id for r in batch.collect())))
        if len(seen) == 1:
            raise RuntimeError("stopped in the middle of a batch")

    def start():
        path, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
        return update_outputs(alerts, path, checkpoint, also, available_now=True).start()

    with pytest.raises(Exception, match="stopped in the middle"):
        start().awaitTermination()
    run = start()
    run.awaitTermination()
    assert [s for s in seen if s[1]] == [(0, ["u"] * 3), (0, ["u"] * 3)]
    assert sum(p["numInputRows"] for p in run.recentProgress) in (2, 4)
    assert spark.read.parquet(str(tmp_path / "out")).filter("batch_id = 0").count() == 3
