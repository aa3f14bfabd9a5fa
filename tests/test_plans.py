"""Plan shape, partition independence and skew."""

import contextlib
import io
import pathlib
import re

import pytest
from pyspark.sql import Column
from pyspark.sql import functions as F

from orderflow.operators import history, items, normalize
from orderflow.plans import catalog
from orderflow.plans import restaurant_reports as reports
from orderflow.sinks.workspace import workspace

QUERIES = catalog.queries()


def plan_of(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@pytest.mark.parametrize("name", QUERIES)
def test_no_python_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for node in ("PythonUDF", "ArrowEval", "BatchEvalPython", "InPandas", "InArrow", "CartesianProduct"):
        assert node not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name", ["top_items", "top_revenue_restaurants", "channel_leaders", "city_revenue"]
)
def test_top_k_keeps_k_rows_per_task(spark, sf_dir, name):
    assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, sf_dir))


def test_ranking_is_cut_before_the_shuffle(spark, sf_dir):
    plan = plan_of(QUERIES["popularity_rank"](spark, sf_dir), "simple")
    assert plan.count("WindowGroupLimit") == 2


def test_scans_read_only_what_is_needed(spark, sf_dir):
    plan = plan_of(QUERIES["hourly_pattern"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
    plan = plan_of(QUERIES["normalize_locations"](spark, sf_dir))
    (lineitem,) = re.findall(r"ReadSchema: struct<(l_[^>]*)>", plan)
    assert lineitem == "l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint"


def test_routing_parses_a_message_once(spark, sf_dir):
    """A filter on the route must not be pushed into the parse."""
    plan = plan_of(QUERIES["validate_valid"](spark, sf_dir), "simple")
    assert plan.count("from_json") == 1


def test_exploded_items_are_compiled(spark, sf_dir):
    """The JVM never compiles methods of more than 8,000 bytes."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans show their code after they ran
    try:
        plan = plan_of(QUERIES["items_exploded"](spark, sf_dir), "codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", plan)
    assert sizes and max(map(int, sizes)) < 8000


def test_dishes_of_lines_with_nulls(spark, tmp_path):
    """Dishes follow the line number, begin again after the last, and are NULL without one."""
    folder = "/root/testdata/sf0.001"
    for name in ("part", "supplier", "nation", "region"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").limit(1).drop("l_linenumber", "l_quantity", "l_orderkey")
    numbered = spark.createDataFrame(
        [(1, 1, 5.0), (2, 9, 6.0), (3, None, 5.0), (4, 2, None)], "l_orderkey long, l_linenumber int, l_quantity double"
    )
    lines.crossJoin(numbered).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = catalog.sample_tables.orders(spark, str(tmp_path)).collect()
    found = {r.user_id: r["items"] and [(i.food_item.split()[-1], i.quantity) for i in r["items"]] for r in orders}
    assert found == {
        "user-1": [("curry", 3)],
        "user-2": [("curry", 4), ("naan", 1)],
        "user-3": None,
        "user-4": [("curry", None), ("naan", None)],
    }


def test_reports_shuffle_metrics_by_restaurant_only(spark, sf_dir, tmp_path):
    """Metrics are added up per restaurant, and the join reuses that partitioning."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        staging = catalog.sample_tables.listing(spark, sf_dir)
        venues = normalize.restaurants(staging)
        stored = {}
        for name, df in {
            "m": normalize.metrics(staging, venues),
            "r": venues,
            "l": normalize.locations(staging),
        }.items():
            df.write.parquet(str(tmp_path / name))
            stored[name] = spark.read.parquet(str(tmp_path / name))
        plan = plan_of(reports.pricing_tiers(stored["m"], stored["r"], stored["l"]), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    # One exchange each for metrics, restaurants, locations, the totals per
    # location (grouped and joined), and the totals per city.
    assert keys.count("restaurant_id") == 2
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_results_do_not_depend_on_partitions(spark, sf_dir, partitions):
    orders = catalog.sample_tables.orders(spark, sf_dir)
    spread = orders.repartition(partitions)
    for report in (history.top_revenue_restaurants, history.city_revenue, history.channel_leaders):
        assert report(spread).collect() == report(orders).collect()
    found, expected = (history.top_items(items.resolve_items(df)) for df in (spread, orders))
    assert found.collect() == expected.collect()


def test_one_restaurant_with_a_third_of_all_rows(spark, listing):
    """Results on a lopsided listing equal plain sums."""
    shares = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    values = listing({}).first().asDict() | {
        "name": F.concat(F.lit("v"), shares),
        "approx_cost(for two people)": (F.col("id") % 1500).cast("string"),
    }
    staging = spark.range(3000).select(
        *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in values.items()]
    )
    venues = normalize.restaurants(staging)
    metrics = normalize.metrics(staging, venues)
    found = reports.pricing_tiers(metrics, venues, normalize.locations(staging)).collect()
    tiers = {"Budget": set(), "Mid-Range": set(), "Premium": set()}
    for n in range(3000):
        cost = n % 1500
        tier = "Budget" if cost <= 500 else "Mid-Range" if cost < 1000 else "Premium"
        tiers[tier].add(0 if n % 3 == 0 else n)
    assert {r.pricing_tier: r.total_restaurants for r in found} == {
        tier: len(members) for tier, members in tiers.items()
    }


def test_many_tied_favorites_stay_spread(spark):
    """All items of a city tie: no window gathers them, and none is lost."""
    orders = spark.range(5000).select(
        F.lit("north").alias("restaurant_city"),
        F.array(F.concat(F.lit("dish "), F.col("id"))).alias("items"),
    )
    favorites = history.regional_favorites(items.resolve_items(orders))
    assert "Window" not in plan_of(favorites)
    assert favorites.count() == 5000


def test_intermediate_tables_go_to_the_shared_folder(spark, sf_dir):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert workspace(spark, "x").startswith(f"{shared}/x-")
    written = QUERIES["orders_json_scan"](spark, sf_dir).inputFiles()
    assert all(f"{shared}/orders-json-" in file for file in written)


def test_messages_are_stored_compressed(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog.files, "MESSAGES_PER_FILE", 1000)
    messages = catalog.sample_tables.order_messages(spark, sf_dir).select("value")
    catalog.files.write_messages(messages, str(tmp_path / "m"))
    stored = [f for f in (tmp_path / "m").iterdir() if f.name.startswith("part-")]
    size = messages.agg(F.sum(F.octet_length("value"))).first()[0]
    assert len(stored) > 5 and sum(f.stat().st_size for f in stored) < size / 4
    found = spark.read.text(str(tmp_path / "m"))
    assert found.count() == messages.count() and found.exceptAll(messages).count() == 0
    written = QUERIES["orders_json_scan"](spark, sf_dir).inputFiles()
    assert written and all(file.endswith(".txt.gz") for file in written)


def test_routes_are_stored_compressed(spark, sf_dir):
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.glob("routed-*")) | set(shared.glob("messages-*"))
    assert QUERIES["validate_stream_route"](spark, sf_dir).count() == 3
    after = set(shared.glob("routed-*")) | set(shared.glob("messages-*"))
    files = [f.name for folder in after - before for f in folder.rglob("part-*")]
    assert files and all(name.endswith((".txt.gz", ".zstd.parquet")) for name in files)


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        class conf:
            @staticmethod
            def get(key, default=None):
                return {"spark.master": "yarn"}.get(key, default)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(Session, "x")
