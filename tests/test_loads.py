"""Loads on top of each other: key index, compaction, loads at once, tables of earlier versions."""

import json
import threading
import time

from pyspark.sql import functions as F

from orderflow.plans import catalog
from orderflow.sinks import keyindex, tables
from orderflow.sinks.claims import create_new


def test_only_one_writer_creates_a_file(spark, tmp_path):
    path, won = str(tmp_path / "log" / "v1.json"), []
    writers = [
        threading.Thread(target=lambda n=n: won.append((create_new(spark, path, f"{n}"), n))) for n in range(8)
    ]
    for writer in writers:
        writer.start()
    for writer in writers:
        writer.join()
    (winner,) = [n for created, n in won if created]
    assert (tmp_path / "log" / "v1.json").read_text() == f"{winner}"
    assert [p.name for p in (tmp_path / "log").iterdir()] == ["v1.json"]


def test_two_loads_at_once_publish_each_row_once(spark, listing, tmp_path, monkeypatch):
    root, written = str(tmp_path), threading.Barrier(2)
    write_new, first_tries = tables._write_new, []

    def both_have_written(*args):
        counts = write_new(*args)
        if len(first_tries) < 2:
            first_tries.append(args)
            written.wait(timeout=120)
        return counts

    monkeypatch.setattr(tables, "_write_new", both_have_written)
    stagings = {"a": listing({}, {}, {"name": "A"}), "b": listing({}, {"name": "B"}, {"name": "B"})}
    found = {}
    loads = [
        threading.Thread(target=lambda r=r, s=s: found.update({r: tables.load_listing(s, root, r)}))
        for r, s in stagings.items()
    ]
    for load in loads:
        load.start()
    for load in loads:
        load.join()
    assert tables.published_runs(spark, root) == ["a", "b"]
    for table, expected in {"locations": 1, "restaurants": 3, "metrics": 5}.items():
        rows = tables.read_table(spark, root, table)
        assert rows.count() == rows.select(tables.TABLES[table][0]).distinct().count() == expected
        assert sum(result.rows[table] for result in found.values()) == expected


def test_a_load_compares_keys_bucket_by_bucket(spark, listing, tmp_path):
    root = str(tmp_path)
    tables.load_listing(listing({}, {"name": "A"}), root, "a", buckets=8)
    (row,) = tables.published_log(spark, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with keyindex.Index(spark) as index:
            known = index.read(f"{root}/{row.folder}/keys/metrics", row.buckets)
            rows = spark.range(100).select(F.col("id").cast("string").alias("key")).repartition(8, "key")
            plan = rows.join(known, "key", "left_anti")._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 8 out of 8" in plan, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("load_keys_")]


def test_a_load_reads_few_indexes(spark, listing, tmp_path):
    root, names = str(tmp_path), "abcdef"
    for n, name in enumerate(names):
        staging = listing(*[{"name": x} for x in names[: n + 1]])
        assert tables.load_listing(staging, root, name, buckets=4, compact_after=2).rows["metrics"] == 1
    log = tables.published_log(spark, root)
    assert [row.compacted for row in log] == [False, False, True, False, True, False]
    assert [row.run_id for row in keyindex.chain(log)] == ["e", "f"]
    assert {row.buckets for row in log} == {4}
    assert tables.read_table(spark, root, "metrics").count() == len(names)


def test_tables_of_earlier_versions_are_added_to(spark, listing, tmp_path):
    source, root = str(tmp_path / "new"), tmp_path / "old"
    staging = listing({}, {}, {"name": "A"})
    tables.load_listing(staging, source, "a")
    (row,) = tables.published_log(spark, source)
    for table, (_, schema) in tables.TABLES.items():
        spark.read.schema(schema).parquet(f"{source}/{row.folder}/{table}").write.parquet(f"{root}/run=a/{table}")
    (root / "published").mkdir()
    (root / "published" / "part-0.json").write_text(json.dumps({"run_id": "a"}) + "\n")
    assert tables.read_table(spark, str(root), "metrics").count() == 3
    for run, names in {"b": "A", "c": "AB", "d": "ABC"}.items():
        more = staging.unionByName(listing(*[{"name": x} for x in names if x != "A"])) if names != "A" else staging
        added = tables.load_listing(more, str(root), run, compact_after=1).rows["metrics"]
        assert added == (0 if names == "A" else 1)
    log = tables.published_log(spark, str(root))
    assert [row.compacted for row in log] == [None, False, True, True]
    assert tables.load_listing(staging, str(root), "e").rows["metrics"] == 0


def test_a_load_in_slices_adds_the_same(spark, listing, tmp_path):
    first = [{}, {}, {"phone": "2"}, {"rate": "NEW"}, {"city": "South"}, {"name": None}, {"menu_item": None}]
    first.append({"votes": "1 20"})
    second = [*first, *first, {"name": "B"}, {"cuisines": None}, {"cuisines": None}]
    found = []
    for rows in (1000, 3):
        root = str(tmp_path / f"{rows}")
        for run, staging in {"a": listing(*first), "b": listing(*second), "c": listing(*second)}.items():
            found.append(tables.load_listing(staging, root, run, slice_rows=rows).rows)
        for table, (key, _) in tables.TABLES.items():
            stored = tables.read_table(spark, root, table)
            assert stored.columns == tables.TABLES[table][1].fieldNames()
            found.append(sorted(map(str, stored.collect())))
            assert stored.select(key).distinct().count() == len(found[-1])
    assert found[:6] == found[6:]
    assert [r["metrics"] for r in found[:3]] == [13, 18, 0]


def test_many_copies_are_known_by_number(spark, listing, tmp_path):
    """A hot row: one key in the index for all its copies, laid out by many tasks."""
    copies = spark.range(10_000).crossJoin(listing({})).drop("id")
    hot = copies.unionByName(listing({"phone": "2"}))
    root, some = str(tmp_path), listing({}, {"name": "B"}, {"name": "B"})
    for match in ("venue", "exact"):
        at = f"{root}/{match}"
        assert tables.load_listing(some, at, "a", match).rows["metrics"] == 3
        added = tables.load_listing(hot, at, "b", match).rows["metrics"]
        assert added == (20_001 if match == "venue" else 10_000)
        more = tables.load_listing(hot.unionByName(some), at, "c", match, compact_after=2).rows["metrics"]
        assert more == (2 if match == "venue" else 1)
        assert tables.load_listing(hot.unionByName(some), at, "d", match).rows["metrics"] == 0
        stored = tables.read_table(spark, at, "metrics")
        assert stored.select("metric_id").distinct().count() == stored.count()
        log = tables.published_log(spark, at)
        assert [row.compacted for row in log] == [False, False, True, False]
        with keyindex.Index(spark) as index:
            known = index.read(f"{at}/{log[2].folder}/keys/metrics", log[2].buckets)
            # The hot row, that of B, and that of the other phone.
            assert known.count() == 3
            assert known.agg(F.sum("copies")).first()[0] == stored.count()
        written = spark.read.parquet(f"{at}/{log[1].folder}/metrics")
        sizes = written.groupBy(F.input_file_name()).count().collect()
        assert len(sizes) > 1 and max(r["count"] for r in sizes) < written.count()


def test_indexes_of_keys_alone_are_added_to(spark, listing, tmp_path):
    """Loads of the version before: an index of every copy's own key, no numbers."""
    root, staging = str(tmp_path), listing({}, {}, {}, {"name": "A"})
    tables.load_listing(staging, root, "a", buckets=4)
    (row,) = tables.published_log(spark, root)
    for table, (key, schema) in tables.TABLES.items():
        keys = spark.read.schema(schema).parquet(f"{root}/{row.folder}/{table}").select(F.col(key).alias("key"))
        keys.write.mode("overwrite").parquet(f"{root}/{row.folder}/keys/{table}")
    (file,) = (tmp_path / "published").iterdir()
    record = json.loads(file.read_text())
    del record["counted"]
    file.write_text(json.dumps(record) + "\n")
    (tmp_path / "published" / f".{file.name}.crc").unlink(missing_ok=True)
    assert tables.load_listing(staging, root, "b").rows == {"locations": 0, "restaurants": 0, "metrics": 0}
    more = staging.unionByName(listing({}, {}, {"name": "B"}))
    assert tables.load_listing(more, root, "c", compact_after=1).rows["metrics"] == 3
    assert tables.load_listing(more, root, "d").rows["metrics"] == 0
    assert {row.buckets for row in tables.published_log(spark, root)} == {4}


def test_keys_moved_as_bytes_meet_the_index_without_another_shuffle(spark, listing, tmp_path):
    root = str(tmp_path)
    tables.load_listing(listing({}, {"name": "A"}), root, "a", buckets=8)
    (row,) = tables.published_log(spark, root)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with keyindex.Index(spark) as index:
            known = index.read(f"{root}/{row.folder}/keys/metrics", row.buckets)
            rows = tables.read_table(spark, root, "metrics").select(F.col("metric_id").alias("key"), "menu_item")
            joined = keyindex.dealt_by_key(rows, row.buckets).join(known, "key")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 8 out of 8" in plan, plan
            assert joined.count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_shuffle_files_go_with_the_step(spark, listing, tmp_path):
    """They do not wait until the driver collects garbage, and the setting is put back."""

    def files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = manager.getAllFiles().mkString("\n").split("\n")
        return {name for name in names if "/shuffle_" in name}

    before, setting = files(), spark.conf.get(tables._CLEANUP)
    for run in "ab":
        tables.load_listing(listing({}, {"phone": "2"}, {"name": "A"}), str(tmp_path), run)
    until = time.monotonic() + 20
    while files() - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(tables._CLEANUP) == setting
    with tables.shuffles_released(spark):
        with tables.shuffles_released(spark):
            assert spark.conf.get(tables._CLEANUP) == "true"
        assert spark.conf.get(tables._CLEANUP) == "true"
    assert spark.conf.get(tables._CLEANUP) == setting


def test_load_twice_reads_the_stored_listing(spark, sf_dir, monkeypatch):
    read, load = [], catalog.load_listing

    def noted(rows, *args):
        read.append(rows.inputFiles())
        return load(rows, *args)

    monkeypatch.setattr(catalog, "load_listing", noted)
    catalog.load_twice(spark, sf_dir)
    shared = spark.conf.get("spark.checkpoint.dir")
    assert len(read) == 2 and all(files and all(f"{shared}/staging-" in f for f in files) for files in read)
