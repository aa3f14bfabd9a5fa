"""CSV by byte ranges against the whole-file reader."""

import random
from collections import Counter

import pytest

from orderflow.schemas import LISTING
from orderflow.sources import csv_ranges, files

HEADER = ",".join(f.name for f in LISTING)


def field(draw):
    kind = draw.randrange(8)
    if kind == 0:
        return ""
    if kind == 1:
        return '""'
    if kind == 2:
        return '"' + draw.choice(["a,b", 'say ""hi""', "line\nbreak", '""', "\n\n", 'x""\n""y', "ü\n,é"]) + '"'
    if kind == 3:
        return '"' + "long text\n" * draw.randrange(1, 60) + '"'
    return draw.choice(["plain", " spaced ", "4.1/5", "1 200", "ü漢", "'x'"])


def text(seed, rows=120, end="\n"):
    draw = random.Random(seed)
    lines = [HEADER]
    for _ in range(rows):
        width = draw.choice([14, 14, 14, 14, 3, 17])
        lines.append(",".join(field(draw) for _ in range(width)))
    lines.insert(5, "")
    return end.join(lines) + draw.choice(["", end])


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("broadcast", [200_000, 0])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_ranges_equal_the_whole_file(spark, tmp_path, small_ranges, monkeypatch, end, broadcast):
    monkeypatch.setattr(csv_ranges, "BROADCAST_RANGES", broadcast)
    for seed in range(3):
        (tmp_path / f"{seed}.csv").write_bytes(text(seed, end=end).encode())
    (tmp_path / "bare.csv").write_text(HEADER)
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "blank.csv").write_bytes(f"{end}{end}{HEADER}{end}{end}first{end}".encode())
    path = str(tmp_path)
    assert csv_ranges.range_parities(csv_ranges._lines(spark, path)).count() > 10
    want, found = files.read_listing(spark, path), files.read_listing_ranges(spark, path)
    assert found.schema == want.schema
    assert rows(found) == rows(want)
    assert sum(rows(found).values()) == 361


def test_records_that_pass_whole_ranges(spark, tmp_path, small_ranges):
    long = '"' + 'line ""q""\n' * 900 + '"'
    lines = [HEADER, f"a,{long},c", "d,e", f"{long},f", f"g,{long}", "h"]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    found = files.read_listing_ranges(spark, str(tmp_path))
    assert rows(found) == rows(files.read_listing(spark, str(tmp_path)))
    assert found.count() == 5


@pytest.mark.parametrize("odd", ['a,b"c,d', 'x,"open', '"a"b,c', 'a,"b" ,c'])
def test_quotes_within_fields_leave_a_file_to_the_whole_file_reader(spark, tmp_path, small_ranges, odd):
    (tmp_path / "odd.csv").write_text("\n".join([HEADER, "first,1", odd, "last,2", "end,3"]))
    (tmp_path / "sound.csv").write_text(text(9))
    path = str(tmp_path)
    assert rows(files.read_listing_ranges(spark, path)) == rows(files.read_listing(spark, path))


def test_one_file_is_read_by_many_tasks(spark, tmp_path, small_ranges):
    (tmp_path / "one.csv").write_text(text(4, rows=400))
    assert csv_ranges._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    assert files.read_listing(spark, str(tmp_path)).rdd.getNumPartitions() == 1


def test_the_file_is_read_twice_by_tasks_of_many_ranges(spark, tmp_path, small_ranges, monkeypatch):
    monkeypatch.setattr(csv_ranges, "RANGES_PER_TASK", 16)
    (tmp_path / "one.csv").write_text(text(4, rows=4000))
    ranges = csv_ranges._lines(spark, str(tmp_path)).rdd.getNumPartitions()
    found = csv_ranges.records(spark, str(tmp_path))
    assert ranges > 200
    assert str(tmp_path / "one.csv") not in "".join(found.inputFiles())
    stored = {file for file in found.inputFiles() if "/csv-records-" in file}
    assert 1 < len(stored) <= max(16, -(-ranges // 16))
    assert rows(files.read_listing_ranges(spark, str(tmp_path))) == rows(files.read_listing(spark, str(tmp_path)))


def test_files_with_different_headers(spark, tmp_path):
    names = [f.name for f in LISTING]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(f"a{i}" for i in range(14)))
    (tmp_path / "b.csv").write_text(",".join(names[::-1]) + "\r\n" + ",".join(f"b{i}" for i in range(14)[::-1]))
    (tmp_path / "c.csv").write_text("name,other,location\nc1,x,c7\n")
    found = files.read_listing_by_header(spark, str(tmp_path))
    assert found.columns == names
    got = {r["name"]: r for r in found.collect()}
    at = names.index("name")
    assert [*got[f"a{at}"]] == [f"a{i}" for i in range(14)]
    assert [*got[f"b{at}"]] == [f"b{i}" for i in range(14)]
    assert got["c1"]["location"] == "c7" and got["c1"]["address"] is None
