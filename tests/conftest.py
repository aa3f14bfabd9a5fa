from __future__ import annotations

import pathlib
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("orderflow-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def listing(spark):
    """Builds listing rows from keyword arguments; everything else is a default."""
    from orderflow.constants import CITY_COLUMN, COST_COLUMN, TYPE_COLUMN
    from orderflow.schemas import LISTING

    names = {"cost": COST_COLUMN, "type": TYPE_COLUMN, "city": CITY_COLUMN}
    default = {
        "address": "1 Main Road",
        "name": "Spice Room",
        "online_order": "Yes",
        "book_table": "No",
        "rate": "4.1/5",
        "votes": "120",
        "phone": "080 1111",
        "location": "Hill Side",
        "rest_type": "Cafe",
        "cuisines": "Thai, Italian",
        COST_COLUMN: "800",
        "menu_item": "[]",
        TYPE_COLUMN: "Delivery",
        CITY_COLUMN: "North",
    }

    def build(*rows: dict):
        filled = [default | {names.get(k, k): v for k, v in row.items()} for row in rows]
        return spark.createDataFrame([tuple(r[f.name] for f in LISTING) for r in filled], LISTING)

    return build
