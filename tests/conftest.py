import os
import sys
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


START = datetime(2024, 1, 1, 9, 15)


def minute_rows(symbol, closes, volumes=None, step=5, start=START):
    """Bars whose open, high and low equal the close."""
    volumes = volumes or [100] * len(closes)
    return [
        (symbol, start + timedelta(minutes=step * i), float(c), float(c), float(c), float(c), int(v))
        for i, (c, v) in enumerate(zip(closes, volumes))
    ]


BAR_SCHEMA = (
    "symbol string, event_time timestamp_ntz, open_price double, high_price double, low_price double, "
    "close_price double, volume long"
)
DAY_SCHEMA = BAR_SCHEMA.replace("event_time timestamp_ntz", "event_date date")


def day_rows(symbol, closes, volumes=None):
    return [
        (r[0], date(2020, 1, 1) + timedelta(days=i), *r[2:])
        for i, r in enumerate(minute_rows(symbol, closes, volumes))
    ]


@pytest.fixture
def bars(spark):
    return lambda *groups: spark.createDataFrame([r for g in groups for r in g], BAR_SCHEMA)


@pytest.fixture
def days(spark):
    return lambda *groups: spark.createDataFrame([r for g in groups for r in g], DAY_SCHEMA)
