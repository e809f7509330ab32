from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

COLUMNS = "title string, ka string, en string, domain string, id string"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def parallel(spark):
    """Rows as (en, ka) or (title, ka, en, domain, id)."""

    def make(rows):
        full = [r if len(r) == 5 else (None, r[1], r[0], "d", f"set_{i}") for i, r in enumerate(rows)]
        return spark.createDataFrame(full, COLUMNS)

    return make


@pytest.fixture(scope="session")
def sample(parallel):
    """Six pairs of five collections; the second one has no title and no Georgian text."""
    return parallel(
        [
            ("Forecast", "ხვალ მთაში ძლიერი წვიმა იქნება", "Heavy rain is expected in the hills tomorrow", "weather", "met_daily_07"),
            (None, "", "The old bridge stays closed until spring", "traffic", "road_notes_b"),
            ("Recipe", "დაამატეთ ორი კვერცხი და აურიეთ", "Add two eggs and stir the mixture well", "cooking", "kitchen_cards_3"),
            ("Sea", "ზღვა დღეს სრულიად მშვიდია", "The sea is completely calm today", "weather", "met_daily_08"),
            ("Setup", "Python და Java", "Python and Java", "software", "manual_setup"),
            ("Delay", "მატარებელი ორი საათით დაიგვიანა", "The train arrived two hours late", "traffic", "rail_log_1"),
        ]
    )
