import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("parley-tests")
               .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_blocks(monkeypatch):
    """Blocks so small that every carry crosses many of them."""
    from parley.operators import ordered, speech

    monkeypatch.setattr(ordered, "BLOCK_ROWS", 3)
    monkeypatch.setattr(speech, "BLOCK_SECONDS", 0.5)


def rows(df, *order):
    """Rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.select(*(order or df.columns)).collect()), key=repr)
