import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedlens.schema import BRONZE_SCHEMA, RAW_SCHEMA  # noqa: E402
from feedlens.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.driver.memory", "8g")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield prepare(session)
    session.stop()


def at(value: str) -> datetime:
    return datetime.fromisoformat(value)


def rows_of(spark, schema, rows):
    """Rows given as dicts with the columns that matter; the others are null."""
    data = [tuple(row.get(name) for name in schema.fieldNames()) for row in rows]
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def raw(spark):
    return lambda *rows: rows_of(spark, RAW_SCHEMA, rows)


@pytest.fixture(scope="session")
def feed(spark):
    def make(*rows):
        filled = [{"item_type": "post", "text": "words", "source": "file", "reactions": 0,
                   "comments": 0, "reposts": 0, **row} for row in rows]
        return rows_of(spark, BRONZE_SCHEMA, filled)
    return make


def table(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is None, str(v))
                                                                       for v in r])
