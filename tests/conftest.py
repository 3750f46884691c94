import sys
import tempfile
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def day(text):
    return date.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples of the named columns (all by default)."""
    names = list(columns) or df.columns
    found = [tuple(r[c] for c in names) for r in df.select(*names).collect()]
    return in_order(found)


def in_order(tuples):
    return sorted(tuples, key=lambda r: tuple((v is None, str(v)) for v in r))
