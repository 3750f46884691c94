import glob
import os
import tempfile

import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark):
    """Tests name the shared folder themselves, as a cluster would."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="llm-tests-"))


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


#: Null and repeated ids, null, empty, blank and long texts, repeated rows, clashing columns.
AWKWARD = [
    (1, "alpha beta gamma. " * 40, "a"),
    (2, "alpha beta gamma. " * 40, "a"),
    (2, "alpha beta gamma. " * 40, "a"),
    (None, "other words are here, and more of them follow.\n" * 3, None),
    (None, None, None),
    (5, "", "b"),
    (6, None, "b"),
    (7, " \t\n ", "b"),
    (8, "é" * 700 + " 𝒳" * 300, "c"),
    (9, "a" * 5000, "c"),
    (2**62 + 1, "Unique words of a text with a large id, spoken once. Then again others, many more of them here.", "c"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows, with columns named like results and helpers."""
    rows = [(i, t, s, 1.5, "x", 7, "y") for i, t, s in AWKWARD]
    schema = "doc_id long, text string, source string, score double, fp string, size int, taken string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)
