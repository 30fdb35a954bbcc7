import os
import sys

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, REPO)
os.environ["PYTHONPATH"] = REPO + os.pathsep + os.environ.get("PYTHONPATH", "")  # for the workers

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i * 7 % 4001}" for i in range(30_000))
SAID = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
# id, text, source: nulls, empty and long texts, ties, repeated rows
ODD = [
    (1, "", "a"), (2, None, "a"), (3, " \n\t ", None), (4, "alone", "a"), (5, "three short words", "b"),
    (6, SAID, "b"), (7, SAID, "b"), (7, SAID, "b"), (8, "before " + SAID + "\nafter it", None), (9, LONG, "c"),
    (10, "start " + LONG, "c"), (None, "no id here", "c"), (11, "naïve ▁ déjà vu 日本 🙂  two  spaces ", "b"),
    (12, "Menu\nfirst page of d", "d"), (13, "Menu\nsecond page of d", "d"), (14, "Menu\nthird page of d\n\nend", "d"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with awkward rows, and further columns whose names the operators use themselves."""
    rows = [(i, t, "en", s, len(t or ""), "x", 1, 2.0) for i, t, s in ODD]
    return spark.createDataFrame(rows, DOCS + ", row string, size int, key double").repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")
