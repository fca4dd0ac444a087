import pytest
from llm_samples import FOLDER, LONG, make_docs, prose


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls in every column, empty, blank and long texts, ties and repeated rows."""
    a, b = prose(1, 120), prose(2, 90)
    return [
        (1, a, "en", "s1"), (2, a, "en", "s1"), (2, a, "en", "s1"), (3, b, "de", "s2"), (4, None, None, None), (5, "", "fr", "s2"),
        (6, " \t\n ", "fr", None), (None, b + " tail", "de", "s1"), (None, None, None, None), (7, LONG, "en", "s3"), (8, "word", "en", "s3"),
        (9, "!!! ??? 123", None, "s2"), (10, prose(3, 60) + " é中文 \U0001f600", "es", "sé"),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return make_docs(spark, odd_rows).repartition(3).persist()


@pytest.fixture(scope="session")
def none(spark):
    return make_docs(spark, [])


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{FOLDER}/labels.parquet")
