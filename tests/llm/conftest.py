import pytest

from tallyspark.llm.registry import find_package


@pytest.fixture(scope="session", autouse=True)
def _package_on_workers(spark):
    find_package(spark)


LONG = "word " * 30_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns with inconvenient names."""
    rows = [
        (1, "Same TEXT here.", "en", "x", 1), (2, "same text HERE.", "en", "y", 2), (2, "same text HERE.", "en", "y", 2),
        (3, None, None, None, None), (4, "", "en", None, 5), (None, "same text here.", None, "z", 6),
        (None, None, None, None, None), (7, LONG, "de", "w", 8), (8, "ÀÉ àé ÀÉ", "fr", "v", 9), (9, " \n\t ", "en", "u", 1),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, row string, part long")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, row string, part long")
