import pytest

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def middle():
    return MIDDLE


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and white texts, repeats, one long text, clashing column names."""
    rows = [(1, None, 1), (2, "", 1), (3, " \n\t ", 2), (4, "one two", 2), (5, "One\ttwo ", 3), (6, "a b c d e f", 3),
            (6, "a b c d e f", 4), (7, "wörd " * 30_000, 4), (None, "no id here at all today", 5), (9, "ÀÉ x y 'tis <|endoftext|> ǰ", 5)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids int").withColumnRenamed("ids", "payload")
