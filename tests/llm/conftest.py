import pytest

#: Rows with nulls in any column, empty and long texts, ties, repeated rows, and columns whose names clash with our own.
LONG = "Long words go on and on. " * 4000
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog again", "en", "s", 3, "k"),
    (1, "the quick brown fox jumps over the lazy dog again", "en", "s", 3, "k"),
    (2, None, None, None, None, None),
    (None, "a text without an id that still counts as one", "en", None, 1, "k"),
    (3, "", "en", "s", 0, ""),
    (4, "", "en", "s", 0, ""),
    (5, LONG, "en", "s", 9, "k"),
    (6, "Ünïcode 漢字 😀 text", "de", "t", 5, "k"),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, node string"


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
