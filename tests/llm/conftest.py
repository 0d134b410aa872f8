import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with everything that may go wrong in a row, and columns named like inner ones."""
    long = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))
    rows = [
        (1, None, "en", "a", 0), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 3),
        (4, "same text here, again and again", "en", "a", 1), (5, "same text here, again and again", "en", "a", 1),
        (5, "same text here, again and again", "en", "a", 1), (None, "without an id at all", "en", "a", 1),
        (None, "without an id at all", "en", "a", 1), (None, None, None, None, None),
        (6, long, "en", "b", len(long)), (7, long + " end", "en", "b", len(long) + 4),
        (8, "Ünïcödé Straße naïve \U0001f600 " * 30, "de", "a", 5), (9, "x", "de", "b", 1), (10, "12345 !!!", "de", "b", 9),
    ]
    rows = [(*r, "clash", 1, 2.0, "q", 7) for r in rows]
    return spark.createDataFrame(
        rows,
        "doc_id long, text string, lang string, source string, n_chars long, "
        "row string, number long, mean double, id string, n_words long",
    )


@pytest.fixture(scope="session")
def empty(documents):
    return documents.limit(0)
