import pytest

EXTRA = "row_ string, words int, `kept` boolean, `a.b` string, fp long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


@pytest.fixture(scope="session")
def edge_rows():
    long = " ".join(f"word{k % 97} the of" for k in range(20_000))
    same = "The same text stands here twice and again, with enough words to be more than fifty bytes long."
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "a text without an id, of the same words as the next"), (4, same), (4, same),
        (5, same), (6, long), (7, "word"), (8, "two words"), (9, "ünï çødé 日本語 😀 <|endoftext|> \x00 x"), (-3, same + " and more"),
        (10, "MIT License. Apache  License, General\nPublic License"), (11, "### $$$ %%% 123"), (12, "a" * 5000), (None, None),
    ]


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """Nulls, empty and long texts, repeated rows, and other columns with names the operators use themselves."""
    rows = [(d, t, "en", "r", 1, None, "x", 5) for d, t in edge_rows]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, {EXTRA}")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
