import pytest


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties, and further columns with clashing names."""
    words = [f"w{i}" for i in range(400)]
    long = " ".join(words * 60)
    rows = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (4, "one line of text here\nanother line of text\nONE LINE of text here "), (5, "Another line of text\nsolo"), (6, long), (7, " ".join(words)), (None, "a null id has this text"), (None, None), (8, "\n\n"), (9, "tab\tand nbsp ünï 𝔘  x")]
    return spark.createDataFrame([(a, b, "x", a, b) for a, b in rows], "doc_id long, text string, kept string, n_words long, __text string")
