import pytest

DOCS = "doc_id long, text string, shard string, score string, spans int, ids int, node int, n_words string"


@pytest.fixture
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows."""
    base = " ".join(f"word{i % 97} other{i % 31}" for i in range(400))
    return [
        (1, "The quick brown fox jumps over the lazy dog.\nAgain and again the same line of words stands here."),
        (2, ""),
        (3, None),
        (4, base),
        (5, base),
        (5, base),
        (6, base.replace("word5 ", "changed ") + "\nthe end"),
        (7, "short"),
        (8, "\n\n   \n"),
        (9, "Again and again the same line of words stands here.\nÀ la carte, 日本語 und Öl 😀"),
        (10, "x" * 5000),
        (11, "x" * 5000 + "y"),
        (12, "The quick brown fox jumps over the lazy dog.\nAgain and again the same line of words stands there now."),
    ]


@pytest.fixture
def odd_docs(spark, odd_rows):
    """The rows with further columns whose names clash with results."""
    rows = [(i, t, "a", "b", 1, 2, 3, None) for i, t in odd_rows]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
