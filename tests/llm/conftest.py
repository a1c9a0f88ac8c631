import pytest

ODD_DOCS = [
    (3, "b c a"),
    (1, None),
    (2, ""),
    (7, "the same text " * 30),
    (5, "the same text " * 30),
    (5, "the same text " * 30),
    (None, "no id here"),
    (None, None),
    (8, " \t\n double  spaces  and wide\x1cones \x85 \n\n end "),
    (9, "x" * 70000),
    (10, "word " * 20000 + "\U0001f600 İKſ"),
    (11, "\n\n\n"),
]


@pytest.fixture
def odd_docs(spark):
    """Null, empty, very long, repeated rows, and columns with names that operators use themselves."""
    rows = [(i, t, 1, "z", 2.0) for i, t in ODD_DOCS]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, start string, fail_bits double")


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string")


@pytest.fixture
def docs(spark):
    def make(texts):
        rows = list(texts.items()) if isinstance(texts, dict) else list(enumerate(texts))
        return spark.createDataFrame(rows, "doc_id long, text string")

    return make
