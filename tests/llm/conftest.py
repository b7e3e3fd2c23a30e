import pytest

from fleetlake.llm.tables import ship


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with a column whose name clashes with inner ones."""
    ship(spark)

    def make(rows):
        full = [(i, t, f"key{n}", n) for n, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, text string, key string, n long")

    return make


AWKWARD = [
    (1, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (2, "one two three four five six seven"),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (None, "a text without a name"),
    (None, None),
    (6, "naïve Übermaß Σίσυφος 中文 😀 İ½²"),
    (7, "word " * 4000 + "x" * 3000),
]


@pytest.fixture
def awkward():
    return list(AWKWARD)
