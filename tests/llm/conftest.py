import pytest

from dwellmart.llm.shipping import ship

# Nulls, empty and long texts, repeated rows and ids, ties, and a column that clashes with results.
PROSE = " ".join(f"word{i % 37} thing{i % 11} of the {i}" for i in range(60)) + "."
ROWS = [
    (1, PROSE, "a", "x"), (1, PROSE, "a", "x"), (2, PROSE, "b", "x"), (3, PROSE + " tail", "b", None),
    (4, None, "a", "x"), (5, "", "a", "x"), (6, "one two", None, "x"), (None, "lost words here", "a", "x"),
    (7, "Été " * 3 + PROSE, "a", "x"), (8, "a@b.example.com 10.0.0.1 is 4111 1111 1111 1111 or +1 (017) 555-7713", "a", "x"),
    (9, "Released under the MIT License.\nlong " + "x" * 50_000 + " " + "many words " * 4_000, "a", "x"),
    (10, " \n\t ", "a", "x"),
]
COLUMNS = "doc_id LONG, text STRING, source STRING, score STRING"


@pytest.fixture(scope="session")
def docs(spark):
    return ship(spark).createDataFrame(ROWS, COLUMNS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return ship(spark).createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 11)] + [(3, None, None), (None, 1, 1), (3, 1, 0)]
    return spark.createDataFrame(rows, "doc_id LONG, quality INT, toxic INT")
