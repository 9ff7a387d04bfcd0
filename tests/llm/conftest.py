import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def messy(spark):
    """Null ids and texts, repeated rows and ids, empty and very long texts, columns whose names clash."""
    long = " ".join(f"w{i % 997}x{i % 13}" for i in range(40_000))
    texts = [None, "", "   \n\n", "one", "one two", "one two three four five six", "one two three four five six", long, long + " tail", "Zeile äöü   ẞ\n" * 30]
    rows = [(i if i != 3 else None, t, "en", None if i % 4 == 0 else f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], (5, "another text under the same id as before", "en", "s1", 40), (None, None, None, None, None)]
    schema = DOC + ", row string, score double, copy int, id string, doc string, `a.b` int"
    return spark.createDataFrame([(*r, "r", 0.5, 7, "x", "y", 1) for r in rows], schema)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
