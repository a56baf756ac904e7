import pytest

from tidemark.llm.shipping import ship

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, position long, shard string, score string"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows, equal texts, clashing names."""
    ship(spark)
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (3, base + " seventeen", "en", "b"),
        (4, None, "en", "a"),
        (5, "", "en", None),
        (6, "  \n\t ", None, "b"),
        (7, "12 34 !!", "en", "b"),
        (8, "Kurzer Satz mit ß und ü.", "de", "c"),
        (8, "Kurzer Satz mit ß und ü.", "de", "c"),
        (None, base, "en", "a"),
        (None, None, None, None),
        (9, "palabra " * 40_000, "es", "c"),
        (10, "x" * 100_000, None, "c"),
        (11, "ONE two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen", "en", "d"),
    ]
    full = [(i, t, la, s, None if t is None else len(t), 0, "x", "y") for i, t, la, s in rows]
    return spark.createDataFrame(full, SCHEMA)
