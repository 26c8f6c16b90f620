import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a documents table."""

    def make(rows, more=()):
        return spark.createDataFrame([(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows] + list(more), DOCS)

    return make


@pytest.fixture
def odd(documents):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = "word " * 30_000 + "end"
    return documents([(1, None), (2, ""), (3, "   "), (4, "One two three four five six"), (4, "One two three four five six"), (5, "one TWO three four five six"), (6, long), (7, long), (None, "lost and found"), (None, None), (8, "É ß あ 🙂 " * 5)], more=[(9, "a b c", None, None, None)])
