import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A table of documents from (doc_id, text) or longer rows."""

    def make(rows):
        full = [(r + (None, None, None))[:4] for r in rows]
        return spark.createDataFrame([(*r, len(r[1]) if r[1] is not None else None) for r in full], DOCS)

    return make


@pytest.fixture
def odd(documents):
    """NULLs everywhere, empty and blank texts, repeated rows, a long text without and one with many lines."""
    return documents(
        [
            (None, None), (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n ", None, "a"), (4, "one word", "en", "a"),
            (4, "one word", "en", "a"), (5, "x" * 50_000, "fr", "b"), (6, "\n".join(f"line {i} of many" for i in range(3000)), "en", "b"),
            (None, "a text without a number", None, None), (7, "é ü 日本 🙂", "de", "c"),
        ]
    )
