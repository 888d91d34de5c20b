import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A small documents table from (doc_id, text) pairs, or (doc_id, text, lang, source)."""

    def make(rows, parts=3):
        rows = [(*r, None, None, None)[:5] if len(r) < 5 else r for r in rows]
        return spark.createDataFrame(rows, SCHEMA).repartition(parts) if rows else spark.createDataFrame([], SCHEMA)

    return make
