import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, DOC_note string"


@pytest.fixture
def docs(spark):
    """documents-shaped frames with one extra column, from (id, text) or (id, text, source)."""
    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x") for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make
