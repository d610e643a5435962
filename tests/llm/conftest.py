import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A table shaped like ``documents`` from (doc_id, text) pairs, with a column that clashes with the operators' own."""

    def make(pairs):
        rows = [(i, t, "en", "src0", len(t) if t is not None else None, "x") for i, t in pairs]
        schema = "doc_id long, text string, lang string, source string, n_chars long, fp string"
        return spark.createDataFrame(rows, schema)

    return make
