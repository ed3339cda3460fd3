import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A ``documents`` table from texts, or from ``(doc_id, text)`` pairs, with more columns of clashing names."""
    def make(rows, extra=""):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        df = spark.createDataFrame([(i, t, "en", "s0", 0) for i, t in pairs], DOC_SCHEMA)
        for name in extra.split():
            df = df.selectExpr("*", f"'clash' AS {name}")
        return df

    return make
