import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents frame from texts or (doc_id, text) pairs, with extra columns whose names clash with helpers'."""

    def make(items, extra=False):
        pairs = [x if isinstance(x, tuple) else (i, x) for i, x in enumerate(items)]
        df = spark.createDataFrame([(i, t, "en", None, None) for i, t in pairs], DOCS).repartition(3)
        if extra:
            for name in ("key", "rep", "n", "start", "ids", "tie", "recipe", "seed", "kept", "count"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make
