import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents frame from (doc_id, text) or (doc_id, text, lang, source) rows, with a clashing extra column."""

    def build(rows, extra=False):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        if extra:
            names = ["size", "target", "id", "h1", "page", "key", "bucket", "label", "rank", "score", "piece", "row", "own"]
            df = df.selectExpr("*", *[f"'x' as {n}" for n in names])
        return df

    return build
