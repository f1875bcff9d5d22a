"""Small documents tables for the tests of lamina.llm."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, pairs):
    """A documents table from (doc_id, text) pairs, with extra columns whose names clash."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in pairs]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "1 AS n_words", "'x' AS component_id", "7 AS h1").repartition(3)


def rows_of(df) -> list[dict]:
    return [row.asDict(recursive=True) for row in df.collect()]
