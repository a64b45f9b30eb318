import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source, lang) rows."""

    def make(rows, extra=()):
        full = []
        for row in rows:
            doc_id, text, source, lang = (*row, "s", "en")[:4] if len(row) < 4 else row
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCUMENTS)
        for name, value in extra:
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit(value))
        return df

    return make


@pytest.fixture
def clashing():
    """Extra columns whose names the operators use themselves."""
    return (
        ("size", 1), ("row", 2), ("start", 3), ("fp", 4), ("digest", "x"), ("label", "y"), ("finish", 1.5),
        ("words", "z"), ("bin", 7), ("score", 0.1), ("flow", "q"), ("_row", 5), ("_id", 6), ("number", 8),
    )
