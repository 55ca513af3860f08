import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    """Rows (doc_id, text[, source]) as a documents table."""

    def make(rows, extra: bool = False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:  # further columns, with names that operators use themselves
            for name in ("size", "words", "n", "hash", "range", "label", "kept", "score", "doc", "block"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture
def rows():
    """Collected rows as plain dictionaries, ordered by doc_id."""

    def get(df, key: str = "doc_id"):
        got: list[Row] = df.collect()
        return sorted((r.asDict(True) for r in got), key=lambda r: (r[key] is not None, r[key]))

    return get
