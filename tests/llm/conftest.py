import pytest


@pytest.fixture()
def documents(spark):
    """A maker of small documents tables: rows of (doc_id, text, source)."""

    def make(rows, extra=True):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        df = spark.createDataFrame(full, schema)
        if extra:  # names that the operators use inside
            for c in ("doc", "th", "fp", "size", "component", "pos", "a", "b", "rank", "curve", "key"):
                df = df.selectExpr("*", f"'x' AS {c}")
        return df

    return make
