import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use themselves."""

    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, "en", "src1", len(t or "")) for i, t in rows], DOCS)
        return df.selectExpr("*", "'x' as kept", "1 as band", "2 as node", "'k' as key", "3 as component", "'t' as tokens", "0 as n", "1 as __th", "2 as __own", "3 as __row", "4 as __kept", "'l' as __lang_pred", "'s' as __lang_score", "5 as size", "6 as facts") if extra else df

    return make
