import pytest


def docs_of(spark, texts, more=None):
    """documents of texts (null allowed), with clashing extra columns."""
    rows = [(k, t, "en", "s", 0, "x", "y", 1) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows + (more or []), "doc_id long, text string, lang string, source string, n_chars long, rest string, block string, kind int")


@pytest.fixture(scope="session")
def make(spark):
    return lambda texts, more=None: docs_of(spark, texts, more)
