import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents frame; an extra column clashes with names that operators use."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, lang, src, None if t is None else len(t), "x") for i, t, lang, src in rows],
            "doc_id long, text string, lang string, source string, n_chars long, id string",
        )

    return make
