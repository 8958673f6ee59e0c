import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, token string, id long, n int, component string"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds documents with extra columns whose names clash with internal ones."""
    def build(rows):
        return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t), "x", 7, 1, "y") for i, t, lang in rows], COLUMNS)
    return build


#: NULLs, empty and blank texts, a very long text, repeated rows and ids.
ODD = [(1, None, "en"), (2, "", "en"), (3, "  \n\t ", None), (None, "no id here at all", "en"), (4, "ab " * 60_000, "en"),
       (5, "same text twice over", "en"), (5, "same text twice over", "en"), (6, "x", None), (6, "a different text of one id", "de"), (-8, "ünï cödé 日本語 🙂", "de")]
