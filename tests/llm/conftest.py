import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, `row` int, `group` string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text, source), with null, empty and repeated ones left to the test, and clashing names."""

    def made(*rows):
        return spark.createDataFrame([(i, t, "en", s, None, "x", 1, "g") for i, t, s in rows], DOC_SCHEMA)

    return made
