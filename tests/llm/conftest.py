"""Small tables that every operator must stand."""

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names of extra columns."""
    long_text = "A very long word" + "x" * 70_000 + " and " + "the end of it. " * 6_000
    rows = [
        (1, "Plain text of a few words, twice.", "en", "a.org", 0.5, "u", 1), (1, "Plain text of a few words, twice.", "en", "a.org", 0.5, "u", 1),
        (2, None, "en", "a.org", None, None, None), (None, "no id here\nno id here", None, None, 1.0, "v", 2),
        (3, "", "de", "b.org", 0.0, "", 0), (4, " \t\n ", "de", "b.org", 0.0, "", 0), (None, None, None, None, None, None, None),
        (5, long_text, "en", "c.org", 0.0, "w", 3), (6, "été — naïve   😀 ",
         "fr", "c.org", 0.0, "w", 3)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, score double, uid string, n bigint").selectExpr("*", "n AS row", "uid AS key", "lang AS host")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
