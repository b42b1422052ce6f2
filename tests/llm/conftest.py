"""Small tables with every awkward row an operator must take."""

import pytest

DOCS = (
    "doc_id long, text string, lang string, source string, n_chars long, size string, key string,"
    " node string, bucket string, row string, label string, src string, text_key string, at string"
)


def doc(doc_id, text, lang="en", source="a"):
    chars = None if text is None else len(text)
    return (doc_id, text, lang, source, chars, "s", "k", "n", "b", "r", "l", "c", "t", "x")


LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))

ROWS = [
    doc(1, "the cat sat on the mat and looked at the moon"),
    doc(2, "The  CAT sat\non the mat and looked at the moon"),
    doc(3, None),
    doc(4, ""),
    doc(5, " \t\r\n\x0b\x0c "),
    doc(6, "one two"),
    doc(7, "one two"),
    doc(7, "one two"),
    doc(8, "ONE two three"),
    doc(None, "a text without an id"),
    doc(None, "a text without an id"),
    doc(9, LONG, source="b"),
    doc(10, LONG + " end", source=None),
    doc(11, "ÄÖ   nbsp   wide \x1c sep", lang=None, source=None),
    doc(12, "tie one two three four five", lang="de", source="b"),
    doc(12, "other text under one id", lang="de", source="b"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame(ROWS, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
