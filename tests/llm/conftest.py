import pytest

from goldrec.llm.common import prepare, table

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ["row", "doc", "size", "digest", "start", "bucket", "slot", "arc", "rank", "key", "word", "label", "h", "c", "n", "pass", "kept",
            "ids", "decoded", "token", "component", "node", "score", "law", "copies", "perplexity", "model_lang", "cost", "words", "nth"]
LONG = "word " * 9_000 + "x" * 3_000 + " and\n\n  more 'll 123 " * 900


@pytest.fixture(scope="session", autouse=True)
def prepared_session(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return table(spark, sf, "documents")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows, ties, a row without anything."""
    text = "the same words again and again until the end of this text which goes on for more than a hundred bytes all in all"
    rows = [
        (1, None, "en", "a", 0), (2, "", None, None, None), (3, " \n\t ", "en", "b", 4), (4, text, "en", "a", 10), (5, text, "en", "a", 10),
        (5, text, "en", "a", 10), (6, text + " but not quite", None, "b", 10), (7, LONG, "de", None, 1), (8, "été ÀÉ 漢字 🙂", "fr", "c", 9),
        (9, "12 34 !!", "xx", "c", 8), (None, "no id here at all", "en", "a", 5), (None, None, None, None, None),
        (10, "License: CC BY; all rights reserved. CC BY again", "en", "d", 40),
    ]
    return spark.createDataFrame(rows, DOCUMENT)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *[F.lit("other").alias(c) for c in CLASHING])


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is None, str(x)) for x in r])
