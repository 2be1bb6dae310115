import pytest

#: rows that every operator on documents must take: nulls, empty texts, repeats, a very long text
ODD = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 1), (1, "alpha beta gamma delta epsilon zeta", "en", "a", 1),
    (2, None, None, None, None), (None, "alpha beta gamma delta epsilon zeta", "en", "a", 1), (3, "", "en", "b", 0), (4, " \n\t ", "en", None, 3),
    (5, "word " * 60_000, "en", "b", 5), (6, "word " * 60_000, "en", "b", 5), (7, "é", "fr", "c", 1), (None, None, None, None, None),
]
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use themselves
CLASHES = ("size", "shard", "rep", "hub", "anchor", "at", "w", "words", "key", "score", "quality", "n_words", "kind", "piece", "target")


@pytest.fixture(scope="module")
def odd(spark):
    from pyspark.sql import functions as F

    return spark.createDataFrame(ODD, DOCUMENTS).withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCUMENTS)
