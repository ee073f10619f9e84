import pytest

pytest.importorskip("weft.llm")

AWKWARD = [
    (1, None, "en", None, 0), (2, "", "en", "a", 0), (3, "   \n \n", None, "a", 0), (4, "one two", "en", "", 7), (5, "one two", "en", "", 7),
    (6, "x" * 300_000, "en", "a", 300_000), (7, "Straße été \U0001f642 " * 60, "de", "b", 0), (8, "Under the MIT license.\nAll rights reserved.", "en", "b", 0),
    (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3, "en", "a", 0), (10, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3, "fr", None, 0),
    (None, "no id here at all, sorry", "en", "a", 1), (11, "\x00\x01 control \x7f <|endoftext|> tail", "en", "a", 1), (11, "\x00\x01 control \x7f <|endoftext|> tail", "en", "a", 1),
]
DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, and extra columns with names that operators use."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(AWKWARD, DDL)
    extra = ("rep", "size", "h1", "h2", "spans", "line", "words", "host", "pages", "label", "u", "p", "node", "rank", "chunk", "score")
    return rows.withColumns({c: F.lit(None).cast("string") for c in extra})


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DDL)
