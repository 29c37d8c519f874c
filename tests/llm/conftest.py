import pytest

ODD = [
    # Nulls, empty and white texts, ties, repeated rows, one very long text.
    (1, "a b c d e f g h i j k l m n o p", "x"),
    (2, "a b c d e f g h i j k l m n o p", "x"),
    (2, "a b c d e f g h i j k l m n o p", "x"),
    (3, None, "y"),
    (4, "", None),
    (5, " \t\n\x0b\x0c\r ", "y"),
    (6, "one", None),
    (None, "nobody's text has these words", "x"),
    (None, None, None),
    (7, "long " * 20_000, "z"),
    (8, "é ü 😀 \x00 ß", "z"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd values, more columns and names that operators use themselves."""
    rows = [(*row, "en", 1, 2.0, "k", 3) for row in ODD]
    return spark.createDataFrame(
        rows,
        "doc_id bigint, text string, source string, lang string, size int, score double, "
        "key string, copies int",
    ).repartition(3)


@pytest.fixture(scope="session")
def no_rows(odd):
    return odd.limit(0)
