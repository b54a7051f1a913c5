import pytest

LONG = "lorem ipsum dolor sit amet consetetur sadipscing elitr " * 3000


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = [
        (1, "alpha beta gamma delta epsilon zeta", "en", "a", 1, "x"),
        (2, "alpha  beta\tgamma delta epsilon zeta", "en", "b", None, "y"),
        (2, "alpha  beta\tgamma delta epsilon zeta", "en", "b", None, "y"),
        (3, "", "de", "a", 0, None),
        (4, None, None, None, None, None),
        (None, "token = abcdef0123456789abcdef0123456789", None, "b", 5, "z"),
        (None, None, None, None, None, None),
        (5, " \n ", "fr", "c", 3, "z"),
        (6, LONG, "en", "c", len(LONG), "z"),
        (7, LONG + "end", "en", "a", 1, "z"),
        (8, "ünï ÇØDE é " * 40, "fr", None, 1, "z"),
        (9, "one two", "en", "a", 7, "z"),
    ]
    # Names that the operators use for columns of their own.
    extra = "id string, size string, copies string, _key string, _fp string, _digest string, score string, label string"
    schema = f"doc_id long, text string, lang string, source string, n_chars long, fp string, {extra}"
    return spark.createDataFrame([(*r, *["own"] * 8) for r in rows], schema)


@pytest.fixture(scope="session")
def nothing(spark, messy):
    return spark.createDataFrame([], messy.schema)
