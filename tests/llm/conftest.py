import pytest

#: Nulls in every column, empty and very long texts, ties, repeated rows and an
#: extra column whose name clashes with those that the operators use inside.
ODD = [
    (1, "a b c", "en", "s", 5, 1),
    (1, "a b c", "en", "s", 5, 1),
    (2, None, None, None, None, None),
    (3, "", "en", "s", 0, 2),
    (None, "no id here", "en", None, 3, 3),
    (None, None, None, None, None, None),
    (4, "  two  blanks \n and\ta tab ", "en", "s", 9, 4),
    (5, "日本語 のテキスト é́ 🙂", "ja", "s", 9, 5),
    (6, "12 !! ?", None, "s", 7, 6),
    (7, "word " * 9000 + "end.", "en", "s", 45004, 7),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key int"


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
