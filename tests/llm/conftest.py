import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, start long, score double, sequence_id string"


def documents(spark, rows):
    """Rows (doc_id, text, lang, source) as documents with further columns whose names clash with results."""
    return spark.createDataFrame([(*r, None, 7, 0.5, "x") for r in rows], DOCS)


@pytest.fixture
def odd(spark):
    """Nulls everywhere, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(30_000))
    return documents(
        spark,
        [
            (1, "Released under the MIT License. Fine text of more than ten words here, so it is kept.", "en", "a"),
            (2, "", "en", "a"),
            (3, None, None, None),
            (4, long, "en", "b"),
            (5, "same text twice, with words enough to be a text of its own", "en", "a"),
            (5, "same text twice, with words enough to be a text of its own", "en", "a"),
            (6, "same text twice, with words enough to be a text of its own", "de", "b"),
            (None, "no id here but some words", "fr", "a"),
            (7, "naïve café ÀÉ 日本語 \x00   emoji 😀 <|endoftext|>", "fr", None),
            (8, " \t\n ", "es", "c"),
        ],
    )


@pytest.fixture
def none(spark):
    return documents(spark, [])
