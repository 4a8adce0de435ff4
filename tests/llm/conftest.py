import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, shard string, label string"


def documents(spark, rows):
    """Documents with further columns whose names the operators use themselves; a row is (id, text[, source])."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None, "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, DOCS)


#: Nulls, empty and blank texts, repeated rows and ids, ties, control and non-Latin characters, a very long text.
ODD = [
    (1, None, None),
    (2, ""),
    (3, "  \t\n "),
    (4, "one"),
    (5, "Alpha beta Gamma delta"),
    (5, "Alpha beta Gamma delta"),
    (6, "alpha BETA gamma delta"),
    (None, "alpha beta gamma delta", None),
    (None, None, None),
    (7, "\u00c9t\u00e9 \u4f60\u597d \U0001f600 na\u00efve \x1c \x85 end"),
    (8, " ".join(f"w{i % 977}" for i in range(60_000)), "big"),
    (8, "another text under the same id"),
]


@pytest.fixture
def odd(spark):
    return documents(spark, ODD)


@pytest.fixture
def none(spark):
    return documents(spark, [])
