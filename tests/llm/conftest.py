import pytest

TEXTS = [
    (1, None),
    (2, ""),
    (3, "one two three"),
    (4, "Łódź ßtraße 漢字 🙂 é   <|endoftext|> \x1c\x1f end"),
    (5, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 8),
    (5, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 8),
    (6, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 8 + "tail words here"),
    (7, "x" * 30000),
    (8, "lorem ipsum " * 20000),
    (9, "\n \n\t\n line\nline\n  \nline"),
    (10, "### $$$ %%% &&& *** " * 30),
    (None, "a text without an id"),
]

#: Names that the operators themselves might give to columns.
NAMES = ("tw_spans", "tw_q", "tw_mix", "tw_h1", "tw_h2", "tw_s", "tw_score", "tw_copy", "tw_1", "tw_2", "tw_id", "tw_n", "tw_own", "tw_k")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns whose names clash with the operators' own."""
    rows = [(i, t, "n", "k", 1, None, *["mine"] * len(NAMES)) for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, words string, anchor string, id int, spans string, " + ", ".join(f"{n} string" for n in NAMES))


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 2), int(i == 3)) for i in range(2, 11)] + [(2, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
