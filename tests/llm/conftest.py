import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def passage(seed: int, n: int) -> str:
    """n words, different for each seed."""
    return " ".join(f"{WORDS[(seed * 7 + i * i + i // 3) % len(WORDS)]}{(seed * 31 + i) % 97}" for i in range(n))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and
    extra columns whose names clash with what the operators add."""
    long = " ".join(passage(s, 400) for s in range(300))
    rows = [
        (1, passage(1, 80), "en", "a", 1, 1, "x"), (1, passage(1, 80), "en", "a", 1, 1, "x"),
        (2, passage(1, 80).replace("alpha", "ALPHA"), "en", None, None, 2, None),
        (3, None, None, None, None, None, None), (4, "", "en", "a", 0, 3, "y"), (5, " \n\t ", "en", "a", 3, 3, "y"),
        (6, "12 34", "de", "b", 5, 3, "y"), (None, passage(6, 60), "de", "b", 5, 3, "y"), (None, None, None, "b", 5, 3, "y"),
        (7, long, "fr", "b", len(long), 4, "z"), (8, passage(9, 70) + " déjà vu ÉTÉ 漢字 😀\x00", "fr", "b", 9, 4, "z"), (9, "one", "en", "a", 3, 1, "x"),
    ]
    columns = "doc_id long, text string, lang string, source string, n_chars long, n_words long, IDS string"
    df = spark.createDataFrame(rows, columns)
    for name in ("keep", "k", "path", "row_key", "Lang_Pred", "count_n_words", "label_id"):
        df = df.withColumn(name, df["n_words"])
    return df


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
