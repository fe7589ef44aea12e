import pytest

LONG = "word " * 60_000 + "end."


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "s", 10),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "s", 10),
        (2, "The quick brown fox jumps over the lazy dog near the river bank today.", "en", "s", 10),
        (3, None, None, None, None), (4, "", "en", "s", 0), (5, " \n\t ", "en", "s", 4), (6, "one", "en", None, 3),
        (None, "null id text with some words in it", "en", "s", 5), (None, None, None, None, None),
        (7, LONG, "en", "s", len(LONG)),
        (8, "token = \"a94a8fe5ccb19ba61c4c0873d391e987982fbbd3\" mail a.b@mail.example.com +1 (555) 123-4567", "en", "s", 1),
        (9, "日本語 текст ελληνικά 12 \x1c x  y z", "xx", "s", 1),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for clash in ("fp", "component_id", "shard", "slot", "spans", "part", "score", "kept", "raw", "mask", "size", "length"):
        df = df.selectExpr("*", f"'x' as {clash}")
    return df


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, 0, 0), (None, 1, 0), (99, 0, 1), (7, None, None)],
                                 "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def benchmark(spark):
    return spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi"),
                                  (2, None), (3, ""), (None, "lone words"), (4, "tiny")], "item_id long, text string")


def none_of(df):
    return df.where("false")
