import pytest

ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one two three"),
    (5, "one  two\tthree"),
    (6, "word " * 400),
    (7, "a b c d e f g h i j " * 30),
    (8, "Ünïcode ñandú 日本語 😀 mail a.b@x.org and +1 (017) 555-7713, 10.0.0.1, 4111 1111 1111 1111"),
    (9, "x" * 70000),
    (10, "one two three four five"),
    (10, "one two three four five"),
    (None, "one two three four five"),
    (11, "<|endoftext|> don't I'LL  \r\n <|startoftext|>"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, short, long and repeated texts, a null identifier, and columns with clashing names."""
    rows = [(i, t, "src", "en", 7, "x", 1.5) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, owner string, n double").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.filter("false")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
