import pytest

LONG = " ".join(f"word{i % 977} mail{i}@example.org" for i in range(20_000))


def edge_rows():
    """Nulls in any column, empty and very long texts, ties and repeated rows."""
    base = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    texts = [
        (1, base), (2, base), (2, base), (3, base + "  "), (4, base + "\t\n"), (5, None), (6, ""), (7, " \n\t"),
        (8, LONG), (9, LONG + " end"), (None, base), (None, None), (10, "é à ü ñ 日本語 😀"), (11, "…!?—"),
        (12, "under the MIT License, call +1 (555) 123-4567 or a.b@c.de, 4111 1111 1111 1111, 10.0.0.1"),
        (13, "x" * 70_000), (14, "1 " * 30_000), (15, "a\x00b \x1c c\x85d"), (16, "<|endoftext|> <s> </turn> \\# ###"),
        (17, "one two three four"), (18, "one two three four"), (19, "for " * 300),
    ]
    return [(i, t, None if n % 5 == 0 else ("en", "fr")[n % 2], None if n % 7 == 0 else f"src{n % 3}",
             None if n % 4 == 0 else n, n, "x", 0.5, n % 2 == 0) for n, (i, t) in enumerate(texts)]


#: the columns of documents, and extra ones with names that the operators use themselves
EDGE_SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
               "uid long, digest string, score double, kept boolean")


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), EDGE_SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], EDGE_SCHEMA)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def marks(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


@pytest.fixture(scope="session")
def no_marks(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
