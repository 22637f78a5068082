import random

import pytest


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package sent to the workers."""
    from linemill.session import ship_package
    ship_package(spark)
    return spark


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, repeated rows, ties, other scripts."""
    rng = random.Random(3)
    base = " ".join(rng.choice("alpha beta gamma delta the of".split()) for _ in range(60))
    return [(1, "Hello there, world", "en"), (2, None, "en"), (3, "", None), (4, "Hello there, world", "en"),
            (4, "Hello there, world", "en"), (None, "Hello there, world", "en"), (5, base, "en"),
            (6, base + " x", "en"), (7, "日本語 テスト 12 34", "ja"), (8, " \t\n ", None), (9, "é" * 5000, "fr"),
            (10, base * 40, "en"), (11, "12345 !!", None), (None, None, None)]


@pytest.fixture(scope="session")
def odd(llm, odd_rows):
    return llm.createDataFrame(odd_rows, "doc_id long, text string, lang string").repartition(3)


@pytest.fixture(scope="session")
def none(llm):
    return llm.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def docs(llm):
    return llm.read.parquet("/root/testdata/sf0.001/documents.parquet")


def as_tuples(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
