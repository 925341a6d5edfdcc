import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, gid string, label int, doc string"
WORDS = "the and of tion ander with from that this then hear stone river maple cloud frame table night".split()


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "s", "er", "ing"]) for _ in range(n))


def edge_documents():
    """Nulls, empties, repeats, ties, long shared prefixes, near copies and columns whose names clash with added ones."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, base, "en", "b"), (2, base, "en", "a"), (3, " ".join(near), "en", "a"), (4, None, None, None), (5, "", "en", None),
        (6, "   \n", "de", "b"), (7, "x" * 200, "en", "c"), (8, "x" * 200 + "y", "en", "c"), (9, "x" * 199, "en", "c"),
        (10, "one two", "en", "a"), (10, "one two", "en", "a"), (11, "é" * 70, "fr", "é"), (12, prose(2, 3_000), "en", "a"),
        (None, "no id here", "en", "a"), (13, "12345 !!!", "en", "d"), (14, "<|endoftext|> İx it's 5kg", "en", "d"), (15, "one two", "de", "z"),
    ]
    return [(i, t, lang, s, None, 7, "g", 1, "d") for i, t, lang, s in texts]


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(edge_documents(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
