import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed, n, letters="abcdefghij"):
    """Words of a text that no other seed gives."""
    own = random.Random(repr(seed))
    return ["".join(own.choice(letters) for _ in range(own.randint(3, 8))) for _ in range(n)]


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def odd(docs_of):
    """NULLs, empty and long texts, repeated rows, ids that are not unique."""
    long = " ".join(words("long", 30_000))
    rows = [
        (None, None), (None, "a b"), (None, "a b"), (1, None), (2, ""), (3, " \n "), (4, "one"),
        (5, long), (6, long), (7, "Zwei  Wörter\n\n日本語 <|endoftext|> ."), (7, "other words of it"),
        (8, "same row"), (8, "same row"), (9, "\t tabs \r\n"), (10, "it's 12 o'clock, isn't it?"),
    ]
    return docs_of(rows)


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with columns that operators use names like."""
    from pyspark.sql import functions as F

    names = ("_row", "k1", "mark", "words", "shingles", "size", "shard", "start", "key", "score", "_id", "_doc", "item", "_block")
    return odd.select("*", *[F.lit("x").alias(name) for name in names])


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")
