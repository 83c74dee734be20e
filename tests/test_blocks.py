"""Words of texts looked up in tables that are too large to hold."""
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gridlore import functions as fx
from gridlore import operators as op
from gridlore import plans
from gridlore.operators.blocks import answered, block_words, in_blocks, picked, picked_known, sums

LARGE = op.Limits(max_rows=0)
TEXTS = [(0, "a b a c"), (1, ""), (2, None), (3, "b b"), (4, "d a e f g"), (5, "b b"), (5, "b b")]


def texts_of(spark):
    return spark.createDataFrame(TEXTS, "Id long, text string").coalesce(1)


def test_blocks_hold_each_word_once(spark):
    words = fx.tokenize(F.col("text"))
    blocks = in_blocks(texts_of(spark), ["Id"], [words, F.reverse(words)], size=4)
    rows = [tuple(r) for r in block_words(blocks).collect()]
    assert len({r[0] for r in rows}) > 2
    assert len({(r[0], r[1], r[3]) for r in rows}) == len(rows)
    assert {r[3] for r in rows} == set("abcdefg")
    back = answered(
        blocks, block_words(blocks), ["Id"], {"own": "array<string>", "turned": "array<string>"},
        lambda codes, tables: [picked(c, t, "token") for c, t in zip(codes, tables)],
    )
    assert sorted((r.Id, r.own, r.turned) for r in back.collect()) == sorted(
        (i, (text or "").split(), (text or "").split()[::-1]) for i, text in TEXTS
    )


def test_unknown_words_count_nothing():
    import numpy as np

    codes = np.array([0, 1, 0, 2], np.int32), np.array([0, 3, 3, 4])
    found = pa.table({"_code": pa.array([2, 0, 1], pa.int32()), "w": [[5, 7], [1, 2], None], "v": ["x", None, "y"]})
    assert sums(codes, found, "w", 2).to_pylist() == [[2, 4], [0, 0], [5, 7]]
    assert sums(codes, found.slice(0, 0), "w", 2).to_pylist() == [[0, 0]] * 3
    assert picked(codes, found, "v").to_pylist() == [[None, "y", None], [], ["x"]]
    assert picked_known(codes, found, "v").to_pylist() == [["y"], [], ["x"]]


def _models(spark):
    training = spark.createDataFrame([("a b b", "x"), ("d e a", "y"), ("c", "x")], "text string, label string")
    tagger = op.train_tagger(spark.createDataFrame([("a", "A"), ("bcd", "B")], "token string, tag string"))
    return op.train_nb(training, "label", fx.clean_words(F.col("text"))), tagger


def _large(spark, docs, name, limits):
    model, tagger = _models(spark)
    words = fx.clean_words(F.col("text"))
    listed = spark.createDataFrame([("B",)], "word string")
    return {
        "predict": lambda: op.predict_nb(docs, model, ["Id", "text"], words, scores=True, limits=limits),
        "annotate": lambda: plans.annotate_reviews(docs, model, model, tagger, ["Id", "text"], limits),
        "tag": lambda: op.tag_tokens(docs, tagger, ["Id", "text"], words, limits=limits),
        "drop": lambda: op.drop_words(docs, ["Id", "text"], words, listed, limits=limits),
        "lemma": lambda: op.lemmatize(
            docs, spark.createDataFrame([("b", "a")], "form string, lemma string"), ["Id", "text"], words, limits=limits
        ),
    }[name]()


@pytest.mark.parametrize("name", ["predict", "annotate", "tag", "drop", "lemma"])
def test_rows_of_words_carry_no_kept_columns(spark, plan, name):
    """A text kept beside each of its words would be shuffled as often as it has words."""
    large = _large(spark, texts_of(spark), name, LARGE)
    generated = [x for x in plan(large).split("\n\n") if re.match(r"\(\d+\) Generate", x)]
    assert not [x for x in generated if re.search(r"\b(Id|text|_kept)#", x)]
    small = _large(spark, texts_of(spark), name, op.Limits())
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))


@pytest.mark.parametrize("name", ["predict", "annotate", "tag", "drop", "lemma"])
def test_texts_without_words_and_no_texts(spark, name):
    bare = texts_of(spark).where("Id IN (1, 2)")
    found = [_large(spark, bare, name, limits).collect() for limits in (LARGE, op.Limits())]
    assert sorted(map(str, found[0])) == sorted(map(str, found[1])) and found[0]
    assert _large(spark, texts_of(spark).where("Id > 9"), name, LARGE).collect() == []
