import math
import re

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from gridlore import functions as fx
from gridlore import operators as op
from gridlore import plans
from gridlore.operators.skew import Limits

LARGE = Limits(max_rows=0, parts=4, min_rows=2)


def value(spark, text, expression):
    frame = spark.createDataFrame([(text,)], "text string")
    return frame.select(expression(F.col("text"))).first()[0]


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "Id long, text string")


def test_tokens_and_words(spark):
    text = " It's WELL-known!!  42 a+b\n\tÉté "
    assert value(spark, text, fx.tokenize) == ["It's", "WELL-known!!", "42", "a+b", "Été"]
    words = ["its", "wellknown", "a+b", "été"]
    assert value(spark, text, lambda t: fx.normalize_tokens(fx.tokenize(t))) == words
    assert value(spark, text, fx.clean_words) == words
    assert value(spark, "  ", fx.clean_words) == []
    assert value(spark, "", fx.tokenize) == []
    assert value(spark, None, fx.clean_words) is None
    assert value(spark, "a,b,,c", lambda t: fx.tokenize(t, ",")) == ["a", "b", "c"]


def test_stop_words(spark):
    assert list(fx.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(fx.stop_words("french")) > 100
    keep = lambda t: fx.remove_stopwords(fx.tokenize(t))
    assert value(spark, "The cat and THE dog", keep) == ["cat", "dog"]
    exact = lambda t: fx.remove_stopwords(fx.tokenize(t), ["the"], case_sensitive=True)
    assert value(spark, "The cat and the dog", exact) == ["The", "cat", "and", "dog"]
    assert value(spark, "the and of", keep) == []


@pytest.mark.parametrize("text, words", [
    ("This is not a good book. It is fine", "this is not not_a not_good not_book it is fine"),
    ("not bad, but good", "not not_bad but good"),
    ("not never bad", "not never bad"),
    ("I don't like it! Really", "i dont not_like not_it really"),
    ("no ... fine", "no fine"),
    ("nothing notable", "nothing notable"),
    ("not a.b c", "not not_ab not_c"),
    ("(Not) good\nat all", "not not_good not_at not_all"),
    ("", ""), ("good", "good"), ("not", "not"), ("No.", "no"),
])
def test_negation(spark, text, words):
    assert value(spark, text, fx.mark_negation) == words.split()


def test_negated_stop_words_go_too(spark):
    dropped = ["the", "not"]
    words = value(
        spark, "not the best, the end", lambda t: fx.mark_negation(t, drop_words=dropped)
    )
    assert words == ["not_best", "end"]
    assert value(spark, "not good good", plans.sentiment_words) == ["not_good"]
    plain = lambda t: plans.sentiment_words(t, negation=False)
    assert value(spark, "not good good", plain) == ["good"]


def test_word_count_and_top(spark):
    texts = docs(spark, "bb aaa ccc", "ccc aaa bb", "", None)
    counts = op.word_count(texts, fx.clean_words(F.col("text")))
    assert sorted(map(tuple, counts.collect())) == [("aaa", 2), ("ccc", 2)]
    assert [r.word for r in op.top_words(counts, 1).collect()] == ["aaa"]


@pytest.mark.parametrize("limits", [Limits(), LARGE])
def test_lemmas(spark, limits):
    texts = docs(spark, "walk walks walked walking", "s ed sing ring", "the of", "", None)
    dictionary = op.build_lemma_dict(plans.review_vocabulary(texts))
    assert sorted(map(tuple, dictionary.collect())) == [
        ("sing", "s"), ("walked", "walk"), ("walking", "walk"), ("walks", "walk"),
    ]
    lemmas = {r.Id: r.result for r in plans.review_lemmas(texts, dictionary, limits=limits).collect()}
    # "s" is a stop word; texts without words keep their row, NULL texts do not.
    assert lemmas == {0: ["walk"] * 4, 1: ["ed", "s", "ring"], 2: [], 3: []}
    top = [tuple(r) for r in plans.top_lemmas(texts, k=2).collect()]
    assert top == [("walk", 4), ("ring", 1)]


TRAINING = [("good good book", "positive"), ("bad book", "negative"), ("good", "positive"),
            ("unlabelled", None)]


def test_naive_bayes_weights(spark):
    training = spark.createDataFrame(TRAINING, "text string, label string")
    model = op.train_nb(training, "label", fx.clean_words(F.col("text")))
    assert model.labels == ("negative", "positive")
    assert model.priors == (round(math.log(1 / 3) * 1e6), round(math.log(2 / 3) * 1e6))
    weights = {(r.w, r.label): r.weight for r in model.table().collect()}
    # 2 words seen under negative, 4 under positive, 3 different ones.
    assert weights["bad", "negative"] == round(math.log(2 / 5) * 1e6)
    assert weights["good", "positive"] == round(math.log(4 / 7) * 1e6)
    assert weights["bad", "positive"] == round(math.log(1 / 7) * 1e6)
    assert len(weights) == 6


@pytest.mark.parametrize("limits", [Limits(), LARGE])
def test_naive_bayes_labels(spark, limits):
    training = spark.createDataFrame(TRAINING, "text string, label string")
    words = fx.clean_words(F.col("text"))
    model = op.train_nb(training, "label", words)
    texts = docs(spark, "bad bad", "good", "", "unseen words", "book")
    found = {r.Id: r.label for r in op.predict_nb(texts, model, ["Id"], words, limits=limits).collect()}
    assert found == {0: "negative", 1: "positive", 2: "positive", 3: "positive", 4: "positive"}


def test_equal_scores_go_to_the_first_label(spark):
    training = spark.createDataFrame([("x", "b"), ("x", "a")], "text string, label string")
    words = fx.clean_words(F.col("text"))
    model = op.train_nb(training, "label", words)
    found = op.predict_nb(docs(spark, "x", "y"), model, ["Id"], words)
    assert {r.label for r in found.collect()} == {"a"}


@pytest.mark.parametrize("limits", [Limits(), LARGE])
def test_tagger(spark, limits):
    tagged = spark.createDataFrame(
        [("run", "V"), ("run", "N"), ("run", "V"), ("sing", "V"), ("king", "N"), ("ring", "N"),
         ("tie", "B"), ("tie", "A")],
        "token string, tag string",
    )
    tagger = op.train_tagger(tagged)
    assert tagger.default == "N" and tagger.tokens.count() == 5
    texts = docs(spark, "run tie thing xyz", "", "sing king")
    words = fx.tokenize(F.col("text"))
    found = op.tag_tokens(texts, tagger, ["Id"], words, limits=limits)
    assert {r.Id: r.pos_tags for r in found.collect()} == {
        0: ["V", "A", "N", "N"], 1: [], 2: ["V", "N"],
    }


@pytest.mark.parametrize("limits", [Limits(), LARGE])
def test_annotations(spark, limits):
    training = spark.createDataFrame(TRAINING, "text string, label string")
    mood = plans.train_sentiment(training)
    tongue = op.train_nb(
        spark.createDataFrame([("the book", "en"), ("das buch", "de")], "text string, lang string"),
        "lang", fx.clean_words(F.col("text")),
    )
    tagger = op.train_tagger(spark.createDataFrame([("the", "D"), ("book", "N"), ("buch", "N")],
                                                   "token string, tag string"))
    texts = docs(spark, "the bad book", "das buch", "", None)
    notes = plans.annotate_reviews(texts, mood, tongue, tagger, limits=limits)
    assert notes.columns == ["Id", "sentiment", "language", "pos"]
    assert {r.Id: tuple(r)[1:] for r in notes.collect()} == {
        0: ("negative", "en", ["D", "N", "N"]),
        1: ("positive", "de", ["N", "N"]),
        2: ("positive", "de", []),
    }


def test_title_stats(spark):
    labelled = spark.createDataFrame(
        [("A", 4.0, "positive"), ("A", 5.0, "negative"), ("A", 5.0, "positive"),
         ("B", 1.0, "negative"), (None, 2.0, "positive"), (None, 3.0, "negative")],
        "Title string, score double, sentiment string",
    )
    zero = {r.Title: tuple(r)[1:] for r in plans.title_stats(labelled).collect()}
    assert zero == {"A": (3, 2, 66.67, 4.67), "B": (1, 0, 0.0, 1.0), None: (2, 0, 0.0, 2.5)}
    counted = {r.Title: tuple(r)[1:] for r in plans.title_stats(labelled, "count").collect()}
    assert counted[None] == (2, 1, 50.0, 2.5)


def test_no_python_in_the_plans(spark, plan):
    texts = docs(spark, "a book", "another")
    model = plans.train_sentiment(spark.createDataFrame(TRAINING, "text string, label string"))
    for result in (plans.predict_sentiment(texts, model), plans.top_lemmas(texts)):
        text = plan(result)
        assert "EvalPython" not in text and "InPandas" not in text


@pytest.mark.parametrize("limits", [Limits(), LARGE])
def test_rows_need_no_key(spark, limits):
    """Ids that repeat, and copies, keep one result for each row."""
    training = spark.createDataFrame(TRAINING, "text string, label string")
    mood = plans.train_sentiment(training)
    rows = [("1", "T", 4.0, "bad book"), ("1", "T", 4.0, "good"), ("1", "T", 4.0, "good"),
            ("1", None, 5.0, "good good"), ("1", "T", None, "bad"), (None, "T", 1.0, "good")]
    reviews = spark.createDataFrame(rows, "Id string, Title string, score double, text string")
    found = plans.predict_sentiment(reviews, mood, ["Id", "text"], limits=limits).collect()
    assert sorted((r.text, r.sentiment) for r in found) == [
        ("bad", "negative"), ("bad book", "negative"), ("good", "positive"), ("good", "positive"),
        ("good", "positive"), ("good good", "positive"),
    ]
    report = plans.title_sentiment(reviews, mood, limits=limits).collect()
    stats = {r.Title: tuple(r)[1:] for r in report}
    assert stats == {"T": (5, 3, 60.0, 3.25), None: (1, 0, 0.0, 5.0)}

    dictionary = spark.createDataFrame([("books", "book")], "form string, lemma string")
    lemmas = plans.review_lemmas(reviews, dictionary, limits=limits).collect()
    assert sorted(map(str, (r.result for r in lemmas))) == sorted(
        map(str, [["bad", "book"], ["good"], ["good"], ["good", "good"], ["bad"], ["good"]])
    )
    tongue = op.train_nb(training, "label", fx.clean_words(F.col("text")))
    tagger = op.train_tagger(spark.createDataFrame([("bad", "J"), ("book", "N")],
                                                   "token string, tag string"))
    notes = plans.annotate_reviews(reviews, mood, tongue, tagger, limits=limits).collect()
    assert sorted(str((r.Id, r.sentiment, r.pos)) for r in notes) == sorted(map(str, [
        ("1", "negative", ["J", "N"]), ("1", "positive", ["J"]), ("1", "positive", ["J"]),
        ("1", "positive", ["J", "J"]), ("1", "negative", ["J"]), (None, "positive", ["J"]),
    ]))


@pytest.mark.parametrize("limits", [Limits(), LARGE])
def test_words_of_a_table_are_dropped(spark, limits):
    texts = docs(spark, "The book and the shelf", "the THE", "", None, "plain", "plain")
    table = spark.createDataFrame([("the",), ("AND",), (None,), ("the",)], "word string")
    kept = op.drop_words(texts, ["Id"], fx.tokenize(F.col("text")), table, limits=limits)
    assert {r.Id: r.words for r in kept.collect()} == {
        0: ["book", "shelf"], 1: [], 2: [], 3: [], 4: ["plain"], 5: ["plain"]
    }


def test_steps_of_both_kinds(spark):
    mood = plans.train_sentiment(spark.createDataFrame(TRAINING, "text string, label string"))
    steps = [
        ("tokens", "text", fx.tokenize),
        lambda d: plans.predict_sentiment(d, mood, ["Id", "tokens"]),
    ]
    found = plans.text_features(docs(spark, "bad book", "good"), steps)
    assert {r.Id: (r.tokens, r.sentiment) for r in found.collect()} == {
        0: (["bad", "book"], "negative"), 1: (["good"], "positive")
    }


def test_the_number_of_labels_is_a_parameter(spark):
    many = spark.createDataFrame([(f"l{i}", f"w{i}") for i in range(30)], "label string, text string")
    words = fx.clean_words(F.col("text"))
    assert len(op.train_nb(many, "label", words, max_labels=30).labels) == 30
    with pytest.raises(ValueError, match="more than 29 labels"):
        op.train_nb(many, "label", words, max_labels=29)


def test_tables_that_fit_need_no_shuffle(spark, plan):
    texts = docs(spark, "the bad book", "a good one")
    training = spark.createDataFrame(TRAINING, "text string, label string")
    mood = plans.train_sentiment(training)
    tongue = op.train_nb(training, "label", fx.clean_words(F.col("text")))
    tagger = op.train_tagger(spark.createDataFrame([("bad", "J")], "token string, tag string"))
    dictionary = spark.createDataFrame([("books", "book")], "form string, lemma string")
    for result in (
        plans.review_lemmas(texts, dictionary),
        op.tag_tokens(texts, tagger, ["Id"], fx.tokenize(F.col("text"))),
        plans.annotate_reviews(texts, mood, tongue, tagger),
        op.drop_words(texts, ["Id"], fx.tokenize(F.col("text")),
                      dictionary.withColumnRenamed("form", "word")),
    ):
        assert "Exchange" not in plan(result)


def test_large_models_are_met_in_one_join_and_gathered_once(spark, plan):
    texts = docs(spark, "the bad book", "a good one", "a good one", "", None)
    training = spark.createDataFrame(TRAINING, "text string, label string")
    mood = plans.train_sentiment(training)
    tongue = op.train_nb(training, "label", fx.clean_words(F.col("text")))
    tagger = op.train_tagger(spark.createDataFrame([("bad", "J")], "token string, tag string"))
    large = plans.annotate_reviews(texts, mood, tongue, tagger, ["Id"], Limits(max_rows=0))
    small = plans.annotate_reviews(texts, mood, tongue, tagger, ["Id"])
    text = plan(large)
    # The words, the suffixes, and two branches of the same aggregation for few and many copies.
    steps = re.findall(r"^\(\d+\) (SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", text, re.M)
    branches = text.count("Union") and 2
    assert len(steps) <= 2 * branches
    assert sorted(map(str, large.collect())) == sorted(map(str, small.collect()))
    assert large.count() == 4


def test_words_go_to_python_once(spark, plan):
    texts = docs(spark, "the bad book", "a good one").repartition(4)
    training = spark.createDataFrame(TRAINING, "text string, label string")
    mood = plans.train_sentiment(training)
    tongue = op.train_nb(training, "label", fx.clean_words(F.col("text")))
    tagger = op.train_tagger(spark.createDataFrame([("bad", "J")], "token string, tag string"))
    dictionary = spark.createDataFrame([("books", "book")], "form string, lemma string")
    lemmas = plans.review_lemmas(texts, dictionary)
    lists = [name for name, kind in lemmas.dtypes if kind == "array<string>"]
    assert lists
    for result in (
        lemmas,
        lemmas.select("Id", F.posexplode(lists[-1])),
        op.tag_tokens(texts, tagger, ["Id"], fx.tokenize(F.col("text"))),
        plans.annotate_reviews(texts, mood, tongue, tagger),
    ):
        assert len(re.findall(r"^\(\d+\) ArrowEvalPython", plan(result), re.M)) == 1
