"""Sentiment of reviews, and the sentiment report by title."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.functions.stopwords import ENGLISH_STOP_WORDS
from gridlore.functions.words import NEGATORS, clean_words, mark_negation, remove_stopwords
from gridlore.operators.bayes import NaiveBayes, predict_nb, train_nb
from gridlore.operators.skew import DEFAULT, Limits


def sentiment_words(
    text: Column,
    stopwords: Sequence[str] = ENGLISH_STOP_WORDS,
    negators: Sequence[str] = NEGATORS,
    negation: bool = True,
) -> Column:
    """The distinct words that sentiment is judged by.

    Negation is marked before stop words go, since the stop words include the
    negators. ``negation=False`` takes the plain words.
    """
    lowered = [word.lower() for word in stopwords]
    if negation:
        words = mark_negation(text, negators, lowered)
    else:
        words = remove_stopwords(clean_words(text), lowered, case_sensitive=True)
    return F.array_distinct(words)


def train_sentiment(reviews: DataFrame, label: str = "label", **options) -> NaiveBayes:
    """Train on reviews whose ``label`` is ``positive`` or ``negative``."""
    return train_nb(reviews, label, sentiment_words(F.col("text"), **options))


def predict_sentiment(
    reviews: DataFrame,
    model: NaiveBayes,
    keep: Sequence[str] = ("Id",),
    out: str = "sentiment",
    copies_as: str | None = None,
    by: Sequence[str] | None = None,
    limits: Limits = DEFAULT,
    **options,
) -> DataFrame:
    """``(*keep, out)`` for each review with a text.

    ``options`` are those of ``sentiment_words``, the same as in training.
    """
    texts = reviews.where(F.col("text").isNotNull())
    words = sentiment_words(F.col("text"), **options)
    return predict_nb(
        texts, model, keep, words, out, copies_as=copies_as, by=by, limits=limits
    )


def title_stats(
    labelled: DataFrame, null_title: str = "zero", copies: str | None = None
) -> DataFrame:
    """Reviews, positive reviews, percentage and mean score for each title.

    ``labelled`` has Title, score and sentiment, and where ``copies`` names a
    column, a row stands for that many reviews. Reviews without a title form a
    group whose positive reviews are not counted, unless ``null_title`` is
    ``count``.
    """
    if null_title not in ("zero", "count"):
        raise ValueError("null_title is 'zero' or 'count'")
    number = F.lit(1).cast("bigint") if copies is None else F.col(copies)
    positive = F.col("sentiment") == "positive"
    if null_title == "zero":
        positive = positive & F.col("Title").isNotNull()
    scored = F.sum(F.when(F.col("score").isNotNull(), number))
    stats = labelled.groupBy("Title").agg(
        F.sum(number).alias("total_reviews"),
        F.sum(F.when(positive, number).otherwise(0)).alias("positive_count"),
        (F.sum(F.col("score") * number) / scored).alias("mean_score"),
    )
    return stats.select(
        "Title",
        "total_reviews",
        "positive_count",
        F.round(F.col("positive_count") / F.col("total_reviews") * 100, 2).alias("percent_pos"),
        F.round("mean_score", 2).alias("avg_score"),
    )


def title_sentiment(
    reviews: DataFrame,
    model: NaiveBayes,
    null_title: str = "zero",
    limits: Limits = DEFAULT,
    **options,
) -> DataFrame:
    """``title_stats`` of reviews whose sentiment is predicted with ``model``."""
    labelled = predict_sentiment(
        reviews, model, ["Title", "score"], copies_as="copies", limits=limits, **options
    )
    return title_stats(labelled, null_title, "copies")
