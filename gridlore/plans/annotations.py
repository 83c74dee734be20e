"""Lemmas and annotations of review texts."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.functions.stopwords import ENGLISH_STOP_WORDS
from gridlore.functions.words import clean_words, remove_stopwords, tokenize
from gridlore.operators.bayes import NaiveBayes, label_of, score_columns, weight_lists, with_priors
from gridlore.operators.blocks import answered, block_words, in_blocks, meet, picked, sums
from gridlore.operators.lemmas import build_lemma_dict, lemma_count, lemmatize, top_words
from gridlore.operators.skew import DEFAULT, Limits, fits_broadcast
from gridlore.operators.tagging import Tagger, fits_tagger, suffixed, tag_column
from gridlore.operators.tokens import word_count
from gridlore.plans.sentiment import sentiment_words
from gridlore.sources.shared import materialize


def content_words(text: Column, stopwords: Sequence[str] = ENGLISH_STOP_WORDS) -> Column:
    """Normalized words of a text without stop words."""
    lowered = [word.lower() for word in stopwords]
    return remove_stopwords(clean_words(text), lowered, case_sensitive=True)


def review_lemmas(
    reviews: DataFrame,
    dictionary: DataFrame,
    keep: Sequence[str] = ("Id",),
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``(*keep, result)``: the lemmas of each review with a text."""
    texts = reviews.where(F.col("text").isNotNull())
    return lemmatize(texts, dictionary, keep, content_words(F.col("text")), limits=limits)


def review_vocabulary(reviews: DataFrame) -> DataFrame:
    """``(word, count)`` for the normalized words of all reviews."""
    texts = reviews.where(F.col("text").isNotNull())
    return word_count(texts, clean_words(F.col("text")), min_length=1)


def top_lemmas(
    reviews: DataFrame,
    dictionary: DataFrame | None = None,
    k: int = 20,
    stopwords: Sequence[str] = ENGLISH_STOP_WORDS,
) -> DataFrame:
    """The ``k`` most frequent lemmas of more than two characters.

    Without a dictionary one is built from the reviews themselves. The words
    are counted once, into a written table, for the dictionary and the result.
    """
    counts = materialize(review_vocabulary(reviews), "vocabulary")
    if dictionary is None:
        dictionary = build_lemma_dict(counts)
    content = counts.where(~F.col("word").isin(*sorted({word.lower() for word in stopwords})))
    return top_words(lemma_count(content, dictionary), k)


def annotate_reviews(
    reviews: DataFrame,
    sentiment: NaiveBayes,
    language: NaiveBayes,
    tagger: Tagger,
    keep: Sequence[str] = ("Id",),
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``(*keep, sentiment, language, pos)`` for each review with a text.

    The language is judged by all words, tags go to the tokens as written. With
    models that fit a broadcast, each review is annotated where it is; otherwise the
    reviews are written when this is called.
    """
    written = reviews.where(F.col("text").isNotNull())
    models = [sentiment, language]
    if fits_tagger(tagger, limits) and all(fits_broadcast(x.weights, limits) for x in models):
        text = F.col("text")
        scored = written.select(
            *keep,
            score_columns(sentiment_words(text), sentiment).alias("_mood"),
            score_columns(clean_words(text), language).alias("_language"),
            tag_column(tokenize(text), tagger).alias("pos"),
        )
        return scored.select(
            *keep,
            label_of(F.col("_mood"), sentiment).alias("sentiment"),
            label_of(F.col("_language"), language).alias("language"),
            "pos",
        )
    return _annotate_blocks(written, sentiment, language, tagger, keep, limits)


_MOOD, _LANGUAGE, _TAG = 0, 1, 2


def _weighed(model: NaiveBayes, kind: int) -> DataFrame:
    return weight_lists(model).select(
        F.lit(kind).alias("_kind"), "token", "_weights", F.lit(None).cast("string").alias("tag")
    )


def _annotate_blocks(
    written: DataFrame,
    sentiment: NaiveBayes,
    language: NaiveBayes,
    tagger: Tagger,
    keep: Sequence[str],
    limits: Limits,
) -> DataFrame:
    """``annotate_reviews`` with models too large to hold.

    The different words of a block of texts, for all three results, are rows of one
    table, told apart by a kind. They meet the three models in one join, suffixes in a
    second, and come back to their block once.
    """
    text = F.col("text")
    # In the order of the kinds.
    lists = [sentiment_words(text), clean_words(text), tokenize(text)]
    blocks = in_blocks(written, keep, lists)
    tags = tagger.tokens.select(
        F.lit(_TAG).alias("_kind"), "token", F.lit(None).cast("array<bigint>").alias("_weights"), "tag"
    )
    models = _weighed(sentiment, _MOOD).unionByName(_weighed(language, _LANGUAGE)).unionByName(tags)
    found = meet(block_words(blocks), models, ["_kind", "token"])
    found = suffixed(found, tagger, limits, F.col("_kind") == _TAG)
    moods, languages = len(sentiment.labels), len(language.labels)
    notes = answered(
        blocks, found.select("_block", "_kind", "_code", "_weights", "_tag"), keep,
        {"_mood": "array<bigint>", "_language": "array<bigint>", "pos": "array<string>"},
        lambda codes, tables: [
            sums(codes[_MOOD], tables[_MOOD], "_weights", moods),
            sums(codes[_LANGUAGE], tables[_LANGUAGE], "_weights", languages),
            picked(codes[_TAG], tables[_TAG], "_tag"),
        ],
    )
    return notes.select(
        *keep,
        label_of(with_priors("_mood", sentiment), sentiment).alias("sentiment"),
        label_of(with_priors("_language", language), language).alias("language"),
        "pos",
    )


Step = tuple[str, str, Callable[[Column], Column]] | Callable[[DataFrame], DataFrame]


def text_features(docs: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Apply steps in order.

    A step is a function from DataFrame to DataFrame, such as one that applies a
    trained model, or ``(new column, column it is made from, function)``, for
    example ``("token", "text", tokenize)``.
    """
    for step in steps:
        if callable(step):
            docs = step(docs)
        else:
            out, source, function = step
            docs = docs.withColumn(out, function(F.col(source)))
    return docs
