"""Cleaning and statistics of reviews.

Reviews have the columns Id, Title, Price, User_id, score and text, with score
and Price as DOUBLE, as ``sources.as_reviews`` gives them.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.functions.categories import category_list
from gridlore.operators.skew import DEFAULT, Limits, balanced_join
from gridlore.sources.shared import materialize


def clean_reviews(reviews: DataFrame, min_score: float = 4.0) -> DataFrame:
    """Reviews with a score of at least ``min_score`` and a non-empty text.

    A score that is not a number counts as missing.
    """
    return reviews.where(
        (F.col("score").try_cast("double") >= min_score)
        & F.col("text").isNotNull()
        & (F.length("text") > 0)
    )


def score_stats(reviews: DataFrame) -> DataFrame:
    """Number of reviews and text lengths for each score."""
    return (
        reviews.select("score", F.length("text").alias("text_length"))
        .groupBy("score")
        .agg(
            F.count("*").alias("num_reviews"),
            F.avg("text_length").alias("avg_length"),
            F.min("text_length").alias("min_length"),
            F.max("text_length").alias("max_length"),
        )
    )


def user_stats(reviews: DataFrame, min_reviews: int = 3) -> DataFrame:
    """Number of reviews, mean score and mean length for each active user.

    Reviews without a user form a group of their own.
    """
    return (
        reviews.select("User_id", "score", F.length("text").alias("text_length"))
        .groupBy("User_id")
        .agg(
            F.count("*").alias("num_reviews"),
            F.avg("score").alias("avg_score"),
            F.avg("text_length").alias("avg_length"),
        )
        .where(F.col("num_reviews") >= min_reviews)
    )


def explode_categories(books: DataFrame) -> DataFrame:
    """``(Title, Category)``, one row for each category of each book."""
    return books.select("Title", F.explode(category_list(F.col("categories"))).alias("Category"))


def _with_categories(rows: DataFrame, categories: DataFrame, limits: Limits) -> DataFrame:
    listed = materialize(categories.where(F.col("Title").isNotNull()), "categories")
    return balanced_join(
        rows.where(F.col("Title").isNotNull()), listed, ["Title"], limits=limits
    )


def reviews_by_category(
    reviews: DataFrame,
    categories: DataFrame,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Reviews with the categories of their title, one row for each.

    A title that is listed more than once gives its reviews more than once.
    """
    return _with_categories(reviews, categories, limits)


def user_category_stats(
    reviews: DataFrame,
    categories: DataFrame,
    min_reviews: int = 2,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """Number of reviews, mean score and mean price for each user and category.

    These are statistics over ``reviews_by_category``. A category that a title
    lists more than once is joined once and weighs as often as it is listed.
    """
    listed = categories.groupBy("Title", "Category").agg(F.count("*").alias("_times"))
    joined = _with_categories(
        reviews.select("User_id", "Title", "score", "Price"), listed, limits
    )

    def weighted_mean(name: str):
        weight = F.sum(F.when(F.col(name).isNotNull(), F.col("_times")))
        return F.sum(F.col(name) * F.col("_times")) / weight

    return (
        joined.groupBy("User_id", "Category")
        .agg(
            F.sum("_times").alias("num_reviews"),
            weighted_mean("score").alias("avg_score"),
            weighted_mean("Price").alias("avg_price"),
        )
        .where(F.col("num_reviews") >= min_reviews)
    )
