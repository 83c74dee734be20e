"""The input tables of the library, derived from the test tables.

The same definitions stand in ``oracle.py`` as SQL.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.functions import tokenize
from gridlore.sources import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, ready for work on their texts."""
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "conversations"), "conv_id", "turn")


def people_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"),
        (F.col("c_acctbal") / 20.0 - 200.0).alias("x"),
        ((key * 7919) % 400 - 200).cast("double").alias("y"),
        F.when(key % 10 == 0, "David").otherwise(F.col("c_name")).alias("f3"),
        F.col("c_nationkey").cast("double").alias("f4"),
        F.col("c_mktsegment").alias("f5"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "yes").otherwise("no").alias("status"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people_status(spark, sf_dir).drop("status")


def connected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return people_status(spark, sf_dir).where(F.col("status") == "yes").select("id", "x", "y")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_reviews(table(spark, sf_dir, "documents"))


def review_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews, ready for work on their texts."""
    return _as_reviews(documents(spark, sf_dir))


def _as_reviews(documents: DataFrame) -> DataFrame:
    key = F.col("doc_id")
    return documents.select(
        key.alias("Id"),
        F.when(key % 50 != 7, F.col("source")).alias("Title"),
        F.when(key % 3 != 0, (F.col("n_chars") % 5000).cast("double") / 100.0).alias("Price"),
        F.when(key % 40 != 3, F.concat(F.lit("u"), ((key * 7919) % 400).cast("string"))).alias(
            "User_id"
        ),
        (key % 5 + 1).cast("double").alias("score"),
        F.when(key % 97 == 5, "").when(key % 97 != 6, F.col("text")).alias("text"),
        F.col("lang"),
    )


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("doc_id")
    names = F.concat(
        F.lit("['"), F.col("lang"), F.lit("', 'O'Cat "), (key % 4).cast("string"), F.lit("']")
    )
    categories = F.when(key % 200 == 1, "[]").when(key % 200 != 0, names)
    return (
        table(spark, sf_dir, "documents")
        .select(F.col("source").alias("Title"), categories.alias("categories"))
        .distinct()
    )


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("quality") == 1, "positive").otherwise("negative")
    labels = table(spark, sf_dir, "labels").select("doc_id", label.alias("label"))
    return documents(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id")


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        F.explode(tokenize(F.col("text"))).alias("token"), F.col("lang").alias("tag")
    )
