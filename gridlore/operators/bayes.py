"""Multinomial naive Bayes, trained and applied with group-bys and one join.

The logarithms are scaled to whole numbers, so that a score is an integer sum
and does not depend on the order in which tasks add it up.
"""
from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.operators.blocks import answered, block_words, in_blocks, meet, sums
from gridlore.operators.mapped import sums_of
from gridlore.operators.skew import DEFAULT, Limits, fits_broadcast, lookup
from gridlore.operators.stored import facts_of, load_tables, save_model
from gridlore.operators.tokens import copies, group_columns, repeat_many, token_rows
from gridlore.sources.shared import materialize

SCALE = 1_000_000


@dataclass(frozen=True)
class NaiveBayes:
    """Labels in order, their prior weights, and one weight per word and label.

    ``weights`` has the columns ``w`` and ``weight_0``, ``weight_1``, ... in
    the order of ``labels``.
    """

    KIND: ClassVar[str] = "naive_bayes"

    labels: tuple[str, ...]
    priors: tuple[int, ...]
    weights: DataFrame

    def table(self) -> DataFrame:
        """The weights as ``(w, label, weight)``."""
        pairs = [
            F.struct(F.lit(label).alias("label"), F.col(f"weight_{i}").alias("weight"))
            for i, label in enumerate(self.labels)
        ]
        return self.weights.select("w", F.inline(F.array(*pairs)))

    def save(self, path: str) -> None:
        """Write the model to a new folder."""
        facts = {"labels": list(self.labels), "priors": list(self.priors)}
        save_model(self.weights.sparkSession, path, self.KIND, facts, {"weights": self.weights})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> NaiveBayes:
        facts = facts_of(spark, path, cls.KIND)
        (weights,) = load_tables(spark, path, "weights")
        return cls(tuple(facts["labels"]), tuple(facts["priors"]), weights)


def train_nb(
    docs: DataFrame, label: str, words: Column, max_labels: int = 1000
) -> NaiveBayes:
    """Train on texts with a label; ``words`` is the array of features.

    Texts without a label are left out. Weights are add-one smoothed. Each label
    is a column of the model, so their number is bounded: more than
    ``max_labels`` are refused.
    """
    known = docs.where(F.col(label).isNotNull())
    shares = known.groupBy(label).count().orderBy(label).limit(max_labels + 1).collect()
    if not shares:
        raise ValueError("no labelled texts to train on")
    if len(shares) > max_labels:
        raise ValueError(f"more than {max_labels} labels in {label}")
    labels = tuple(row[0] for row in shares)
    texts = sum(row[1] for row in shares)
    priors = tuple(round(math.log(row[1] / texts) * SCALE) for row in shares)

    counts = materialize(
        known.select(F.col(label).alias("_label"), F.explode(words).alias("w"))
        .groupBy("w")
        .agg(*[F.count_if(F.col("_label") == name).alias(f"n_{i}") for i, name in enumerate(labels)]),
        "words",
    )
    sums = [F.coalesce(F.sum(f"n_{i}"), F.lit(0)) for i in range(len(labels))]
    *totals, vocabulary = counts.agg(*sums, F.count("*")).first()
    weights = counts.select(
        "w",
        *[
            F.round(F.log((F.col(f"n_{i}") + 1) / F.lit(total + vocabulary)) * SCALE)
            .cast("bigint")
            .alias(f"weight_{i}")
            for i, total in enumerate(totals)
        ],
    )
    return NaiveBayes(labels, priors, weights)


def score_columns(words: Column, model: NaiveBayes) -> Column:
    """The scores of all labels as a list, with a model that fits a broadcast."""
    names = [f"weight_{i}" for i in range(len(model.labels))]
    totals = sums_of(words, model.weights, "w", names)
    priors = F.array(*[F.lit(prior).cast("bigint") for prior in model.priors])
    return F.zip_with(totals, priors, lambda a, b: a + b)


def label_of(scores: Column, model: NaiveBayes) -> Column:
    """The label with the best of ``scores``, the first of equal ones."""
    names = F.array(*[F.lit(label) for label in model.labels])
    return F.get(names, (F.array_position(scores, F.array_max(scores)) - 1).cast("int"))


def weight_lists(model: NaiveBayes) -> DataFrame:
    """``(token, _weights)``, the weights of a word as a list."""
    weights = F.array(*[f"weight_{i}" for i in range(len(model.labels))])
    return model.weights.select(F.col("w").alias("token"), weights.alias("_weights"))


def with_priors(sums: str, model: NaiveBayes) -> Column:
    """The scores of all labels from the list of their words' sums."""
    priors = F.array(*[F.lit(prior).cast("bigint") for prior in model.priors])
    return F.zip_with(sums, priors, lambda a, b: a + b)


def _predict_blocks(
    docs: DataFrame,
    model: NaiveBayes,
    keep: Sequence[str],
    words: Column,
    out: str,
    scores: bool,
    copies_as: str | None,
) -> DataFrame:
    """``predict_nb`` with a model too large to hold."""
    blocks, labels = in_blocks(docs, keep, [words]), len(model.labels)
    found = meet(block_words(blocks), weight_lists(model), ["token"])
    found = found.select("_block", "_kind", "_code", "_weights")
    summed = answered(
        blocks, found, keep, {"_sums": "array<bigint>"},
        lambda codes, tables: [sums(codes[0], tables[0], "_weights", labels)],
    )
    judged = summed.withColumn("_sums", with_priors("_sums", model))
    best = [F.array_max("_sums").alias("best_score")] if scores else []
    one = [F.lit(1).cast("bigint").alias(copies_as)] if copies_as is not None else []
    return judged.select(*keep, label_of(F.col("_sums"), model).alias(out), *best, *one)


def predict_nb(
    docs: DataFrame,
    model: NaiveBayes,
    keep: Sequence[str],
    words: Column,
    out: str = "label",
    scores: bool = False,
    copies_as: str | None = None,
    by: Sequence[str] | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``(*keep, out)`` with the likeliest label of each text.

    Words that were not seen in training do not count, a text without known
    words gets the commonest label, and equal scores go to the first label.
    ``scores`` adds the winning score. There is one row for each text; with
    ``copies_as`` texts that are copies may share one row, their number in the
    column of that name. ``by`` is explained at ``group_columns``; with it,
    those columns are kept and no others. With a model too large for a
    broadcast the texts are written when this is called.
    """
    if not fits_broadcast(model.weights, limits):
        return _predict_blocks(
            docs, model, list(keep if by is None else by), words, out, scores, copies_as
        )
    if by is not None:
        keep = []
    rows = token_rows(docs, keep, words, by)
    weighed = lookup(rows, model.weights.withColumnRenamed("w", "token"), ["token"], limits)
    names = [f"_score_{i}" for i in range(len(model.labels))]
    summed = weighed.groupBy(*group_columns(keep, by)).agg(
        copies().alias("_copies"),
        *[F.coalesce(F.sum(f"weight_{i}"), F.lit(0)).alias(name) for i, name in enumerate(names)],
    )
    # Copies add up to a multiple of the score of one text.
    keep = keep if by is None else by
    scored = summed.select(
        *keep,
        "_copies",
        *[
            (F.expr(f"{name} div _copies") + F.lit(prior)).alias(name)
            for prior, name in zip(model.priors, names)
        ],
    )
    best = F.greatest(*names) if len(names) > 1 else F.col(names[0])
    winner = F.coalesce(
        *[F.when(F.col(name) == best, F.lit(label)) for name, label in zip(names, model.labels)]
    )
    kept = [best.alias("best_score")] if scores else []
    labelled = scored.select(*keep, winner.alias(out), *kept, "_copies")
    if copies_as is not None:
        return labelled.withColumnRenamed("_copies", copies_as)
    return repeat_many(labelled, "_copies")
