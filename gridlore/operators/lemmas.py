"""Lemmas: a dictionary from the texts themselves, and its use."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.operators.blocks import answered, block_words, in_blocks, meet, picked
from gridlore.operators.mapped import lemmas_of
from gridlore.operators.skew import DEFAULT, Limits, fits_broadcast

# Endings that are taken off to find the lemma of a form.
ENDINGS = ("s", "ed", "ing")


def build_lemma_dict(counts: DataFrame, endings: Sequence[str] = ENDINGS) -> DataFrame:
    """``(form, lemma)`` for each word that is another word plus an ending.

    ``counts`` has each ``word`` once. The first ending in the list that leaves
    a known word decides.
    """
    vocabulary = counts.select("word")
    stems = [
        F.when(
            F.col("form").endswith(ending) & (F.length("form") > len(ending)),
            F.struct(
                F.lit(rank).alias("rank"),
                F.left("form", F.length("form") - len(ending)).alias("lemma"),
            ),
        )
        for rank, ending in enumerate(endings)
    ]
    candidates = (
        vocabulary.withColumnRenamed("word", "form")
        .withColumn("stem", F.explode(F.array_compact(F.array(*stems))))
        .select("form", "stem.rank", "stem.lemma")
    )
    found = candidates.join(vocabulary.withColumnRenamed("word", "lemma"), "lemma", "left_semi")
    return found.groupBy("form").agg(F.min_by("lemma", "rank").alias("lemma"))


def lemmatize(
    docs: DataFrame,
    dictionary: DataFrame,
    keep: Sequence[str],
    words: Column,
    out: str = "result",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``(*keep, out)`` with the lemma of each word, or the word itself.

    One row for each text. ``dictionary`` should be a written table. If it fits
    a broadcast, the words stay in their rows; otherwise the texts are written when
    this is called, and the different words of a block of them are joined to it.
    """
    if fits_broadcast(dictionary, limits):
        return docs.select(*keep, lemmas_of(words, dictionary).alias(out))
    forms = dictionary.select(F.col("form").alias("token"), "lemma")
    blocks = in_blocks(docs, keep, [words])
    found = meet(block_words(blocks), forms, ["token"])
    lemma = F.coalesce("lemma", "token").alias("lemma")
    return answered(
        blocks, found.select("_block", "_kind", "_code", lemma), keep, {out: "array<string>"},
        lambda codes, tables: [picked(codes[0], tables[0], "lemma")],
    )


def lemma_count(counts: DataFrame, dictionary: DataFrame, min_length: int = 3) -> DataFrame:
    """How often each lemma of at least ``min_length`` characters occurs.

    ``counts`` is ``(word, count)``. As the words are already counted, the
    dictionary meets each distinct word once.
    """
    lemmas = counts.withColumnRenamed("word", "form").join(dictionary, "form", "left")
    return (
        lemmas.select(F.coalesce("lemma", "form").alias("word"), "count")
        .where(F.length("word") >= min_length)
        .groupBy("word")
        .agg(F.sum("count").alias("count"))
    )


def top_words(counts: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` most frequent words, equal counts in order of the word."""
    return counts.orderBy(F.desc("count"), F.asc("word")).limit(k)
