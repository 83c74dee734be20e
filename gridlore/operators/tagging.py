"""A most-frequent-tag tagger with suffix back-off."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.operators.blocks import answered, block_words, in_blocks, meet, picked
from gridlore.operators.mapped import tags_of
from gridlore.operators.skew import DEFAULT, Limits, fits_broadcast, lookup
from gridlore.operators.stored import facts_of, load_tables, save_model
from gridlore.sources.shared import materialize

SUFFIX = 3


@dataclass(frozen=True)
class Tagger:
    """Written tables ``(token, tag)`` and ``(suffix, tag)``, and one tag for
    everything else."""

    KIND: ClassVar[str] = "tagger"

    tokens: DataFrame
    suffixes: DataFrame
    default: str

    def table(self) -> DataFrame:
        """Everything the tagger knows, as ``(kind, key, tag)``."""
        spark = self.tokens.sparkSession
        rest = spark.range(1).select(
            F.lit("default").alias("kind"), F.lit("").alias("key"), F.lit(self.default).alias("tag")
        )
        return (
            self.tokens.select(F.lit("token").alias("kind"), F.col("token").alias("key"), "tag")
            .unionByName(
                self.suffixes.select(
                    F.lit("suffix").alias("kind"), F.col("suffix").alias("key"), "tag"
                )
            )
            .unionByName(rest)
        )

    def save(self, path: str) -> None:
        """Write the tagger to a new folder."""
        tables = {"tokens": self.tokens, "suffixes": self.suffixes}
        save_model(self.tokens.sparkSession, path, self.KIND, {"default": self.default}, tables)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Tagger:
        facts = facts_of(spark, path, cls.KIND)
        return cls(*load_tables(spark, path, "tokens", "suffixes"), facts["default"])


def _commonest(counts: DataFrame, key: str) -> DataFrame:
    # The smallest of (-n, tag) is the most frequent tag, then the first by name.
    return counts.groupBy(key).agg(F.min(F.struct(-F.col("n"), "tag"))["tag"].alias("tag"))


def train_tagger(tagged: DataFrame) -> Tagger:
    """Train on rows ``(token, tag)``."""
    counts = materialize(
        tagged.where(F.col("token").isNotNull() & F.col("tag").isNotNull())
        .groupBy("token", "tag")
        .agg(F.count("*").alias("n")),
        "tags",
    )
    by_suffix = (
        counts.groupBy(F.right("token", F.lit(SUFFIX)).alias("suffix"), "tag")
        .agg(F.sum("n").alias("n"))
    )
    default = (
        counts.groupBy("tag").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "tag").first()
    )
    if default is None:
        raise ValueError("no tagged tokens to train on")
    return Tagger(
        materialize(_commonest(counts, "token"), "token-tags"),
        materialize(_commonest(by_suffix, "suffix"), "suffix-tags"),
        default["tag"],
    )


def fits_tagger(tagger: Tagger, limits: Limits = DEFAULT) -> bool:
    return fits_broadcast(tagger.tokens, limits) and fits_broadcast(tagger.suffixes, limits)


def tag_column(words: Column, tagger: Tagger) -> Column:
    """The tags of a list of words, with a tagger that fits a broadcast."""
    return tags_of(words, tagger.tokens, tagger.suffixes, SUFFIX, tagger.default)


def suffixed(rows: DataFrame, tagger: Tagger, limits: Limits, wanted: Column | None = None) -> DataFrame:
    """Rows ``token, tag`` with ``_tag``, for a NULL one that of the suffix or the commonest."""
    # Only a word without a tag needs its suffix.
    untagged = F.col("tag").isNull() if wanted is None else F.col("tag").isNull() & wanted
    suffix = F.when(untagged, F.right("token", F.lit(SUFFIX)))
    found = lookup(
        rows.withColumn("suffix", suffix),
        tagger.suffixes.withColumnRenamed("tag", "_suffix_tag"),
        ["suffix"],
        limits,
    )
    return found.withColumn("_tag", F.coalesce("tag", "_suffix_tag", F.lit(tagger.default)))


def tag_tokens(
    docs: DataFrame,
    tagger: Tagger,
    keep: Sequence[str],
    words: Column,
    out: str = "pos_tags",
    copies_as: str | None = None,
    by: Sequence[str] | None = None,
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``(*keep, out)`` with one tag for each word.

    The tag is that of the word, else of its last three characters, else the
    commonest of all. There is one row for each text; with ``copies_as`` texts
    that are copies may share one row, their number in the column of that name.
    ``by`` is explained at ``group_columns``. With a tagger too large for a
    broadcast the texts are written when this is called.
    """
    if fits_tagger(tagger, limits):
        one = [F.lit(1).cast("bigint").alias(copies_as)] if copies_as is not None else []
        tags = tag_column(words, tagger).alias(out)
        return docs.select(*keep, *(by or []), tags, *one)
    kept = [*keep, *(by or [])]
    blocks = in_blocks(docs, kept, [words])
    found = suffixed(meet(block_words(blocks), tagger.tokens, ["token"]), tagger, limits)
    tagged = answered(
        blocks, found.select("_block", "_kind", "_code", "_tag"), kept, {out: "array<string>"},
        lambda codes, tables: [picked(codes[0], tables[0], "_tag")],
    )
    return tagged if copies_as is None else tagged.withColumn(copies_as, F.lit(1).cast("bigint"))
