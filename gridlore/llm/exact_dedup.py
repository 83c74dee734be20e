"""Exact copies of texts, combined in steps that withstand large groups, with column functions only.

Texts are equal if they are the same after each run of white space has become
one blank. Each task first combines the copies that it reads. What is left goes
to groups by digest and salt, the salt being the task's, so that a text with
many copies is combined in many places. The winners of the salts are combined at
last. Every step groups by the digest and the whole text, so a digest shared by
different texts joins nothing.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.operators.skew import lookup
from gridlore.sources.shared import materialize, settled

# Single blanks are left alone, as they would only be replaced by themselves.
_BLANKS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """The text with one blank for each run of white space; a NULL text is an empty one."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _BLANKS, " ")


def _digest(body: Column) -> Column:
    return F.unhex(F.sha2(body, 256))


def _combined(bodies: DataFrame, salts: int) -> DataFrame:
    """``(key, body, keep_id, group_size)`` of each different text of ``(doc_id, key, body)``."""
    salted = bodies.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    # The first half of this aggregation runs in the task that reads the rows.
    winners = salted.groupBy("key", "salt", "body").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    return winners.groupBy("key", "body").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )


def exact_copies(
    docs: DataFrame,
    salts: int = 64,
    digest_bytes: int = 32,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row for each row of ``docs``.

    Of equal texts the row with the least id stays; ``keep_id`` is that id. Of
    several rows of a group with the least id, repeated ones for example, one
    stays. Ids of NULL come after all others: ``keep_id`` is NULL if a group has
    no other, and one of its rows stays. A NULL text counts as an empty one.
    Other columns are ignored; an empty table gives an empty result. Texts meet
    by the first ``digest_bytes`` of their digest and are compared in full.
    """

    def assigned() -> DataFrame:
        bodies = docs.select(F.col(id).alias("doc_id"), normalised(F.col(text)).alias("body"))
        bodies = bodies.select("doc_id", "body", _digest(F.col("body")).alias("digest"))
        key = F.substring("digest", 1, digest_bytes).alias("key")
        marks = materialize(bodies.select("doc_id", "digest", key), "marks")
        combined = _combined(bodies.select("doc_id", "body", key), salts)
        groups = materialize(combined.drop("body"), "groups")
        shared = groups.groupBy("key").agg(F.count("*").alias("_texts")).where("_texts > 1")
        shared = materialize(shared.select("key", F.lit(True).alias("_shared")), "shared")
        several = groups.where("group_size > 1").withColumn("group", F.monotonically_increasing_id())
        found = lookup(marks, materialize(several, "several"), ["key"])
        if not shared.isEmpty():
            # Different texts with one key: these rows take their texts along.
            alone = lookup(found, shared, ["key"]).where("_shared IS NULL").drop("_shared")
            mixed = lookup(bodies.select("*", key), shared, ["key"]).where("_shared").drop("_shared")
            texts = lookup(combined, shared, ["key"]).where("_shared").drop("_shared")
            texts = texts.withColumn("group", -1 - F.monotonically_increasing_id())
            mixed = lookup(mixed, materialize(texts, "texts"), ["key", "body"])
            found = alone.unionByName(mixed.drop("body"))
        return found.select(
            "doc_id", "digest", "group",
            F.when(F.col("group").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
            F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
            F.monotonically_increasing_id().alias("mark"),
        )

    rows = settled(docs.sparkSession, assigned, "copies")
    least = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    ties = rows.where(F.col("group").isNotNull() & least).groupBy("group").agg(
        F.count("*").alias("_n"), F.min("mark").alias("_first")
    )
    ties = materialize(ties.where("_n > 1").drop("_n"), "ties")
    kept = least
    if not ties.isEmpty():
        rows = lookup(rows, ties, ["group"])
        kept = least & (F.col("_first").isNull() | (F.col("mark") == F.col("_first")))
    return rows.select(
        "doc_id", "keep_id", "group_size", kept.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, salts: int = 64, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, the one with the least id.

    All columns stay. NULLs, repeated rows and empty tables are treated as
    ``exact_copies`` does.
    """
    found = exact_copies(docs, salts, id=id, text=text).where("kept")
    kept = materialize(found.select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_sha")), "kept")
    rows = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.col(id).alias("_id"),
        F.sha2(normalised(F.col(text)), 256).alias("_own"),
    )
    on = F.col("_id").eqNullSafe(F.col("_kept_id")) & (F.col("_own") == F.col("_sha"))
    rows = rows.join(kept, on, "left_semi")
    # Rows of one id and text are dealt by both, so a group is no larger than its repeated rows.
    return rows.dropDuplicates(["_id", "_own"]).select("_doc.*")
