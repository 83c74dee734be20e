"""Words of many texts as rows: counting, and results per text from rows.

Texts need no key of their own. Rows that agree in the kept columns and in all
their words are copies with the same result, so they are worked on as one
group, which carries their number and is repeated at the end.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.operators.blocks import answered, block_words, in_blocks, meet, picked_known
from gridlore.operators.mapped import not_in
from gridlore.operators.skew import DEFAULT, Limits, fits_broadcast
from gridlore.sources.shared import materialize

# 128 bits that stand for all words of a text, and a part of the input. Copies
# in different parts stay apart, so that no single task repeats all of them.
SAME_WORDS = ["_same1", "_same2", "_part"]
PARTS = 1024
# More copies of one row than this are shared out among tasks.
CHUNK = 1_000_000


def word_count(docs: DataFrame, words: Column, min_length: int = 3) -> DataFrame:
    """How often each word of at least ``min_length`` characters occurs."""
    return (
        docs.select(F.explode(words).alias("word"))
        .where(F.length("word") >= min_length)
        .groupBy("word")
        .agg(F.count("*").alias("count"))
    )


def same_text(value: Column) -> list[Column]:
    """128 bits of a text, list of words or row, as two numbers."""
    return [F.xxhash64(value), F.xxhash64(F.lit(1), value)]


def token_rows(
    docs: DataFrame, keep: Sequence[str], words: Column, by: Sequence[str] | None = None
) -> DataFrame:
    """``(*keep, pos, token)`` and the columns of ``group_columns``.

    One row for each word. A text without words gives one row without position
    and token.
    """
    listed = docs.select(*keep, *(by or []), words.alias("_words"))
    if by is None:
        part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
        marks = [*same_text(F.col("_words")), part]
        marks = [mark.alias(name) for mark, name in zip(marks, SAME_WORDS)]
        listed = listed.select("*", *marks)
    return listed.select(
        *keep, *(by or SAME_WORDS), F.posexplode_outer("_words").alias("pos", "token")
    )


def group_columns(keep: Sequence[str], by: Sequence[str] | None) -> list[str]:
    """The columns that tell texts apart.

    Those in ``by``, if a caller has columns that determine the kept columns
    and the words; otherwise the kept columns and a mark of all words.
    """
    return list(by) if by is not None else [*keep, *SAME_WORDS]


def copies() -> Column:
    """Aggregate: the number of texts that a group of token rows comes from."""
    return F.count_if(F.coalesce("pos", F.lit(0)) == 0)


def repeat_copies(groups: DataFrame, number: str) -> DataFrame:
    """Each row as many times as its column ``number`` says."""
    times = F.sequence(F.lit(1).cast("bigint"), F.col(number))
    return groups.withColumn("_copy", F.explode(times)).drop("_copy", number)


def repeat_many(groups: DataFrame, number: str, chunk: int = CHUNK) -> DataFrame:
    """``repeat_copies`` where one row may have very many copies."""
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(number) - 1) / chunk))
    left_over = F.col(number) - F.col("_chunk") * chunk
    shared = (
        groups.where(F.col(number) > chunk)
        .withColumn("_chunk", F.explode(chunks))
        .withColumn(number, F.least(left_over, F.lit(chunk).cast("bigint")))
        .repartition(*groups.columns, "_chunk")
        .drop("_chunk")
    )
    few = groups.where(F.col(number) <= chunk)
    return repeat_copies(few.unionByName(shared), number)


def drop_words(
    docs: DataFrame,
    keep: Sequence[str],
    words: Column,
    dropped: DataFrame,
    out: str = "words",
    limits: Limits = DEFAULT,
) -> DataFrame:
    """``(*keep, out)``: the words of each text that are not in a table.

    ``dropped`` has the column ``word``; case does not matter. A text of which
    no word is left has an empty list. The table is written once; if it then fits
    a broadcast, the words stay in their rows, otherwise the texts are written, too,
    and the different words of a block of them are joined to it.
    """
    table = dropped.select(F.lower("word").alias("_lower")).where("_lower IS NOT NULL").distinct()
    table = materialize(table.withColumn("_dropped", F.lit(True)), "dropped")
    if fits_broadcast(table, limits):
        return docs.select(*keep, not_in(words, table, "_lower", "_dropped").alias(out))
    blocks = in_blocks(docs, keep, [words])
    found = meet(block_words(blocks).withColumn("_lower", F.lower("token")), table, ["_lower"])
    left = F.when(F.col("_dropped").isNull(), F.col("token")).alias("_left")
    return answered(
        blocks, found.select("_block", "_kind", "_code", left), keep, {out: "array<string>"},
        lambda codes, tables: [picked_known(codes[0], tables[0], "_left")],
    )
