"""Words of a text looked up where the text is, in a table that fits a broadcast.

The words go to Python in Arrow batches, as the list they are, and come back as
a list or as sums. No word becomes a row, and nothing is shuffled. The tables
have been measured before they are gathered: ``Limits`` bounds them.

The functions are marked as not deterministic, though they are, so that the
optimizer neither copies them into filters nor moves them below a shuffle.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.sources.shared import ship_library


def _held(table: DataFrame, key: str, values: list[str]):
    """A broadcast dictionary from ``key`` to a value, or to a row of a matrix."""
    context = ship_library(table.sparkSession).sparkContext
    rows = table.select(key, *values).where(F.col(key).isNotNull()).toArrow()
    keys = rows.column(0).to_pylist()
    if len(values) == 1 and not pa.types.is_integer(rows.column(1).type):
        return context.broadcast(dict(zip(keys, rows.column(1).to_pylist())))
    matrix = np.zeros((len(keys) + 1, len(values)), np.int64)
    for i in range(len(values)):
        matrix[:-1, i] = rows.column(i + 1).to_numpy()
    # Unknown words point to the last row, which is zero.
    return context.broadcast((dict(zip(keys, range(len(keys)))), matrix))


def _flat(lists: pa.Array) -> tuple[list, np.ndarray]:
    """All words of a column of lists, and where each list begins and ends; NULL is empty."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_pylist(), np.concatenate(([0], np.cumsum(sizes)))


def lemmas_of(words: Column, dictionary: DataFrame) -> Column:
    """Each word's ``lemma`` in ``(form, lemma)``, or the word itself."""
    held = _held(dictionary, "form", ["lemma"])

    @F.arrow_udf("array<string>")
    def lemmas(lists: pa.Array) -> pa.Array:
        found = held.value
        values, ends = _flat(lists)
        return pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array([found.get(x, x) for x in values], pa.string())
        )

    return lemmas.asNondeterministic()(words)


def not_in(words: Column, table: DataFrame, key: str, present: str) -> Column:
    """The words whose lower case is not a ``key`` of ``table``, as a list."""
    held = _held(table, key, [present])

    @F.arrow_udf("array<string>")
    def left(lists: pa.Array, lowered: pa.Array) -> pa.Array:
        dropped = held.value
        values, ends = _flat(lists)
        small, _ = _flat(lowered)
        stays = np.fromiter(
            (word is not None and low not in dropped for word, low in zip(values, small)),
            bool, len(values),
        )
        before = np.concatenate(([0], np.cumsum(stays)))
        kept = pa.array(values, pa.string()).filter(pa.array(stays))
        return pa.ListArray.from_arrays(pa.array(before[ends], pa.int32()), kept)

    # Spark's lower case, which differs from Python's for a few characters.
    return left.asNondeterministic()(words, F.transform(words, F.lower))


def tags_of(words: Column, tokens: DataFrame, suffixes: DataFrame, size: int, default: str) -> Column:
    """Each word's tag, else that of its last ``size`` characters, else ``default``."""
    own, ends_with = _held(tokens, "token", ["tag"]), _held(suffixes, "suffix", ["tag"])

    @F.arrow_udf("array<string>")
    def tags(lists: pa.Array) -> pa.Array:
        found, by_suffix = own.value, ends_with.value
        values, ends = _flat(lists)
        tagged = [found.get(x) or by_suffix.get(x[-size:], default) for x in values]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tagged, pa.string()))

    return tags.asNondeterministic()(words)


def sums_of(words: Column, table: DataFrame, key: str, values: list[str]) -> Column:
    """The sums of the whole numbers ``values`` over the words of a text, as a list."""
    held = _held(table, key, values)

    @F.arrow_udf("array<bigint>")
    def sums(lists: pa.Array) -> pa.Array:
        places, matrix = held.value
        words, ends = _flat(lists)
        unknown = len(matrix) - 1
        at = np.fromiter((places.get(x, unknown) for x in words), np.int64, len(words))
        totals = np.concatenate((np.zeros((1, matrix.shape[1]), np.int64), matrix[at].cumsum(axis=0)))
        each = totals[ends[1:]] - totals[ends[:-1]]
        cuts = np.arange(len(each) + 1) * matrix.shape[1]
        return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(each.reshape(-1)))

    return sums.asNondeterministic()(words)
