"""Joins that stay balanced when a few keys hold much of the data."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.sources.shared import materialize


@dataclass(frozen=True)
class Limits:
    """When to split keys and when to broadcast.

    The work of a key is the rows that a join reads of it on both sides and the
    pairs that these make. A key is hot if it causes more than one part in
    ``parts`` of all work, and more than ``min_rows`` rows and pairs. So there
    are fewer than ``parts`` hot keys whatever the size of the data, and the
    list of them can always be broadcast. Another table is broadcast if it has
    been measured to have no more than ``max_rows`` rows and ``max_bytes`` bytes.
    """

    parts: int = 1024
    min_rows: int = 1_000_000
    max_rows: int = 1_000_000
    max_bytes: int = 64 * 1024 * 1024


DEFAULT = Limits()


def _no_nulls(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def hot_keys(
    left: DataFrame,
    right: DataFrame | None,
    keys: Sequence[str],
    limits: Limits = DEFAULT,
    cut_right: bool = False,
) -> DataFrame:
    """The hot keys, and into how many ``left_slices`` and ``right_slices`` to cut each.

    A slice of the left side meets a slice of the right side in one task, whose
    work is about one part of all, so there are fewer than ``2 * limits.parts``
    such tasks. With ``cut_right`` both sides are cut in the ratio of their rows,
    which repeats the fewest; otherwise only the left one. Both sides are counted
    in one pass, the right one not if it is None, for a side with few rows a key.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    sides = left.select(*keys, one.alias("_left"), none.alias("_right"))
    if right is not None:
        sides = sides.unionAll(right.select(*keys, none, one))
    counts = (
        sides.where(_no_nulls(keys))
        .groupBy(*keys)
        # As doubles, since the product of two counts may exceed a whole number.
        .agg(F.sum("_left").cast("double").alias("_left"), F.sum("_right").cast("double").alias("_right"))
        .withColumn("_work", F.col("_left") * F.col("_right") + F.col("_left") + F.col("_right"))
    )
    total = counts.agg(F.coalesce(F.sum("_work"), F.lit(0.0))).scalar()
    task = F.greatest(total / F.lit(limits.parts), F.lit(float(limits.min_rows)))
    large = counts.where(F.col("_work") > task).withColumn("_tasks", F.ceil(F.col("_work") / task))
    at_least_one = [F.greatest(F.col(side), F.lit(1.0)) for side in ("_left", "_right")]
    if cut_right:
        wanted = F.round(F.sqrt(F.col("_tasks") * F.col("_left") / at_least_one[1]))
        left_slices = F.least(F.greatest(wanted, F.lit(1.0)), F.col("_tasks"), at_least_one[0])
    else:
        left_slices = F.least(F.col("_tasks"), at_least_one[0])
    large = large.withColumn("left_slices", left_slices.cast("bigint"))
    rest = F.least(F.ceil(F.col("_tasks") / F.col("left_slices")), at_least_one[1])
    right_slices = rest.cast("bigint") if cut_right else one
    return large.select(*keys, "left_slices", right_slices.alias("right_slices"))


def _row_slice(columns: Sequence[str], slices: Column) -> Column:
    # The partition number spreads copies of one row. Unlike a random number
    # it gives every row the same slice again when a task is repeated.
    return F.pmod(F.xxhash64(*columns, F.spark_partition_id()), slices)


def _every_slice(slices: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), slices - 1))


def _join(left, right, matched, keys, how, condition, hint: str | None = None) -> DataFrame:
    renamed = {name: f"_other_{name}" for name in matched}
    right = right.withColumnsRenamed(renamed)
    if hint:
        right = right.hint(hint)
    on = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in renamed.items()])
    if condition is not None:
        on = on & condition
    salts = [name for name in matched if name not in keys]
    return left.join(right, on, how).drop(*salts, *renamed.values())


def salted_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    limits: Limits = DEFAULT,
    repeats: bool = False,
    hint: str | None = None,
    single: bool = False,
) -> DataFrame:
    """Equi-join on ``keys``, hot keys split over many tasks.

    The left rows of a hot key are cut into slices, and its right rows go to
    each slice. In an inner join the right side is cut as well, and in a
    semi join if the caller can do with ``repeats``: a left row then comes once
    for each slice that has a match. In a left join, rows without a key are
    spread out. ``hint`` is one for the right side, such as ``merge``;
    ``single`` says that the right side has one row for each key. The other
    column names of the two sides must differ, and the result has the keys once.
    ``how`` is ``inner``, ``left`` or ``left_semi``.

    The work of each key is counted when this is called. Without hot keys the
    result is an ordinary join.
    """
    if how not in ("inner", "left", "left_semi"):
        raise ValueError(f"unsupported join: {how}")
    matched = list(keys)
    left_columns, right_columns = left.columns, right.columns
    one = F.lit(1).cast("bigint")

    cut_right = (how == "inner" or how == "left_semi" and repeats) and not single
    hot = hot_keys(left, None if single else right, keys, limits, cut_right)
    hot = materialize(hot, "hot")
    hot = None if hot.isEmpty() else F.broadcast(hot)
    if hot is not None:
        left, right = left.join(hot, list(keys), "left"), right.join(hot, list(keys), "left")
    if hot is not None or how == "left":
        slices = one if hot is None else F.coalesce("left_slices", one)
        # A NULL key joins nothing, so its rows may go anywhere.
        cuts = F.when(_no_nulls(keys), slices).otherwise(F.lit(limits.parts).cast("bigint"))
        left = left.withColumn("_salt_left", _row_slice(left_columns, cuts))
        right = right.withColumn("_salt_left", _every_slice(slices))
        matched.append("_salt_left")
    if hot is not None and cut_right:
        slices = F.coalesce("right_slices", one)
        left = left.withColumn("_salt_right", _every_slice(slices))
        right = right.withColumn("_salt_right", _row_slice(right_columns, slices))
        matched.append("_salt_right")
    left, right = (side.drop("left_slices", "right_slices") for side in (left, right))
    return _join(left, right, matched, keys, how, condition, hint)


def _width(name: str, kind: str) -> Column | None:
    """The bytes of a value, for a kind that has no fixed width."""
    if kind in ("string", "binary"):
        return F.octet_length(name)
    if kind.startswith(("array", "map", "struct", "variant")):
        return F.octet_length(F.to_json(F.struct(name)))
    return None


def fits_broadcast(table: DataFrame, limits: Limits = DEFAULT) -> bool:
    """Measure a table: is it small enough for every executor to hold?"""
    widths = [_width(name, kind) for name, kind in table.dtypes]
    fixed = F.lit(8 * (len(table.columns) + 1))
    width = sum((F.coalesce(x, F.lit(0)) for x in widths if x is not None), fixed)
    rows, size = table.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= limits.max_rows and size <= limits.max_bytes


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    condition: Column | None = None,
    limits: Limits = DEFAULT,
    at_most: DataFrame | None = None,
    repeats: bool = False,
    single: bool = False,
) -> DataFrame:
    """``salted_join``, or a broadcast join if the right side is small.

    The right side is measured, or ``at_most``, a table that is no smaller and
    easier to compute. With a broadcast the left side is not looked at
    beforehand and stays where it is. A side that has been measured to be too
    large is not left to the planner's guess of its size.
    """
    if fits_broadcast(right if at_most is None else at_most, limits):
        return _join(left, right, list(keys), keys, how, condition, "broadcast")
    return salted_join(left, right, keys, how, condition, limits, repeats, "merge", single)


def lookup(
    facts: DataFrame, table: DataFrame, keys: Sequence[str], limits: Limits = DEFAULT
) -> DataFrame:
    """Left join of many rows to a written table that has one row per key."""
    return balanced_join(facts, table, keys, "left", limits=limits, single=True)
