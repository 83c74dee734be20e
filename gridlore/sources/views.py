"""Temporary views, previews and row counts."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Make each DataFrame usable by name in ``spark.sql``."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def preview(df: DataFrame, order_by: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in the order of ``order_by``, which should be unique."""
    return df.orderBy(*order_by).limit(n)


# So many values split a range in each round, and so few are looked at one by one.
_PARTS = 64
_FEW = 10_000


def _cut(df: DataFrame, name: str, rank: int) -> tuple[object, int, int]:
    """The value of the row with this rank by one column, NULL first.

    With it the number of rows before that value, and of rows with it. Values
    that split the range are drawn by their hash, and rows between them are
    counted, until few different values are left; no row goes to another task.
    """
    value = F.col(name)
    nulls = df.where(value.isNull()).count()
    if rank <= nulls:
        return None, 0, nulls
    before, rest, drawn = nulls, df.select(name).where(value.isNotNull()), 0
    while True:
        different = rest.agg(F.approx_count_distinct(name)).first()[0]
        if different <= _FEW:
            break
        share = F.pmod(F.xxhash64(value, F.lit(drawn)), F.lit(max(different // _PARTS, 1)))
        found = rest.where(share == 0).distinct().orderBy(name).collect()
        drawn += 1
        if not found:
            continue
        bounds = [F.lit(row[0]).cast(df.schema[name].dataType) for row in found]
        upto = rest.agg(*[
            F.count_if(value <= bound).alias(f"n{i}") for i, bound in enumerate(bounds)
        ]).first()
        above = next((i for i, n in enumerate(upto) if before + n >= rank), len(bounds))
        if above < len(bounds):
            rest = rest.where(value <= bounds[above])
        if above > 0:
            rest = rest.where(value > bounds[above - 1])
            before += upto[above - 1]
    for found, n in rest.groupBy(name).count().orderBy(name).collect():
        if before + n >= rank:
            return found, before, n
        before += n
    raise RuntimeError(f"the rows changed while {name} was counted")


def sample_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """A fixed choice of ``n`` rows: those with the smallest values of ``key``.

    NULL is the smallest. Of rows with the same key those with the smallest hash
    of all columns are taken, so the choice does not depend on partitions. All
    rows are returned if there are no more than ``n``. The bound of the keys is
    found when this is called, by counting; the result is then a filter, in no
    order, however large ``n`` is. The input is read a few times, of which all
    but those for equal keys read only ``key``. Columns must not hold maps.
    """
    if n <= 0 or df.count() <= n:
        return df.limit(0) if n <= 0 else df
    hashes = {"_hash1": F.xxhash64(*df.columns), "_hash2": F.xxhash64(F.lit(1), *df.columns)}
    if dict(df.dtypes)[key] == "timestamp":
        # As a number, since a local time may name two moments.
        by = df.withColumn("_key", F.unix_micros(key))
    else:
        by = df.withColumn("_key", F.col(key))
    taken, level, rank = [], by, n
    for name in ("_key", "_hash1", "_hash2"):
        found, before, same = _cut(level, name, rank)
        rank -= before
        value, bound = F.col(name), F.lit(found).cast(level.schema[name].dataType)
        if rank == same:
            # Unless the bound is NULL, NULL is below it.
            upto = value.isNull() if found is None else value.isNull() | (value <= bound)
            taken.append(level.where(upto))
            break
        if found is not None:
            taken.append(level.where(value.isNull() | (value < bound)))
        level = level.where(value.isNull() if found is None else value == bound)
        if name == "_key":
            level = level.withColumns(hashes)
    else:
        # What is left are copies of one row; they are made from a single one.
        one = level.limit(1).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(rank))))
        taken.append(one.drop("_copy"))
    result = taken[0].select(df.columns)
    for rows in taken[1:]:
        result = result.unionByName(rows.select(df.columns))
    return result


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))
