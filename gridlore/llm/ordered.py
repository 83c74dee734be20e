"""Running totals and neighbours in a global order, however large a group is.

Rows are dealt to tasks by ranges of the order, so a group that is too large for
one task is cut. What a slice needs of the slices before it is one row for each
group and slice.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlore.sources.shared import materialize

_BLOCK = 16  # bits of a position inside a block


def sliced(rows: DataFrame, order: Sequence[str], name: str = "slices") -> DataFrame:
    """``rows`` written in the order of ``order``, with the number of their ``slice``; slices follow the order."""
    sorted_rows = rows.repartitionByRange(*[F.col(x).asc_nulls_first() for x in order])
    return materialize(sorted_rows.withColumn("slice", F.spark_partition_id()), name)


def running(
    rows: DataFrame, by: Sequence[str], order: Sequence[str], totals: dict[str, tuple]
) -> DataFrame:
    """Running totals of ``{name: (aggregate, value)}`` within groups ``by`` of rows of ``sliced``.

    ``aggregate`` is a function of columns like ``F.sum`` that totals of parts
    can be put together with. ``order`` tells the rows of a group apart.
    """
    here = Window.partitionBy("slice", *by).orderBy(*[F.col(x).asc_nulls_first() for x in order])
    here = here.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[f(value).over(here).alias(f"_here_{x}") for x, (f, value) in totals.items()])
    parts = rows.groupBy(*by, "slice").agg(
        *[f(value).alias(f"_part_{x}") for x, (f, value) in totals.items()]
    )
    # Only of groups that were cut; their rows are as many as there are slices.
    all_of = Window.partitionBy(*by)
    before = all_of.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_cuts", F.count("*").over(all_of)).where("_cuts > 1").select(
        *[F.col(x).alias(f"_of_{x}") for x in by], F.col("slice").alias("_of_slice"),
        *[f(F.col(f"_part_{x}")).over(before).alias(f"_before_{x}") for x, (f, _) in totals.items()],
    )
    # A slice has at most two cut groups: the ones at its ends.
    on = F.col("slice") == F.col("_of_slice")
    for x in by:
        on = on & F.col(x).eqNullSafe(F.col(f"_of_{x}"))
    joined = rows.join(parts, on, "left")
    own = [c for c in rows.columns if not c.startswith("_here_")]
    return joined.select(
        *own,
        *[
            F.when(F.col(f"_before_{x}").isNull(), F.col(f"_here_{x}"))
            .otherwise(_two(f, F.col(f"_before_{x}"), F.col(f"_here_{x}"))).alias(x)
            for x, (f, _) in totals.items()
        ],
    )


def _two(aggregate, a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b) if aggregate is F.bit_xor else a + b


def prefix_sums(rows: DataFrame, position: str, values: Sequence[str]) -> DataFrame:
    """``rows`` with ``sum_<value>``, the sums up to each row by its position 0, 1, 2, ... that no other row has."""
    return _prefix(rows, position, list(values), 3)


def _prefix(rows: DataFrame, position: str, values: list[str], levels: int) -> DataFrame:
    block = f"_block_{levels}"
    rows = rows.withColumn(block, F.shiftright(position, _BLOCK))
    here = Window.partitionBy(block).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("*", *[F.sum(x).over(here).alias(f"sum_{x}") for x in values])
    if not levels:
        return summed.drop(block)
    blocks = rows.groupBy(block).agg(*[F.sum(x).alias(f"_t_{x}") for x in values])
    blocks = _prefix(blocks, block, [f"_t_{x}" for x in values], levels - 1).select(
        F.col(block).alias("_other"), *[(F.col(f"sum__t_{x}") - F.col(f"_t_{x}")).alias(f"_b_{x}") for x in values]
    )
    kept = [c for c in rows.columns if c != block]
    joined = summed.join(blocks, F.col(block) == F.col("_other"))
    return joined.select(*kept, *[(F.col(f"sum_{x}") + F.col(f"_b_{x}")).alias(f"sum_{x}") for x in values])
