"""Shards of equal bytes by a k-d tree, with column functions only.

Each cell of the tree is split along its widest dimension at the weighted
median, the weight of a document being its bytes, until there are as many
leaves as shards. The medians are found by distributed histograms of the
coordinate's bits, ten at a time, so the driver sees a bounded number of sums
and never a document. All dimensions are metadata of the text itself, so equal
texts are one point and stay in one shard.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlore.sources.shared import materialize

DIMENSIONS = ("_size", "_width", "_mark")
_BITS = 30


def _points(docs: DataFrame, id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    top = float((1 << _BITS) - 1)
    size = (F.octet_length("_text") + 1).cast("bigint")
    return rows.select(
        "doc_id",
        size.alias("size"),
        F.crc32(F.col("_text").cast("binary")).alias("text_crc32"),
        # The length on a scale of powers of two, the share of one-byte characters, and a
        # mark that tells texts apart where the others don't.
        F.floor(F.log2(size.cast("double")) / 40.0 * top).alias("_size"),
        F.floor((F.length("_text") + 1) / size * top).alias("_width"),
        F.shiftrightunsigned(F.xxhash64("_text"), 64 - _BITS).alias("_mark"),
    )


def _cut_giants(points: DataFrame, share: float) -> DataFrame:
    """Copies of one text that outweigh a shard get marks of their own, to be cut."""
    texts = ["_mark", "text_crc32", "size"]
    # Fewer than there are shards, as each outweighs one.
    giants = points.groupBy(*texts).agg(F.sum("size").alias("_bytes"))
    giants = giants.where(F.col("_bytes") > share).withColumn("_giant", F.lit(True)).drop("_bytes")
    own = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32"), 64 - _BITS)
    marked = points.join(F.broadcast(giants), texts, "left")
    return marked.withColumn("_mark", F.when(F.col("_giant"), own).otherwise(F.col("_mark"))).drop(
        "_giant"
    )


class _Cell:
    def __init__(self, first: int, shards: int):
        self.first, self.shards, self.split = first, shards, None

    def leaves(self) -> list[_Cell]:
        return [self] if self.split is None else [y for x in self.split[2] for y in x.leaves()]

    def place(self) -> Column:
        """The first shard of the leaf that a point is in."""
        if self.split is None:
            return F.lit(self.first)
        name, bound, (left, right) = self.split
        return F.when(F.col(name) <= bound, left.place()).otherwise(right.place())


def _medians(points: DataFrame, wanted: dict[int, tuple[str, float]]) -> dict[int, tuple[int, float]]:
    """For each cell the bound along a dimension that comes nearest to a share of its bytes.

    ``wanted`` has the dimension and the share; the result the bound and how far
    the bytes up to it are from the share, in parts of the cell.
    """
    low = {cell: 0 for cell in wanted}
    below = {cell: 0 for cell in wanted}
    total: dict[int, int] = {}
    last: dict[int, tuple[int, int]] = {}
    for shift in (20, 10, 0):
        where = F.col("_cell").isin(list(wanted))
        value, floor = F.lit(None).cast("bigint"), F.lit(None).cast("bigint")
        for cell, (name, _) in wanted.items():
            here = F.col("_cell") == cell
            value = F.when(here, F.col(name)).otherwise(value)
            floor = F.when(here, F.lit(low[cell])).otherwise(floor)
        bucket = F.shiftright(value - floor, shift)
        sums = (
            points.where(where)
            .select("_cell", bucket.alias("_bucket"), "size")
            .where(F.col("_bucket").between(0, 1023))
            .groupBy("_cell", "_bucket")
            .agg(F.sum("size").alias("_bytes"))
            .collect()  # at most 1024 rows for each cell
        )
        for cell, (_, share) in wanted.items():
            own = sorted((row["_bucket"], row["_bytes"]) for row in sums if row["_cell"] == cell)
            total.setdefault(cell, sum(x for _, x in own))
            goal, seen = share * total[cell], below[cell]
            for at, size in own:
                if seen + size >= goal or (at, size) == own[-1]:
                    break
                seen += size
            if shift:
                low[cell], below[cell] = low[cell] + (at << shift), seen
            else:
                last[cell] = (low[cell] + at, size)
                below[cell] = seen
    found = {}
    for cell, (_, share) in wanted.items():
        (bound, size), goal = last[cell], share * total[cell]
        without, within = goal - below[cell], below[cell] + size - goal
        if within <= without:
            found[cell] = bound, abs(within) / max(1, total[cell])
        else:
            found[cell] = bound - 1, abs(without) / max(1, total[cell])
    return found


def _grow(points: DataFrame, root: _Cell, tolerance: float) -> None:
    while open_cells := {cell.first: cell for cell in root.leaves() if cell.shards > 1}:
        placed = points.withColumn("_cell", root.place())
        ends = [f(name).alias(f"{kind}{name}") for name in DIMENSIONS for kind, f in (("a", F.min), ("b", F.max))]
        extents = {
            row["_cell"]: sorted(
                ((row[f"b{name}"] - row[f"a{name}"], -i) for i, name in enumerate(DIMENSIONS)),
                reverse=True,
            )
            for row in placed.groupBy("_cell").agg(*ends).collect()
        }
        best: dict[int, tuple] = {}
        tried = 0
        # The widest dimension is taken unless its median lies in copies too heavy to be fair.
        while tried < len(DIMENSIONS):
            wanted = {}
            for first, cell in open_cells.items():
                if first in extents and (first not in best or best[first][0] > tolerance):
                    name = DIMENSIONS[-extents[first][tried][1]]
                    wanted[first] = name, (cell.shards // 2) / cell.shards
            if not wanted:
                break
            for first, (bound, off) in _medians(placed, wanted).items():
                if first not in best or off < best[first][0]:
                    best[first] = off, wanted[first][0], bound
            tried += 1
        for first, cell in open_cells.items():
            _, name, bound = best.get(first, (0, DIMENSIONS[0], 0))
            half = cell.shards // 2
            parts = _Cell(first, half), _Cell(first + half, cell.shards - half)
            cell.split = name, bound, parts


def shard(
    docs: DataFrame,
    shards: int = 8,
    tolerance: float = 0.002,
    blocks: int = 1024,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of all documents.

    ``size`` is the text's bytes and one more; the shards have nearly equal
    sums of it. Equal texts are in one shard unless their copies outweigh a
    shard. A NULL text counts as an empty one. Rows with the same or no id and
    repeated rows have slots of their own. Other columns of ``docs`` are
    ignored; an empty table gives an empty result.
    """
    points = materialize(_points(docs, id, text), "points")
    total = points.agg(F.sum("size")).first()[0] or 0
    points = _cut_giants(points, total / shards)
    root = _Cell(0, shards)
    if total:
        _grow(points, root, tolerance)
    placed = points.select(
        "doc_id", "size", "text_crc32", root.place().cast("int").alias("shard"),
        F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(blocks)).cast("int").alias("_block"),
    )
    # Slots are counted block by block, so that a shard is not numbered by one task.
    before = Window.partitionBy("shard").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("shard", "_block").agg(F.count("*").alias("_n"))
    counts = counts.select(
        "shard", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("shard", "_block").orderBy("doc_id", "text_crc32", "size")
    # The counts are at most one row for each shard and block.
    numbered = placed.withColumn("_inner", F.row_number().over(inside) - 1).join(
        F.broadcast(counts), ["shard", "_block"]
    )
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_before") + F.col("_inner")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
