"""Quoted CSV with line breaks inside fields, one file read by many tasks.

A line begins a record if an even number of quotes stands before it in its file.
Each task marks the lines of its block for both cases, an even and an odd number
before the block; the numbers of quotes, added up over the blocks of a file, then
say which case holds. A line that is a record of its own stays where it is. Only
lines of longer records are shuffled, by record.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlore.sources.shared import materialize, ship_library

_LINES = (
    "_file long, _block long, value string, _odd int, _before int, _n long, _even_starts long,"
    " _odd_starts long"
)


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the lines of each block and count the records that begin in it.

    ``_before`` is the parity of the quotes before the line in its block, and
    the last two columns are the starts up to the line if the quotes before the
    block are even, or odd.
    """
    block, before, lines, starts = None, 0, 0, (0, 0)
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3)]
        files, blocks, odd = columns
        changes = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
        cuts = [0, *changes.tolist(), len(odd)]
        for begin, end in zip(cuts, cuts[1:]):
            if begin == end:
                continue
            if (files[begin], blocks[begin]) != block:
                block, before, lines, starts = (files[begin], blocks[begin]), 0, 0, (0, 0)
            own = odd[begin:end].astype(np.int64)
            after = before + np.cumsum(own)
            ahead = (after - own) % 2
            even_starts = starts[0] + np.cumsum(ahead == 0)
            odd_starts = starts[1] + np.cumsum(ahead == 1)
            numbers = np.arange(lines, lines + end - begin)
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.slice(begin, end - begin).columns,
                    pa.array(ahead.astype(np.int32)), pa.array(numbers),
                    pa.array(even_starts), pa.array(odd_starts),
                ],
                ["_file", "_block", "value", "_odd", "_before", "_n", "_even_starts", "_odd_starts"],
            )
            before, lines = int(after[-1] % 2), lines + end - begin
            starts = (int(even_starts[-1]), int(odd_starts[-1]))


def _blocks(lines: DataFrame) -> DataFrame:
    """For each block, the parity of the quotes before it and the record open at its beginning."""
    counted = lines.groupBy("_file", "_block").agg(
        F.sum("_odd").alias("_odd"),
        F.max("_even_starts").alias("_even"),
        F.max("_odd_starts").alias("_uneven"),
    )
    earlier = (
        Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    inside = F.coalesce(F.sum("_odd").over(earlier) % 2, F.lit(0)).cast("int")
    counted = counted.withColumn("_inside", inside)
    starts = F.when(F.col("_inside") == 0, F.col("_even")).otherwise(F.col("_uneven"))
    # The last record that begins in a block, if one does.
    last = F.when(starts > 0, F.struct("_block", starts.alias("_record")))
    open_record = F.last("_last", ignorenulls=True).over(earlier)
    return counted.withColumn("_last", last).select(
        "_file", "_block", "_inside", open_record.alias("_open")
    )


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """``read_quoted_csv`` for files that are too large for one task each.

    The lines are written to the shared folder once, when this is called, and
    records are put together from there. Files are UTF-8, their first line
    begins the header, records end with a line feed or a carriage return and a
    line feed, and quotes stand only around fields or doubled inside them. A file with
    a single quote inside an unquoted field has to be read by ``read_quoted_csv``.
    Empty lines between records are passed over. No files or no records give no rows.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    ship_library(spark)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    scanned = spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        "value",
        (quotes % 2).cast("int").alias("_odd"),
    )
    lines = materialize(scanned.mapInArrow(_mark, _LINES), "lines")
    placed = lines.join(materialize(_blocks(lines), "blocks"), ["_file", "_block"])
    starts = F.when(F.col("_inside") == 0, F.col("_even_starts")).otherwise(F.col("_odd_starts"))
    here = F.struct("_block", starts.alias("_record"))
    placed = placed.withColumn("_at", F.when(starts > 0, here).otherwise(F.col("_open")))
    alone = (F.col("_before") == F.col("_inside")) & (F.col("_odd") == 0)
    parts = F.sort_array(F.collect_list(F.struct("_block", "_n", "value")))
    longer = (
        placed.where(~alone)
        .groupBy("_file", "_at")
        .agg(F.array_join(F.transform(parts, lambda part: part["value"]), "\n").alias("value"))
    )
    records = placed.where(alone).select("_at", "value").unionByName(longer.select("_at", "value"))
    header = (F.col("_at._block") == 0) & (F.col("_at._record") == 1)
    value = F.regexp_replace("value", r"\r\z", "")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    return (
        records.where(~header)
        .select(value.alias("value"))
        .where(F.col("value") != "")
        .select(F.from_csv("value", ddl, options).alias("row"))
        .select("row.*")
    )
