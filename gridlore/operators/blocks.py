"""Words of many texts looked up in tables that are too large to hold.

The texts are written in blocks of a bounded number of words. Within a block each
different word has a number, its code, and a text is a list of codes. Only the
different words of a block become rows: they meet the tables in a join, and what
they find comes back to the block, where the texts are put together again. So the
rows that are shuffled grow with the different words of the blocks, and carry
neither a text nor the columns that are kept of it.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlore.sources.shared import materialize, ship_library

# Words and texts in a block: some 60 MB of words. The larger, the fewer of its words are different ones.
BLOCK = 6_000_000
_PLACE = 1 << 32

# The codes of all texts of a block, and where each text begins and ends.
Codes = tuple[np.ndarray, np.ndarray]


def _numbered(lists: list[pa.Array]) -> tuple[pa.Array, pa.Array]:
    """Lists of words as lists of codes, and the words in the order of their codes, in the first row."""
    joined = pa.concat_arrays(lists)
    ends = np.concatenate(([0], np.cumsum(joined.value_lengths().fill_null(0).to_numpy())))
    coded = joined.flatten().dictionary_encode(null_encoding="encode")
    cuts = np.full(len(ends), len(coded.dictionary))
    cuts[0] = 0
    return (
        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), coded.indices),
        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), coded.dictionary),
    )


def in_blocks(
    docs: DataFrame, keep: Sequence[str], lists: Sequence[Column], size: int = BLOCK
) -> DataFrame:
    """The written table ``(_block, _kept, _codes_0, ..., _words_0, ...)`` of texts.

    ``_kept`` has the kept columns. Of each of ``lists`` there are the codes of
    every text; the first text of a block has the block's words.
    """
    ship_library(docs.sparkSession)
    kinds = range(len(lists))
    listed = docs.select(
        F.struct(F.lit(0).alias("_none"), *keep).alias("_kept"),
        *[words.alias(f"_list_{i}") for i, words in zip(kinds, lists)],
    )

    def block(held: list[pa.RecordBatch], number: int) -> pa.RecordBatch:
        kept = pa.concat_arrays([part.column(0) for part in held])
        coded = [_numbered([part.column(i + 1) for part in held]) for i in kinds]
        columns = [pa.array(np.full(len(kept), number)), kept, *[x for x, _ in coded], *[x for _, x in coded]]
        return pa.RecordBatch.from_arrays(columns, names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() * _PLACE
        held, full = [], 0
        for batch in batches:
            rows = np.ones(batch.num_rows, np.int64)
            for i in kinds:
                rows += batch.column(i + 1).value_lengths().fill_null(0).to_numpy()
            at = 0
            while at < len(rows):
                upto = full + np.cumsum(rows[at:])
                taken = min(int(np.searchsorted(upto, size)) + 1, len(upto))
                held.append(batch.slice(at, taken))
                at, full = at + taken, int(upto[taken - 1])
                if full >= size:
                    yield block(held, number)
                    held, full, number = [], 0, number + 1
        if held:
            yield block(held, number)

    fields = [
        T.StructField("_block", T.LongType()),
        listed.schema["_kept"],
        *[T.StructField(f"_codes_{i}", T.ArrayType(T.IntegerType())) for i in kinds],
        *[T.StructField(f"_words_{i}", T.ArrayType(T.StringType())) for i in kinds],
    ]
    names = [field.name for field in fields]
    return materialize(listed.mapInArrow(pack, T.StructType(fields)), "blocks")


def block_words(blocks: DataFrame) -> DataFrame:
    """``(_block, _kind, _code, token)``: the different words of each block; the kind is the list's number."""
    lists = [name for name in blocks.columns if name.startswith("_words_")]
    kinds = [F.struct(F.lit(i).alias("_kind"), F.col(name).alias("_words")) for i, name in enumerate(lists)]
    return (
        blocks.where(F.size(lists[0]) + sum((F.size(x) for x in lists[1:]), F.lit(0)) > 0)
        .select("_block", F.inline(F.array(*kinds)))
        .select("_block", "_kind", F.posexplode("_words").alias("_code", "token"))
    )


def meet(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of words of blocks to a large table with one row per key.

    A block has a word once, so no key has more rows than there are blocks, and
    none needs to be cut.
    """
    return rows.join(table.hint("merge"), list(keys), "left")


def answered(
    blocks: DataFrame,
    found: DataFrame,
    keep: Sequence[str],
    results: dict[str, str],
    answer: Callable[[list[Codes], list[pa.Table]], list[pa.Array]],
) -> DataFrame:
    """``(*keep, *results)``, with the results that ``answer`` makes for the texts of a block.

    ``found`` has ``_block``, ``_kind``, ``_code`` and what was found for that
    word. ``answer`` gets the codes of each list, and a table of what was found for
    it; ``results`` are the names and types of what it returns.
    """
    lists = [name for name in blocks.columns if name.startswith("_codes_")]

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        codes, tables = [], []
        kinds = words.column("_kind").to_numpy()
        for i, name in enumerate(lists):
            own = pa.concat_arrays(texts.column(name).chunks)
            ends = np.concatenate(([0], np.cumsum(own.value_lengths().fill_null(0).to_numpy())))
            codes.append((own.flatten().to_numpy(), ends))
            tables.append(words.filter(pa.array(kinds == i)).combine_chunks())
        return pa.Table.from_arrays(
            [pa.concat_arrays(texts.column("_kept").chunks), *answer(codes, tables)],
            ["_kept", *results],
        )

    schema = T.StructType([
        blocks.schema["_kept"],
        *[T.StructField(name, T._parse_datatype_string(kind)) for name, kind in results.items()],
    ])
    # Under another name, as both sides come from one table.
    texts = blocks.select(F.col("_block").alias("_of"), "_kept", *lists)
    done = texts.groupBy("_of").cogroup(found.groupBy("_block")).applyInArrow(run, schema)
    return done.select(*[F.col("_kept")[name].alias(name) for name in keep], *results)


def _column(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table.column(name).chunks) if table.num_rows else None


def sums(codes: Codes, found: pa.Table, values: str, width: int) -> pa.Array:
    """The sums of the lists of ``width`` numbers over the words of each text; unknown words have none."""
    flat, ends = codes
    matrix = np.zeros((width, int(flat.max(initial=-1)) + 1), np.int64)
    lists = _column(found, values)
    if lists is not None:
        known = lists.is_valid()
        at = _column(found, "_code").filter(known).to_numpy()
        matrix[:, at] = lists.filter(known).flatten().to_numpy().reshape(-1, width).T
    each = np.empty((len(ends) - 1, width), np.int64)
    totals = np.zeros(len(flat) + 1, np.int64)
    for i in range(width):
        np.cumsum(matrix[i][flat], out=totals[1:])
        each[:, i] = totals[ends[1:]] - totals[ends[:-1]]
    cuts = np.arange(len(each) + 1) * width
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(each.reshape(-1)))


def picked(codes: Codes, found: pa.Table, value: str) -> pa.Array:
    """The values that were found for the words of each text, in order."""
    flat, ends = codes
    values = _column(found, value)
    if values is None:
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.nulls(len(flat), pa.string()))
    place = np.zeros(int(flat.max(initial=-1)) + 1, np.int64)
    place[_column(found, "_code").to_numpy()] = np.arange(len(values))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values.take(pa.array(place[flat])))


def picked_known(codes: Codes, found: pa.Table, value: str) -> pa.Array:
    """``picked`` without the words whose value is NULL."""
    lists = picked(codes, found, value)
    stays = lists.values.is_valid()
    before = np.concatenate(([0], np.cumsum(stays.to_numpy(zero_copy_only=False))))
    kept = before[lists.offsets.to_numpy()]
    return pa.ListArray.from_arrays(pa.array(kept, pa.int32()), lists.values.filter(stays))
