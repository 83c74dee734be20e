"""Benchmark passages in documents, by spaced seeds.

A seed is a mask over up to ten neighbouring words of which six count; the others
may differ. The hashes of all masks at all places of the benchmark are joined
with those of the documents. Around a hit, the words of item and document are
laid side by side, and stretches that agree up to some substitutions are
reported. Of the documents' hashes only those go to the join that a filter of a
fixed size, made of the benchmark's hashes, lets through.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.llm.passages import agreeing_runs
from gridlore.llm.codec import let_go
from gridlore.llm.shingles import lists, mix, word_hashes
from gridlore.operators.skew import fits_broadcast
from gridlore.sources.shared import materialize

# Whichever fifth of the words of a passage of 10 to 15 words is replaced, a mask
# lies where it does not count; of longer passages they find more.
MASKS = ("1101001101", "1110110001", "1010001111", "1100101011", "1111011", "11011101", "111100011")
LEAST = 10
_FILTER_BITS = 26


def seed_hashes(
    words: np.ndarray, offsets: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each mask the ``(places, hashes)`` of all texts."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    for number, mask in enumerate(MASKS):
        whole = len(words) - len(mask) + 1
        if whole <= 0:
            continue
        starts = np.flatnonzero(np.arange(whole) + len(mask) <= ends[:whole])
        value = np.full(whole, number + 1, np.uint64)
        with np.errstate(over="ignore"):
            for i, counts in enumerate(mask):
                if counts == "1":
                    value = (value ^ words[i : i + whole]) * np.uint64(0x9E3779B97F4A7C15)
                    value ^= value >> np.uint64(32)
        yield starts, mix(value[starts])


def _probes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << _FILTER_BITS) - 1)
    return hashes & mask, hashes >> np.uint64(64 - _FILTER_BITS)


def _seeds(items: DataFrame) -> DataFrame:
    """``(hash, item, place)`` of all seeds of ``(item, words)``, written."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, own in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = own.values.to_numpy().view(np.uint64)
                for places, hashes in seed_hashes(words, np.array([0, len(words)])):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(hashes.view(np.int64)),
                            pa.array(np.full(len(places), row, np.int64)),
                            pa.array(places, pa.int64()),
                        ],
                        ["hash", "item", "item_place"],
                    )

    found = items.mapInArrow(seeds, "hash bigint, item bigint, item_place bigint")
    return materialize(found, "seeds")


def _filter(seeds: DataFrame) -> np.ndarray:
    """A bit for each value of either end of the hashes: 8 MB, whatever the benchmark's size."""
    low = F.col("hash").bitwiseAND(F.lit((1 << _FILTER_BITS) - 1))
    high = F.shiftrightunsigned("hash", 64 - _FILTER_BITS)
    ends = F.explode(F.array(F.struct(F.lit(0).alias("n"), low.alias("at")), F.struct(F.lit(1).alias("n"), high.alias("at"))))
    ends = seeds.select(ends.alias("_end")).select("_end.n", "_end.at")
    bits = F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))")
    words = ends.groupBy("n", F.shiftright("at", 6).alias("word")).agg(bits.alias("bits"))
    table = np.zeros((2, 1 << (_FILTER_BITS - 6)), np.int64)
    found = words.toPandas()  # at most two times 2 ** 20 rows
    table[found["n"].to_numpy(int), found["word"].to_numpy(int)] = found["bits"].to_numpy(np.int64)
    return table.view(np.uint8)


def _has(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _stretches(a: np.ndarray, b: np.ndarray, shift: int, least: int, share: float) -> list[tuple[int, int]]:
    """Where an item ``b`` stands in ``a``: as a whole, its ends agreeing or not, or in stretches."""
    if 0 <= shift <= len(a) - len(b) and (a[shift : shift + len(b)] == b).sum() >= share * len(b) - 1e-9:
        return [(shift, shift + len(b))]
    return agreeing_runs(a, b, shift, min(least, len(b)), share)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    least_words: int = 13,
    share: float = 0.8,
    id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``(doc_id, mark, item_id, start, end, matched)``: stretches of items in documents.

    A stretch has at least ``least_words`` words, or is a whole item, and
    ``share`` or more of them agree in place. ``start`` and ``end`` count the
    document's words, the end is excluded; ``mark`` is a hash of all its words.
    Items of fewer than ten words are too short to tell a leak from a phrase
    and are never found. NULL and empty texts have no words. Rows with a NULL or
    repeated id are searched like others, repeated items are found each; other
    columns are ignored; if either table is empty, so is the result.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"),
        word_hashes(F.col(item_text)).alias("item_words"),
    )
    items = materialize(items.where(F.size("item_words") >= LEAST), "items")
    seeds = _seeds(items.select("item", "item_words"))
    table = spark.sparkContext.broadcast(_filter(seeds))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        low, high = table.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                words, offsets = lists(part.column(3))
                places, hashes = [], []
                for starts, values in seed_hashes(words, offsets):
                    a, b = _probes(values)
                    hit = np.flatnonzero(_has(low, a))
                    hit = hit[_has(high, b[hit])]
                    places.append(starts[hit])
                    hashes.append(values[hit])
                if not places or not sum(map(len, places)):
                    continue
                place, value = np.concatenate(places), np.concatenate(hashes)
                owner = np.searchsorted(offsets, place, "right") - 1
                order = np.argsort(owner, kind="stable")
                counts = np.bincount(owner, minlength=part.num_rows)
                cut = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                inner = (place - offsets[owner])[order]
                found = pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.ListArray.from_arrays(cut, pa.array(value[order].view(np.int64))),
                        pa.ListArray.from_arrays(cut, pa.array(inner, pa.int64())),
                    ],
                    ["_row", "doc_id", "mark", "words", "hashes", "places"],
                )
                yield found.filter(pa.array(counts > 0))

    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id).alias("doc_id"),
        word_hashes(F.col(text)).alias("words"),
    ).select("_row", "doc_id", F.xxhash64("words").alias("mark"), "words")
    kind = rows.schema["doc_id"].dataType.simpleString()
    hits = materialize(
        rows.mapInArrow(
            search,
            f"_row bigint, doc_id {kind}, mark bigint, words array<bigint>, "
            "hashes array<bigint>, places array<bigint>",
        ),
        "hits",
    )

    small = F.broadcast if fits_broadcast(seeds) else (lambda x: x)
    met = hits.select("_row", F.explode(F.arrays_zip("hashes", "places")).alias("_hit"))
    met = met.select("_row", F.col("_hit.hashes").alias("hash"), F.col("_hit.places").alias("place"))
    met = met.join(small(seeds), "hash").groupBy("_row", "item").agg(
        F.collect_set(F.col("place") - F.col("item_place")).alias("shifts")
    )
    # An item has at most 16 bytes a word and a list's head; fits_broadcast counts rows and fixed widths.
    item_words = items.agg(F.coalesce(F.sum(F.size("item_words")), F.lit(0))).first()[0]
    few = F.broadcast if item_words <= 4_000_000 and fits_broadcast(items.drop("item_words")) else (lambda x: x)
    pairs = met.join(hits.select("_row", "doc_id", "mark", "words"), "_row").join(few(items), "item")
    pairs = pairs.select("_row", "doc_id", "mark", "item_id", "shifts", "words", "item_words")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kept = [], []
            lists_of = (batch.column(i) for i in (4, 5, 6))
            for i, (shifts, words, own) in enumerate(zip(*lists_of)):
                a, b = words.values.to_numpy(), own.values.to_numpy()
                for shift in sorted(shifts.as_py()):
                    for start, end in _stretches(a, b, shift, least_words, share):
                        same = int((a[start:end] == b[start - shift : end - shift]).sum())
                        kept.append(i)
                        rows.append((start, end, same))
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(at) for i in (1, 2, 3)]
                + [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [()] * 3)],
                ["doc_id", "mark", "item_id", "start", "end", "matched"],
            )

    item_kind = items.schema["item_id"].dataType.simpleString()
    return pairs.mapInArrow(
        verify,
        f"doc_id {kind}, mark bigint, item_id {item_kind}, "
        "start bigint, end bigint, matched bigint",
    )


def without_contaminated(docs: DataFrame, found: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the documents in which benchmark items were ``found``."""
    bad = found.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_of")).distinct()
    rows = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.col(id).alias("_key"),
        F.xxhash64(word_hashes(F.col(text))).alias("_mark"),
    )
    on = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_of"))
    return rows.join(bad, on, "left_anti").select("_doc.*")
