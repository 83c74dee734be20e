"""Near duplicates by ProbMinHash, banding and verification.

The shingles of a text are weighted by how often they occur. Each shingle is a
Poisson process whose rate is its weight; every arrival falls on one of the
signature's registers, and a register keeps the shingle that arrives first. The
share of equal registers of two texts estimates their probability Jaccard
similarity. A shingle's arrivals end as soon as they come later than all
registers. Registers are banded; texts that share a band are compared exactly.
A text with shingles that repeat has the bands of a second signature, in which
each shingle weighs one: its share of equal registers estimates the Jaccard
similarity of the sets. For other texts the two are the same.

A band shared by few texts gives all their pairs. One shared by many gives a
star around the text in its middle. For texts that this leaves in other
components, an exact index finds what they may be linked to: in the order of how
rare shingles are, two linked texts have a shingle in common among the first
ones of each, up to where what follows weighs too little. A line that many texts
share is not among them. So no link is lost, and no texts are compared all with
all.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.llm.codec import let_go
from gridlore.llm.components import components
from gridlore.llm.shingles import lists, mix, shingle, word_hashes
from gridlore.operators.skew import Limits, balanced_join, fits_broadcast, lookup
from gridlore.sources.shared import materialize, settled, small_batches

BANDS, ROWS = 25, 5
COUNTERS = 1 << 20
_HOT = Limits(min_rows=10_000)
# Tables of one number a row: 64 MB at the most.
_NUMBERS = Limits(max_rows=4_000_000)
_ROUND = np.uint64(0xD6E8FEB86659FD93)


def prob_minhash(
    shingles: np.ndarray, ends: np.ndarray, registers: int = BANDS * ROWS
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Signatures ``[text, register]`` of many texts, and each text's sorted shingles."""
    texts = len(ends) - 1
    owner = np.repeat(np.arange(texts), np.diff(ends))
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    listed = np.split((shingles >> np.uint64(32)).astype(np.uint32), ends[1:-1])
    first = np.ones(len(shingles), bool)
    first[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    weight = np.diff(np.append(at, len(shingles))).astype(np.float64)
    item, owner = shingles[at], owner[at]

    arrival = np.full(texts * registers, np.inf)
    winner = np.zeros(texts * registers, np.uint64)
    time, state = np.zeros(len(item)), item.copy()
    while len(item):
        with np.errstate(over="ignore"):
            state = mix(state + _ROUND)
        time = time - np.log(((state >> np.uint64(12)).astype(np.float64) + 0.5) / 2.0**52) / weight
        where = (mix(state) >> np.uint64(20)).astype(np.int64) % registers + owner * registers
        early = time < arrival[where]
        hit, when = where[early], time[early]
        np.minimum.at(arrival, hit, when)
        won = arrival[hit] == when
        winner[hit[won]] = item[early][won]
        latest = arrival.reshape(texts, registers).max(axis=1)
        on = time < latest[owner]
        item, owner, weight, time, state = item[on], owner[on], weight[on], time[on], state[on]
    return winner.reshape(texts, registers), listed


def _band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (len(signatures), bands))
    parts = signatures.reshape(len(signatures), bands, rows)
    with np.errstate(over="ignore"):
        for i in range(rows):
            keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i])
    return keys


def _with_repeats(
    shingles: np.ndarray, ends: np.ndarray, listed: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The texts in which a shingle repeats, their shingles as sets, and where each set ends."""
    repeat = np.array([bool((x[1:] == x[:-1]).any()) for x in listed], bool)
    texts = np.flatnonzero(repeat & (np.diff(ends) > 0))
    sets = [np.unique(shingles[ends[i] : ends[i + 1]]) for i in texts]
    cut = np.concatenate(([0], np.cumsum([len(x) for x in sets], dtype=np.int64))).astype(np.int64)
    return texts, np.concatenate(sets) if sets else shingles[:0], cut


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The larger of the probability Jaccard similarity and that of the shingles as sets."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    a, x = np.unique(a, return_counts=True)
    b, y = np.unique(b, return_counts=True)
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    plain = len(both) / (len(a) + len(b) - len(both))
    if plain >= 1.0 and np.array_equal(x[i], y[j]):
        return 1.0
    only_a, only_b = np.delete(x, i), np.delete(y, j)
    pairs, times = np.unique(np.stack((x[i], y[j])), axis=1, return_counts=True)
    total = 0.0
    for p, q, n in zip(*pairs, times):
        rest = only_a.sum() / p + only_b.sum() / q
        total += n / (np.maximum(pairs[0] / p, pairs[1] / q) @ times + rest)
    return max(plain, float(total))


def _signed(docs: DataFrame, id: str, text: str, bands: int, rows: int) -> DataFrame:
    """A written table with a row for each document: its words' mark, bands and shingles."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                values, offsets = lists(part.column(4))
                hashes, ends = shingle(values, offsets)
                signatures, listed = prob_minhash(hashes, ends, bands * rows)
                keys = _band_keys(signatures, bands, rows)
                has = np.diff(ends) > 0
                of = np.repeat(np.flatnonzero(has), bands)
                keys = keys[has].reshape(-1)
                texts, sets, cut = _with_repeats(hashes, ends, listed)
                if len(texts):
                    # Only the bands in which the two signatures differ are further ones.
                    plain = _band_keys(prob_minhash(sets, cut, bands * rows)[0], bands, rows)
                    own = _band_keys(signatures[texts], bands, rows)
                    differ = plain != own
                    of = np.concatenate((of, np.broadcast_to(texts[:, None], differ.shape)[differ]))
                    keys = np.concatenate((keys, plain[differ]))
                    order = np.argsort(of, kind="stable")
                    of, keys = of[order], keys[order]
                counts = np.bincount(of, minlength=part.num_rows)
                key_list = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()),
                    pa.array(keys.view(np.int64)),
                )
                flat = np.concatenate(listed) if listed else np.empty(0, np.uint32)
                shingle_list = pa.ListArray.from_arrays(
                    pa.array(ends, pa.int32()), pa.array(flat.view(np.int32))
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:4], key_list, shingle_list],
                    ["_row", "doc_id", "k1", "k2", "bands", "shingles"],
                )

    words = word_hashes(F.col(text))
    hashed = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id).alias("doc_id"), words.alias("_words")
    )
    hashed = hashed.select(
        "_row", "doc_id",
        F.xxhash64("_words").alias("k1"), F.xxhash64(F.lit(1), "_words").alias("k2"), "_words",
    )
    kind = hashed.schema["doc_id"].dataType.simpleString()
    signed = hashed.mapInArrow(
        sign,
        f"_row bigint, doc_id {kind}, k1 bigint, k2 bigint, "
        "bands array<bigint>, shingles array<int>",
    )
    with small_batches(docs.sparkSession):
        return materialize(signed, "signed")


def _only(rows: DataFrame, written: DataFrame, key: str) -> DataFrame:
    """The rows whose number is in a written table; where its numbers fit a broadcast nothing is shuffled."""
    ids = written.select(key)
    return rows.join(F.broadcast(ids) if fits_broadcast(ids, _NUMBERS) else ids, key, "left_semi")


def _verified(pairs: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``(a, b)`` that are similar enough, written."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            lists_a, lists_b = batch.column(2), batch.column(3)
            good = [
                similarity(a.values.to_numpy(), b.values.to_numpy()) >= threshold
                for a, b in zip(lists_a, lists_b)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], ["a", "b"]
            ).filter(pa.array(good, pa.bool_()))

    sides = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    for end in ("a", "b"):
        own = shingles.select(F.col("_row").alias(end), F.col("shingles").alias(f"_{end}"))
        sides = sides.join(own, end)
    sides = sides.select("a", "b", "_a", "_b")
    with small_batches(pairs.sparkSession):
        return materialize(sides.mapInArrow(verify, "a bigint, b bigint"), "links")


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, root)`` after more links; only the components that they join are looked at."""
    for end in ("a", "b"):
        up = roots.select(F.col("node").alias(end), F.col("root").alias(f"_{end}"))
        links = links.join(up, end, "left").withColumn(f"_{end}", F.coalesce(f"_{end}", end))
    ends = links.select(F.explode(F.array(F.struct("a", "_a"), F.struct(F.col("b").alias("a"), F.col("_b").alias("_a")))).alias("_e"))
    known = roots.unionByName(ends.select(F.col("_e.a").alias("node"), F.col("_e._a").alias("root"))).distinct()
    moved = components(links.select(F.col("_a").alias("a"), F.col("_b").alias("b"))).select(
        F.col("node").alias("_node"), F.col("root").alias("_root")
    )
    known = known.join(moved, F.col("root") == F.col("_node"), "left")
    return materialize(known.select("node", F.coalesce("_root", "root").alias("root")), "components")


def _counted(texts: DataFrame) -> DataFrame:
    """``(at, n)``: in how many texts the shingles of counter ``at`` are, several rows for a counter.

    No more tasks count than there are cores, each in one table. So the rows are
    bounded by the cores and ``COUNTERS``, however many pieces the texts come in.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for own in batch.column(0):
                np.add.at(table, np.unique(own.values.to_numpy()) % COUNTERS, 1)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at])], ["at", "n"])

    cores = texts.sparkSession.sparkContext.defaultParallelism
    return texts.select("shingles").coalesce(cores).mapInArrow(count, "at bigint, n bigint")


def _counters(texts: DataFrame) -> np.ndarray:
    """In how many texts the shingles of each counter are; there are ``COUNTERS`` of them, whatever the size."""
    counts = _counted(texts).groupBy("at").agg(F.sum("n").alias("n"))
    found = counts.toArrow()
    table = np.zeros(COUNTERS, np.int64)
    table[found.column("at").to_numpy()] = found.column("n").to_numpy()
    return table


def _prefixes(texts: DataFrame, threshold: float) -> DataFrame:
    """``(node, root, shingle, w, n, size, plain)``: each text's rarest shingles, of which linked texts share one.

    What two texts share weighs at least ``threshold`` in each, by the counts or
    as sets. So the rarest shingle that they share stands where at least that
    much is still to come, in both; ``w`` is its share of the counts, ``n`` its
    number of different shingles, of ``size``. In a ``plain`` text none repeats.
    Rare is what has a small counter; any order that is the same for all texts
    is right. Those that only one text has are left out.
    """
    held = texts.sparkSession.sparkContext.broadcast(_counters(texts))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = held.value
        for batch in batches:
            parts = []
            for i, own in enumerate(batch.column(2)):
                values, times = np.unique(own.values.to_numpy(), return_counts=True)
                if not len(values):
                    continue
                often = counters[values % COUNTERS]
                order = np.lexsort((values, often))
                onward = times[order][::-1].cumsum()[::-1] / times.sum()
                n = np.arange(len(values), 0, -1)
                at = (np.maximum(onward, n / len(values)) >= threshold - 1e-9) & (often[order] > 1)
                k = int(at.sum())
                parts.append((np.full(k, i), values[order][at], onward[at], n[at], np.full(k, len(values)), np.full(k, times.max() == 1)))
            row, shingle, w, n, size, plain = map(np.concatenate, zip(*parts)) if parts else [np.zeros(0, int)] * 6
            taken = [batch.column(j).take(pa.array(row, pa.int64())) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    *taken, pa.array(shingle, pa.int32()), pa.array(w, pa.float64()),
                    *[pa.array(x, pa.int64()) for x in (n, size)], pa.array(plain.astype(bool)),
                ],
                ["node", "root", "shingle", "w", "n", "size", "plain"],
            )

    schema = "node bigint, root bigint, shingle int, w double, n bigint, size bigint, plain boolean"
    with small_batches(texts.sparkSession):
        return materialize(texts.select("node", "root", "shingles").mapInArrow(rarest, schema), "prefixes")


def _possible(apart: DataFrame, outside: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of a text outside and one of another component that may be linked."""
    members = materialize(apart.select("node", "root").distinct(), "members")
    # Read twice. Where the members fit a broadcast, the shingles are not shuffled for it.
    other = F.broadcast(members) if fits_broadcast(members, _NUMBERS) else members
    texts = shingles.withColumnRenamed("_row", "node").join(other, "node")
    rarest = _prefixes(texts, threshold)
    lone = outside.select(F.col("node").alias("a")).distinct()
    own = rarest.withColumnsRenamed({"node": "a", **{x: f"_{x}" for x in ("root", "w", "n", "size", "plain")}})
    own = own.join(lone, "a", "left_semi")
    others = rarest.withColumnRenamed("node", "b")
    # At the rarest shingle of both, what stands before it in either is in one text only. So no
    # more is shared than is still to come in either; shares x and y of the counts that are
    # allow a similarity of 1 / (1 / x + 1 / y - 1).
    both = F.least("n", "_n") >= (F.col("size") + F.col("_size")) * (threshold / (1 + threshold)) - 1e-9
    weighted = 1 / F.col("w") + 1 / F.col("_w") <= 1.0 + 1.0 / threshold + 1e-9
    able = both | ~(F.col("plain") & F.col("_plain")) & weighted
    met = balanced_join(
        others, own, ["shingle"], condition=able & (F.col("root") != F.col("_root")), limits=_HOT
    )
    return met.select("a", "b")


def near_classes(
    docs: DataFrame,
    threshold: float = 0.8,
    bands: int = BANDS,
    rows: int = ROWS,
    few: int = 32,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, class_id, class_key, k1, k2)``, one row for each row of ``docs``.

    Documents are near duplicates if their weighted five-word shingles have a
    probability Jaccard similarity, or the shingles as sets a Jaccard
    similarity, of ``threshold`` or more. A class is a component of such links
    and named after its least id, NULL if none of its rows has one; ``class_key``
    tells classes apart in any case, and ``k1, k2`` are marks of the words. Texts of the same words are one class; so are all texts
    without words, NULL ones included. Other columns are ignored, an empty
    table gives an empty result. ``few`` changes the work, not the result.
    """
    signed = _signed(docs, id, text, bands, rows)
    # One row of each text stands for it, with its bands.
    firsts = signed.groupBy("k1", "k2").agg(F.min(F.struct("_row", "bands")).alias("_first"))
    firsts = materialize(firsts.select("k1", "k2", F.col("_first._row").alias("node"), "_first.bands"), "firsts")
    texts = firsts.select("k1", "k2", "node")
    buckets = firsts.select("node", F.explode("bands").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = materialize(buckets.join(sizes, "key"), "buckets")
    met = materialize(buckets.select(F.col("node").alias("_row")).distinct(), "met")
    shingles = materialize(_only(signed.select("_row", "shingles"), met, "_row"), "shingles")

    small = buckets.where(F.col("n") <= few)
    listed = small.groupBy("key").agg(F.collect_list("node").alias("_all"))
    pairs = listed.select("_all", F.explode("_all").alias("a"))
    pairs = pairs.select("a", F.explode("_all").alias("b")).where("a < b")
    large = buckets.where(F.col("n") > few)
    crowded = not large.isEmpty()
    if crowded:
        # The text that shares most bands with others is in the middle of its group.
        middle = large.groupBy("node").agg(F.sum("n").alias("_middle"))
        most = F.struct("_middle", F.xxhash64("node"))
        hubs = large.join(middle, "node").groupBy("key").agg(F.max_by("node", most).alias("a"))
        hubs = materialize(hubs, "hubs")
        stars = lookup(large, hubs, ["key"], _HOT).select("a", F.col("node").alias("b"))
        pairs = pairs.unionByName(stars.where("a <> b"))
    roots = components(_verified(pairs, shingles, threshold))

    if crowded:
        # Texts outside the largest component of a bucket have not been linked to all they could be.
        placed = large.join(roots, "node", "left")
        placed = materialize(placed.select("key", "node", F.coalesce("root", "node").alias("root")), "placed")
        parts = placed.groupBy("key", "root").agg(F.count("*").alias("_n"))
        main = parts.groupBy("key").agg(F.max_by("root", F.struct("_n", "root")).alias("_main"), F.count("*").alias("_parts"))
        main = materialize(main.where("_parts > 1").drop("_parts"), "main")
        apart = materialize(lookup(placed, main, ["key"], _HOT).where("_main IS NOT NULL"), "apart")
        outside = apart.where("root <> _main")
        if not outside.isEmpty():
            links = _verified(_possible(apart, outside, shingles, threshold), shingles, threshold)
            roots = _joined(roots, links)

    placed = texts.join(roots, "node", "left").select(
        "k1", "k2", F.coalesce("root", "node").alias("_root")
    )
    least = signed.groupBy("k1", "k2").agg(F.min("doc_id").alias("_least"))
    placed = placed.join(least, ["k1", "k2"])
    names = placed.groupBy("_root").agg(F.min("_least").alias("class_id"))
    placed = placed.join(names, "_root").drop("_least")
    return signed.select("doc_id", "k1", "k2").join(placed, ["k1", "k2"]).select(
        "doc_id", "class_id", F.col("_root").alias("class_key"), "k1", "k2"
    )


def keep_one(docs: DataFrame, threshold: float = 0.8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class: the one with the least id.

    Where no row of a class has an id, or several rows have the least one, one
    of them is kept. All columns of ``docs`` stay.
    """

    def chosen() -> DataFrame:
        classes = near_classes(docs, threshold, id=id, text=text)
        first = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
        # Ids need not be unique: rows of one class and id may differ in words or be repeated.
        marks = first.groupBy("class_key", F.col("class_id").alias("_id")).agg(
            F.min(F.struct("k1", "k2")).alias("_mark"), F.count("*").alias("_n")
        )
        return marks.select("_id", "_mark.k1", "_mark.k2", "_n")

    kept = settled(docs.sparkSession, chosen, "kept")
    words = word_hashes(F.col(text))
    marked = docs.select(F.struct(*docs.columns).alias("_doc"), F.col(id).alias("_id"), words.alias("_words"))
    marked = marked.select(
        "_doc", "_id", F.xxhash64("_words").alias("k1"), F.xxhash64(F.lit(1), "_words").alias("k2")
    )
    on = (
        F.col("_id").eqNullSafe(F.col("_kept_id"))
        & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    )
    other = kept.select(
        F.col("_id").alias("_kept_id"), F.col("k1").alias("_k1"), F.col("k2").alias("_k2"), "_n"
    )
    found = marked.join(other, on)
    once = found.where("_n = 1").select("_doc")
    if not kept.where("_n > 1").isEmpty():
        again = found.where("_n > 1").dropDuplicates(["_kept_id", "k1", "k2"]).select("_doc")
        once = once.unionByName(again)
    return once.select("_doc.*")
