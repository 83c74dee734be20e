"""Passages that repeat across documents, by compact windows.

The shingles of a text are ordered by how rare they are. A shingle that is among
the few least of an interval as long as a passage is a compact window; with one
instead of a few, windows are the long nodes of a Cartesian tree. Of two intervals
that agree well enough, fewer places differ than are kept, so at least one of the
least shingles is in both, whatever the order: no passage is missed. The order
decides only how many documents meet in vain: what is in many documents is a
window only where an interval has little else.

Documents meet if they have equal windows. In small groups all meet. In large
ones all meet the first; where no passage is found around a window, its document
meets the first of those that are left, too, and in the end all earlier ones.
The two documents are then compared along the diagonal and those a few places
beside it, as words may be put in or left out, and runs that agree well enough
over a passage's length are reported.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlore.llm.codec import let_go
from gridlore.llm.shingles import WIDTH, lists, mix, shingle, word_hashes
from gridlore.operators.skew import Limits, balanced_join, fits_broadcast
from gridlore.sources.shared import materialize, small_batches


# By so many places may the shifts of two runs differ that are joined.
DRIFT = 3
# In a group of at most so many equal windows all documents meet.
FEW = 16
# So many times those that are left of a large group meet the first of them, before they meet all.
ROUNDS = 1
# By so many counters frequent shingles are told from rare ones.
COUNTERS = 1 << 22


def compact_windows(
    shingles: np.ndarray, ends: np.ndarray, least: int, hashes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, place, key)`` of all windows that span at least ``least`` shingles."""
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    texts, places, keys = [], [], []
    for i in range(hashes):
        hashed = mix(shingles ^ mix(np.full(1, i + 1, np.uint64)))
        at = least_places(hashed, ends, least, 1)
        texts.append(owner[at])
        places.append(at - ends[owner[at]])
        keys.append(hashed[at])
    return np.concatenate(texts), np.concatenate(places), np.concatenate(keys)


def least_places(order: np.ndarray, ends: np.ndarray, least: int, kept: int) -> np.ndarray:
    """The places that are among the ``kept`` least of an interval of ``least`` places inside a text.

    ``order`` is positive. Equal values are kept together.
    """
    size = len(order)
    bounds = np.zeros(size, order.dtype)
    # By pieces, as each place is looked at in ``least`` intervals.
    for at in range(0, size - least + 1, 1 << 15):
        part = np.lib.stride_tricks.sliding_window_view(order[at : at + (1 << 15) + least - 1], least)
        bounds[at : at + len(part)] = part.min(1) if kept == 1 else np.partition(part, kept - 1, 1)[:, kept - 1]
    starts = np.repeat(ends[1:], np.diff(ends)) - np.arange(size) >= least
    bounds[~starts] = 0
    # The largest bound of the intervals that hold a place.
    widest, span = np.concatenate((np.zeros(least - 1, order.dtype), bounds)), 1
    while 2 * span <= least:
        widest = np.maximum(widest[: len(widest) - span], widest[span:])
        span *= 2
    widest = np.maximum(widest[:size], widest[least - span :])
    return np.flatnonzero((order <= widest) & (widest > 0))


def agreeing_runs(a: np.ndarray, b: np.ndarray, shift: int, least: int, share: float) -> list[tuple[int, int]]:
    """Stretches of ``a`` that agree with ``b``, ``shift`` places before, in a share of their places.

    They begin and end where the two agree; from each beginning the stretch is
    the longest, and none lies within another.
    """
    start, end = max(0, shift), min(len(a), len(b) + shift)
    if end - start < least:
        return []
    same = a[start:end] == b[start - shift : end - shift]
    if np.count_nonzero(same) < share * least - 1e-9:
        return []
    edges = np.flatnonzero(np.diff(np.concatenate(([0], same.view(np.int8), [0])))) + start
    x, y = edges[::2], edges[1::2]
    size = y - x
    upto = np.cumsum(size)
    # A stretch from i to j agrees well enough if what j has over the share is no less than what i has.
    begins, ends = upto - size - share * x, upto - share * y
    later = np.maximum.accumulate(ends[::-1])[::-1]
    far = np.searchsorted(-later, 1e-9 - begins, "right") - 1
    good = np.flatnonzero(y[far] - x >= least)
    good = good[np.append(True, far[good][1:] > np.maximum.accumulate(far[good])[:-1])] if len(good) else good
    return list(zip(x[good].tolist(), y[far[good]].tolist()))


def diagonal_runs(a: np.ndarray, b: np.ndarray, shifts: list[int], least: int, share: float) -> list[tuple[int, int]]:
    """``agreeing_runs`` of all ``shifts``, the most promising first; those that add nothing are passed over."""
    if len(shifts) <= 2 * DRIFT:
        return [run for shift in shifts for run in agreeing_runs(a, b, shift, least, share)]
    counts = []
    for shift in shifts:
        start, end = max(0, shift), min(len(a), len(b) + shift)
        same = np.count_nonzero(a[start:end] == b[start - shift : end - shift]) if start < end else 0
        counts.append(same)
    found, fresh = [], np.ones(len(a), bool)
    for i in np.argsort(np.negative(counts), kind="stable").tolist():
        if counts[i] < share * least - 1e-9:
            break
        shift = shifts[i]
        start, end = max(0, shift), min(len(a), len(b) + shift)
        if ((a[start:end] == b[start - shift : end - shift]) & fresh[start:end]).any():
            for run in agreeing_runs(a, b, shift, least, share):
                found.append(run)
                fresh[run[0] : run[1]] = False
    return found


def _may_hold(a: np.ndarray, b: np.ndarray, least: int, share: float) -> bool:
    """Does an interval of ``a`` have enough shingles that ``b`` has, too, wherever? Else ``a`` has no passage of ``b``."""
    if len(a) < least:
        return False
    over = np.zeros(1 << 16, bool)
    over[b.view(np.uint16)] = True
    upto = np.concatenate(([0], np.cumsum(over[a.view(np.uint16)])))
    return (upto[least:] - upto[:-least]).max() >= least - _may_differ(least, share)


def _may_differ(least: int, share: float) -> int:
    """How many places of the best interval of ``least`` shingles in a passage may differ.

    A passage twice as long and longer has a shorter one in it. In one of length ``n``, at most ``n`` times
    ``1 - share`` places differ, and of the two intervals at its ends, which hold it all, one has half of
    the ``n * share`` that agree. The bounds meet where ``n`` is ``least / (1 - share / 2)``.
    """
    return min(least - 1, int((1 - share) * least / (1 - share / 2) + 1e-9))


def _path(blocks: list[tuple[int, int, int]]) -> list[int]:
    """The blocks ``(start, end, shift)`` of the way through both texts on which most agrees."""
    totals, before, last = [], [], {}
    for x, y, shift in blocks:
        total, came = y - x, -1
        for other in range(shift - DRIFT, shift + DRIFT + 1):
            i = last.get(other)
            if i is not None:
                end = blocks[i][1]
                gain = y - x - max(0, end - x, end - other - x + shift)
                if gain > 0 and totals[i] + gain > total:
                    total, came = totals[i] + gain, i
        last[shift] = len(totals)
        totals.append(total)
        before.append(came)
    at, path = int(np.argmax(totals)), []
    while at >= 0:
        path.append(at)
        at = before[at]
    return path[::-1]


def shifted_runs(
    a: np.ndarray, b: np.ndarray, shifts: list[int], least: int, share: float, done: list[tuple[int, int]] = ()
) -> list[tuple[int, int]]:
    """Stretches of ``a`` that agree with ``b`` where words are put in or left out.

    Runs whose shifts differ by at most ``DRIFT`` places are joined. The stretch
    is as long as ``least`` in one of the texts, and ``share`` of it agrees in both.
    The shingles are of 16 bits. What agrees nowhere outside the stretches that are
    ``done`` adds nothing to them and is passed over.
    """
    over = np.zeros(1 << 16, bool)
    over[b.view(np.uint16)] = True
    over = over[a.view(np.uint16)]
    for x, y in done:
        over[x:y] = False
    # Over: what ``b`` has too, somewhere. A lone one adds nothing, as it may be equal by chance.
    if np.count_nonzero(over) < share * least if not done else not (over[1:] & over[:-1]).any():
        return []
    near, wanted = sorted({s + d for s in shifts for d in range(-DRIFT, DRIFT + 1)}), share * least
    groups = np.split(near, np.flatnonzero(np.diff(near) > DRIFT) + 1)
    found = []
    for group in groups:
        same, total, left = [], 0, False
        for shift in group.tolist():
            start, end = max(0, shift), min(len(a), len(b) + shift)
            if start < end:
                equal = a[start:end] == b[start - shift : end - shift]
                count = np.count_nonzero(equal)
                if count:
                    same.append((start, shift, equal))
                    total += count
                    left = left or bool((equal & over[start:end]).any())
        if total < wanted or len(same) < 2 or not left:
            continue
        blocks = []
        for start, shift, equal in same:
            edges = np.flatnonzero(np.diff(np.concatenate(([0], equal.view(np.int8), [0])))) + start
            blocks += [(x, y, shift) for x, y in edges.reshape(-1, 2).tolist()]
        blocks.sort()
        while sum(y - x for x, y, _ in blocks) >= wanted:
            path = _path(blocks)
            runs = _stretches([blocks[i] for i in path], least, share)
            if not runs:
                break
            found += runs
            taken = set(path)
            blocks = [block for i, block in enumerate(blocks) if i not in taken]
    return found


def _stretches(blocks: list[tuple[int, int, int]], least: int, share: float) -> list[tuple[int, int]]:
    """The longest stretches of a path that are long enough and agree well enough."""
    x, y, shift = np.array(blocks).T
    begins = x.copy()
    begins[1:] += np.maximum(0, np.maximum(y[:-1] - x[1:], (y - shift)[:-1] - (x - shift)[1:]))
    size = y - begins
    upto = np.cumsum(size)
    # A lone shingle may be equal by chance: it counts inside a stretch and doesn't end one.
    ends = y - x > 1
    found, reach = [], -1
    for i in np.flatnonzero(ends).tolist():
        j = np.arange(max(i, reach + 1), len(x))
        span = np.maximum(y[j] - begins[i], (y - shift)[j] - (begins - shift)[i])
        good = ends[j] & (span >= least) & (upto[j] - upto[i] + size[i] + 1e-9 >= share * span)
        if good.any():
            reach = int(j[good][-1])
            found.append((int(begins[i]), int(y[reach])))
    return found


def _indexed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """A written table with the words of each document as 32 bits and its shingles as 16."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                words, cut = lists(part.column(3))
                words = (words >> np.uint64(32)).astype(np.uint32)
                hashed, ends = _shingles(words, cut)
                # Two texts are compared by 16 bits a shingle, as runs of many decide.
                own = (hashed >> np.uint64(48)).astype(np.uint16).view(np.int16)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:3],
                        pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(words.view(np.int32))),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(own)),
                    ],
                    ["_row", "doc_id", "mark", "words", "shingles"],
                )

    hashed = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id).alias("doc_id"),
        word_hashes(F.col(text)).alias("_words"),
    )
    hashed = hashed.select("_row", "doc_id", F.xxhash64("_words").alias("mark"), "_words")
    kind = hashed.schema["doc_id"].dataType.simpleString()
    indexed = hashed.mapInArrow(
        index, f"_row bigint, doc_id {kind}, mark bigint, words array<int>, shingles array<smallint>"
    )
    with small_batches(docs.sparkSession):
        return materialize(indexed, "windows")


def _shingles(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of words that are numbers of 32 bits, and where each text's begin and end."""
    return shingle(mix(words.astype(np.uint64) + np.uint64(1)), offsets)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = column.offsets.to_numpy().astype(np.int64)
    values = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    return values.to_numpy(zero_copy_only=False).view(np.uint32), offsets - offsets[0]


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles % np.uint64(COUNTERS)).astype(np.int64)


def _frequencies(indexed: DataFrame) -> np.ndarray:
    """How often the shingles of each counter stand in the texts, as a logarithm.

    Those that are not well above the mean count as rare. No more tasks count
    than there are cores, each in one table of a fixed size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(COUNTERS, np.int32)
        for batch in batches:
            np.add.at(table, _counter(_shingles(*_words(batch.column(0)))[0]), 1)
        at = np.flatnonzero(table > 8 + 2 * table.mean())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[at], pa.int64())], ["at", "n"])

    cores = indexed.sparkSession.sparkContext.defaultParallelism
    with small_batches(indexed.sparkSession):
        counts = indexed.select("words").coalesce(cores).mapInArrow(count, "at bigint, n bigint")
        found = counts.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    levels = np.zeros(COUNTERS, np.uint8)
    levels[found.column("at").to_numpy()] = np.log2(found.column("n").to_numpy()).astype(np.uint8)
    return levels


def _whole_runs(places: np.ndarray, shingles: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``places`` with all of the run where a word is repeated that one of them is in."""
    if not len(places):
        return places
    changes = np.append(True, shingles[1:] != shingles[:-1])
    changes[ends[:-1][ends[:-1] < len(shingles)]] = True
    begins = np.flatnonzero(changes)
    kept = np.zeros(len(shingles), bool)
    kept[places] = True
    sizes = np.diff(np.append(begins, len(shingles)))
    return np.flatnonzero(np.repeat(np.logical_or.reduceat(kept, begins), sizes))


def chains(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(first, last, step)``: which places of a key stand at equal distances, as where a word is repeated.

    All places of a key are in its chains, a lone one in one of step 0. ``places`` ascend for each key.
    """
    order = np.argsort(keys, kind="stable")
    key, place = keys[order], places[order]
    linked = key[1:] == key[:-1]
    gap = np.where(linked, np.diff(place), 0)
    # A chain is a run of equal gaps; one of no gaps is a place alone.
    begins = np.flatnonzero(linked & np.append(True, gap[1:] != gap[:-1])[: len(gap)])
    ends = np.flatnonzero(linked & np.append(gap[1:] != gap[:-1], True)[: len(gap)]) + 1
    alone = np.flatnonzero(~(np.append(False, linked) | np.append(linked, False))[: len(key)])
    first, last = np.append(begins, alone), np.append(ends, alone)
    step = np.append(gap[begins], np.zeros(len(alone), np.int64))
    return order[first], order[last], step


def _windows(indexed: DataFrame, least: int, share: float) -> DataFrame:
    """``(key, _row, place, last, step)``: the compact windows of each document, in chains.

    One more is kept of each interval than may differ.
    """
    kept = _may_differ(least, share) + 1
    held = indexed.sparkSession.sparkContext.broadcast(_frequencies(indexed))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = held.value
        for batch in batches:
            hashed, ends = _shingles(*_words(batch.column(1)))
            order = levels[_counter(hashed)].astype(np.uint32) << np.uint32(26)
            order |= (mix(hashed) >> np.uint64(38)).astype(np.uint32) | np.uint32(1)
            at = _whole_runs(least_places(order, ends, least, kept), hashed, ends)
            owner = np.searchsorted(ends, at, "right") - 1
            own = at - ends[owner]
            first, last, step = chains(hashed[at] ^ mix(owner.astype(np.uint64)), own)
            columns = (own[first], own[last], step)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashed[at[first]].view(np.int64)), batch.column(0).take(pa.array(owner[first])),
                    *[pa.array(x.astype(np.int32)) for x in columns],
                ],
                ["key", "_row", "place", "last", "step"],
            )

    schema = "key bigint, _row bigint, place int, last int, step int"
    return indexed.select("_row", "words").mapInArrow(rarest, schema)


def _agreeing(pairs: DataFrame, least: int, share: float) -> DataFrame:
    """``(_row, first, start, end)``: the runs in which ``_own`` agrees with ``_other``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            rows = []
            for row, first, shifts, own, other in zip(*batch.columns):
                a, b = own.values.to_numpy(), other.values.to_numpy()
                ids = row.as_py(), first.as_py()
                if np.array_equal(a, b):
                    # Their windows meet on the main diagonal, which has it all.
                    runs = agreeing_runs(a, b, 0, least, share)
                elif not (_may_hold(a, b, least, share) and _may_hold(b, a, least, share)):
                    continue
                else:
                    met = sorted(shifts.as_py())
                    runs = diagonal_runs(a, b, met, least, share)
                    runs += shifted_runs(a, b, met, least, share, runs)
                rows += [(*ids, *run) for run in runs]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [()] * 4)],
                ["_row", "first", "start", "end"],
            )

    return pairs.mapInArrow(compare, "_row bigint, first bigint, start bigint, end bigint")


def _shared(windows: DataFrame) -> DataFrame:
    """``(key, _row, place, last, step, _n, _met)``: windows that another document has, too, written.

    ``_n`` counts those with the key; ``_met`` are the windows that one meets at once:
    all before it in a small group, the first in a large one.
    """
    by_key = Window.partitionBy("key")
    # Dealt by the key once, for all.
    shared = windows.repartition("key").select(
        "*", F.min(_here()).over(by_key).alias("_first"), F.max("_row").over(by_key).alias("_last"),
        F.count("*").over(by_key).alias("_n"),
    )
    # Most keys are in one document only.
    shared = shared.where("_first._row < _last")
    before = F.collect_list(_here()).over(by_key.orderBy(*_WINDOW).rowsBetween(1 - FEW, -1))
    met = F.when(F.col("_n") <= FEW, before).otherwise(F.array("_first"))
    return materialize(shared.select("key", *_WINDOW, "_n", met.alias("_met")), "shared")


def _pairs(meetings: DataFrame) -> DataFrame:
    """``(_row, first, shifts)`` of windows and the earlier ones ``_met`` that they meet, written."""
    met = meetings.select(*_WINDOW, F.explode("_met").alias("_met")).where("_row > _met._row")
    # Of two chains, one is taken apart if their steps differ.
    apart = (F.col("step") != F.col("_met.step")) & (F.col("step") > 0) & (F.col("_met.step") > 0)
    ends = F.when(
        apart,
        F.transform(
            F.expr("sequence(_met.place, _met.last, if(_met.step > 0, _met.step, 1))"),
            lambda at: F.struct(at.alias("place"), at.alias("last")),
        ),
    ).otherwise(F.array(F.struct("_met.place", "_met.last")))
    met = met.withColumn("_end", F.explode(ends))
    step, other = F.col("step"), F.col("_met.step")
    place, last = F.col("place"), F.col("last")
    # Where both repeat a word, nothing between differs, so one is laid along the other.
    alike = (step == 1) & (other == 1)
    low = F.when(alike, place - F.col("_met.place")).otherwise(place - F.col("_end.last"))
    width = F.when(alike, F.col("_met.last") - F.col("_met.place") + step)
    width = width.otherwise(F.greatest(step, other, F.lit(1)))
    high = F.when(alike, last - F.col("_met.place")).otherwise(last - F.col("_end.place"))
    at_end = F.when(alike, last - F.col("_met.last")).otherwise(high)
    shifts = F.array_union(F.sequence(low, high, width), F.array(at_end))
    met = met.select("_row", F.col("_met._row").alias("first"), F.explode(shifts).alias("shift"))
    return materialize(met.groupBy("_row", "first").agg(F.collect_set("shift").alias("shifts")), "pairs")


def _left(windows: DataFrame, runs: DataFrame) -> DataFrame:
    """The windows that lie in no passage found, written."""
    found = runs.groupBy("_row").agg(F.collect_set(F.struct("start", "end")).alias("_runs"))
    covered = F.exists("_runs", lambda run: (F.col("place") >= run["start"]) & (F.col("last") < run["end"]))
    left = windows.join(found, "_row", "left").where(F.col("_runs").isNull() | ~covered)
    return materialize(left.select(*windows.columns), "left")


# Where a window, or a chain of equal ones, stands.
_WINDOW = ["_row", "place", "last", "step"]


def _here() -> Column:
    return F.struct(*_WINDOW)


# Tables of one number a row: 64 MB at the most.
_NUMBERS = Limits(max_rows=4_000_000)


def _compared(pairs: DataFrame, indexed: DataFrame, least: int, share: float) -> DataFrame:
    """``(_row, first, start, end)``: the runs of pairs ``(_row, first, shifts)``, written."""
    ids = pairs.select("_row").unionByName(pairs.select(F.col("first").alias("_row"))).distinct()
    ids = materialize(ids, "ids")
    shingles = indexed.select("_row", "shingles")
    if fits_broadcast(ids, _NUMBERS):
        shingles = shingles.join(F.broadcast(ids), "_row", "left_semi")
    # The shorter text of a pair is sent to the longer one.
    lengths = indexed.select("_row", F.size("shingles").alias("_n"))
    pairs = pairs.join(lengths, "_row").join(
        lengths.select(F.col("_row").alias("first"), F.col("_n").alias("_m")), "first"
    )
    own = F.col("_n") <= F.col("_m")
    pairs = pairs.select(
        "_row", "first", "shifts", own.alias("_sent"),
        F.when(own, F.col("_row")).otherwise(F.col("first")).alias("_short"),
        F.when(own, F.col("first")).otherwise(F.col("_row")).alias("_long"),
    )
    for end in ("_short", "_long"):
        pairs = pairs.join(
            shingles.select(F.col("_row").alias(end), F.col("shingles").alias(f"{end}_text")), end
        )
    pairs = pairs.select(
        "_row", "first", "shifts",
        F.when(F.col("_sent"), F.col("_short_text")).otherwise(F.col("_long_text")).alias("_own"),
        F.when(F.col("_sent"), F.col("_long_text")).otherwise(F.col("_short_text")).alias("_other"),
    )
    with small_batches(indexed.sparkSession):
        return materialize(_agreeing(pairs, least, share), "runs")


def repeated_passages(
    docs: DataFrame,
    least_words: int = 50,
    share: float = 0.8,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``(doc_id, mark, start, end, first_id)``: passages that an earlier document has too.

    A passage has at least ``least_words`` words, and ``share`` or more of its
    five-word shingles agree; where words are put in or left out, the longer of
    its two forms has so many words. ``start`` and ``end`` count words, the end is
    excluded; the passages of a document don't overlap. ``mark`` is a hash of
    the document's words, for ids that are not unique; ``first_id`` belongs to
    one of the earlier documents. Documents are ordered as they are read, and
    the first of those that share a passage is not reported. A NULL or empty
    text and one of fewer words has no passage; NULL ids and repeated rows are
    documents like others; other columns are ignored; an empty table gives an
    empty result.
    """
    least = least_words - WIDTH + 1
    indexed = _indexed(docs, id, text)
    with small_batches(docs.sparkSession):
        shared = _shared(_windows(indexed, least, share))
    runs = _compared(_pairs(shared), indexed, least, share)
    # A document has fewer windows than words.
    large = shared.where(F.col("_n") > FEW).select("key", *_WINDOW)
    left = _left(large, runs)
    group = Window.partitionBy("key").orderBy(*_WINDOW)
    for i in range(ROUNDS):
        if left.isEmpty():
            break
        # The ones before have been met, and stay themselves.
        next = F.nth_value(_here(), i + 1).over(
            group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        )
        pairs = _pairs(left.withColumn("_met", F.array(next)))
        runs = runs.unionByName(_compared(pairs, indexed, least, share))
        left = _left(left, runs)
    if not left.isEmpty():
        others = large.select("key", _here().alias("_other"))
        pairs = balanced_join(left, others, ["key"], condition=F.col("_row") > F.col("_other._row"))
        pairs = _pairs(pairs.withColumn("_met", F.array("_other")))
        runs = runs.unionByName(_compared(pairs, indexed, least, share))

    # Overlapping passages of a document are one. There are few in a document.
    merged = runs.groupBy("_row").agg(
        F.sort_array(F.collect_set(F.struct("start", "end", "first"))).alias("_runs")
    )
    joint = F.aggregate(
        "_runs",
        F.expr("cast(array() as array<struct<start: bigint, end: bigint, first: bigint>>)"),
        _joined_runs,
    )
    merged = merged.select("_row", F.explode(joint).alias("_run")).select(
        "_row", "_run.start", (F.col("_run.end") + WIDTH - 1).alias("end"), "_run.first"
    )
    names = indexed.select("_row", "doc_id", "mark")
    firsts = names.select(F.col("_row").alias("first"), F.col("doc_id").alias("first_id"))
    return merged.join(names, "_row").join(firsts, "first").select(
        "doc_id", "mark", "start", "end", "first_id"
    )


def _joined_runs(done: Column, run: Column) -> Column:
    """A sorted run joined with the one before if their words overlap."""
    overlaps = (F.size(done) > 0) & (run["start"] <= F.get(done, F.size(done) - 1)["end"] + (WIDTH - 1))
    longer = F.struct(
        F.get(done, F.size(done) - 1)["start"].alias("start"),
        F.greatest(F.get(done, F.size(done) - 1)["end"], run["end"]).alias("end"),
        F.least(F.get(done, F.size(done) - 1)["first"], run["first"]).alias("first"),
    )
    before = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
    return F.when(overlaps, F.concat(before, F.array(longer))).otherwise(
        F.concat(done, F.array(run))
    )


def cut_passages(
    docs: DataFrame, passages: DataFrame, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without the words of ``passages`` and what stands between them.

    A document of which no word is left is dropped; one that had none stays.
    All columns of ``docs`` stay.
    """
    spans = passages.groupBy("doc_id", "mark").agg(
        F.collect_set(F.struct("start", "end")).alias("_spans")
    )
    spans = spans.withColumnsRenamed({"doc_id": "_id", "mark": "_of"})
    rows = docs.select(
        F.struct(*docs.columns).alias("_doc"), F.col(text).alias("_text"), F.col(id).alias("_key"),
        F.xxhash64(word_hashes(F.col(text))).alias("_mark"),
    )
    on = F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_of"))
    rows = rows.join(spans, on, "left").select("_doc", "_text", "_spans")
    # Words and what is between them take turns.
    pieces = F.regexp_extract_all(F.col("_text"), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    lead = F.when(F.col("_text").rlike(r"^[\p{L}\p{N}]"), 0).otherwise(1)
    # Exploding one element keeps the optimizer from cutting a text anew for each of its pieces.
    cut = F.struct(F.when(F.col("_spans").isNotNull(), pieces).alias("pieces"), lead.alias("lead"))
    rows = rows.select("*", F.explode(F.array(cut)).alias("_cut"))
    rows = rows.select(
        "_doc", "_text", "_spans", F.col("_cut.pieces").alias("_pieces"),
        F.col("_cut.lead").alias("_lead"),
    )

    def stays(piece: Column, i: Column) -> Column:
        word = F.floor((i - F.col("_lead")) / 2)
        between = (i - F.col("_lead")) % 2 != 0
        return ~F.exists(
            "_spans",
            lambda s: (word >= s["start"])
            & F.when(between, word < s["end"] - 1).otherwise(word < s["end"]),
        )

    left = F.array_join(F.filter("_pieces", stays), "")
    rows = rows.withColumn("_left", F.when(F.col("_spans").isNotNull(), left).otherwise(F.col("_text")))
    rows = rows.where(F.col("_spans").isNull() | F.col("_left").rlike(r"[\p{L}\p{N}]"))
    kept = [
        F.col("_left").alias(name) if name == text else F.col("_doc")[name].alias(name)
        for name in docs.columns
    ]
    return rows.select(*kept)
