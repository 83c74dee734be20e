"""Packing of token sequences by best-fit decreasing.

Documents longer than a window are first cut into full windows. What is left of
each document goes, longest first, into the open window with the least room
that still holds it. A segment tree indexed by the room finds that window, so a
placement takes as many steps as the window size has bits, however many windows
are open. Each task packs the documents it reads: texts are not shuffled, and
only a task's last windows stay open.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlore.llm.codec import codec
from gridlore.sources.shared import materialize


class RoomTree:
    """Open windows by their room, with the least room that is large enough found in a tree."""

    def __init__(self, size: int):
        self.width = 1 << size.bit_length()
        self.count = [0] * (2 * self.width)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def put(self, window: int, room: int) -> None:
        self.windows[room].append(window)
        self._add(room, 1)

    def _add(self, room: int, by: int) -> None:
        node = room + self.width
        while node:
            self.count[node] += by
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """The tightest window with at least this room, and its room."""
        node = least + self.width
        if not self.count[node]:
            # Up to the first right neighbour that holds windows, then down its left side.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.width:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.width
        self._add(room, -1)
        return self.windows[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """``(window, offset in it)`` of each piece of at most ``size`` tokens, and the windows' number."""
    window, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    tree, opened = RoomTree(size), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        found = tree.take(length)
        if found is None:
            found, opened = (opened, size), opened + 1
        window[i], offset[i] = found[0], size - found[1]
        if found[1] > length:
            tree.put(found[0], found[1] - length)
    return window, offset, opened


def _fill(pieces: list[list], size: int) -> int:
    """Set the places of a task's remainders; returns the number of windows.

    Windows that best fit leaves open are emptied, emptiest first, into the
    room of the others as long as that room holds all of a window's tokens, a
    piece being cut where the room ends.
    """
    lengths = np.array([piece[2] for piece in pieces], np.int64)
    window, offset, opened = best_fit_decreasing(lengths, size)
    used = np.bincount(window, lengths, opened).astype(np.int64)
    order = np.argsort(used, kind="stable").tolist()
    inside: dict[int, list[int]] = {}
    for i, at in enumerate(window.tolist()):
        pieces[i][3:5] = [at, int(offset[i])]
        if used[at] < size:
            inside.setdefault(at, []).append(i)
    low, high, room = 0, len(order) - 1, int(size * opened - used.sum())
    gone = set()
    while low < high and room - (size - used[order[low]]) >= used[order[low]]:
        source = order[low]
        room -= size
        gone.add(source)
        for i in inside.pop(source):
            while pieces[i][2]:
                while high > low and used[order[high]] == size:
                    high -= 1
                target = order[high]
                if high == low:
                    raise AssertionError("the room was counted wrongly")
                some = min(pieces[i][2], size - int(used[target]))
                rest = pieces[i][2] - some
                pieces[i][2:5] = [some, target, int(used[target])]
                used[target] += some
                if rest:
                    pieces.append([pieces[i][0], pieces[i][1] + some, rest, 0, 0])
                    i = len(pieces) - 1
                else:
                    break
        low += 1
    # Numbers without gaps.
    numbers = {old: new for new, old in enumerate(x for x in range(opened) if x not in gone)}
    for piece in pieces:
        piece[3] = numbers[piece[3]]
    return len(numbers)


def pack(
    docs: DataFrame,
    tokenizer: str,
    size: int = 1024,
    end: int = 0,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """The pieces of all documents in sequences of at most ``size`` tokens.

    Columns ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, ids``. The ids are those of the library for the file ``tokenizer``,
    then ``end``. A NULL or empty text is that one id. Rows with the same id, or
    none, are packed each on its own; other columns of ``docs`` are ignored; an
    empty table gives no pieces. The pieces are written to the shared folder
    once, so that the sequences can be numbered.
    """

    def pack_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = codec(tokenizer), TaskContext.get().partitionId()
        docs_at: list[tuple] = []
        pieces: list[list] = []
        rests: list[bytes] = []
        full = 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(zip(*rows), out_types)], out_names
            )

        out_names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "_window", "offset", "_task", "_full"]
        out_types = [None, *[pa.int64()] * 4, pa.binary(), *[pa.int64()] * 3, pa.bool_()]
        for batch in batches:
            out_types[0] = batch.schema.field(0).type
            for at in range(0, batch.num_rows, 128):
                part, rows = batch.slice(at, 128), []
                keys, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                for key, ids in zip(keys, own.encode(texts)):
                    ids = np.append(ids, ids.dtype.type(end)).astype("<u4")
                    for start in range(0, len(ids), size):
                        raw = ids[start : start + size].tobytes()
                        if len(raw) == 4 * size:
                            rows.append((key, start, size, zlib.crc32(raw), len(ids), raw, full, 0, task, True))
                            full += 1
                        else:
                            pieces.append([len(docs_at), 0, len(raw) // 4, 0, 0])
                            docs_at.append((key, start, len(ids)))
                            rests.append(raw)
                if rows:
                    yield batch_of(rows)
        if not pieces:
            return
        _fill(pieces, size)
        for at in range(0, len(pieces), 1024):
            rows = []
            for i, inner, length, window, offset in pieces[at : at + 1024]:
                key, start, total = docs_at[i]
                raw = rests[i][4 * inner : 4 * (inner + length)]
                rows.append((key, start + inner, length, zlib.crc32(raw), total, raw, full + window, offset, task, False))
            yield batch_of(rows)

    rows = docs.select(
        F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = materialize(
        rows.mapInArrow(
            pack_task,
            f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
            "ids binary, _window bigint, offset bigint, _task bigint, _full boolean",
        ),
        "packed",
    )
    # One row for each task that packed: few, and no more with more documents in a task.
    tasks = pieces.groupBy("_task").agg((F.max("_window") + 1).alias("_windows"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select(
        "_task", F.coalesce(F.sum("_windows").over(before), F.lit(0)).alias("_before")
    )
    return pieces.join(F.broadcast(tasks), "_task").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("_before") + F.col("_window")).alias("sequence_id"), "offset", "ids",
    )
