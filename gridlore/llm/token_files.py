"""Token ids in binary files of directly addressable codes.

An id is split into levels of eight bits. Level 0 has the low bits of every id;
a bitmap says which ids continue on the next level, and a directory holds the
bitmap's ranks at every 512 bits, so the place of an id on the next level is
known without decoding the ids before it. A file is a row of segments, each
complete in itself: header, documents, levels. One task writes one file by
Spark's own commit, and a line feed follows each segment.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridlore.llm.codec import codec
from gridlore.sources.shared import scratch_path

_HEAD = struct.Struct("<4sIQQQ")  # mark, levels, bytes in all, documents, ids
_MARK = b"DAC1"
_BLOCK = 512
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.int64)


def _level(chunks: np.ndarray, goes_on: np.ndarray) -> bytes:
    bits = np.packbits(goes_on, bitorder="little").tobytes()
    bits += bytes(-len(bits) % (_BLOCK // 8))
    ones = _ONES[np.frombuffer(bits, np.uint8)].reshape(-1, _BLOCK // 8).sum(axis=1)
    ranks = np.concatenate(([0], np.cumsum(ones))).astype("<u4")
    return struct.pack("<Q", len(chunks)) + bits + ranks.tobytes() + chunks.astype(np.uint8).tobytes()


def encode_segment(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """The bytes of one segment."""
    lengths = [len(ids) for _, ids in docs]
    ids = np.concatenate([x for _, x in docs]) if docs else np.empty(0, np.uint32)
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        goes_on = rest > 255
        levels.append(_level(rest & 255, goes_on))
        rest = rest[goes_on] >> 8
    keys = np.array([0 if key is None else key for key, _ in docs], "<i8").tobytes()
    known = np.array([key is not None for key, _ in docs], np.uint8).tobytes()
    ends = np.cumsum(lengths, dtype=np.int64).astype("<u8").tobytes()
    body = b"".join((keys, known, ends, *levels))
    return _HEAD.pack(_MARK, len(levels), _HEAD.size + len(body), len(docs), len(ids)) + body


class Segment:
    """A segment in a file's bytes."""

    def __init__(self, raw: memoryview):
        mark, levels, self.size, n, self.n_ids = _HEAD.unpack_from(raw)
        if mark != _MARK or self.size > len(raw):
            raise ValueError("not a segment")
        at = _HEAD.size
        self.keys = np.frombuffer(raw, "<i8", n, at)
        self.known = np.frombuffer(raw, np.uint8, n, at + 8 * n)
        self.ends = np.frombuffer(raw, "<u8", n, at + 9 * n).astype(np.int64)
        at += 17 * n
        self.levels = []
        for _ in range(levels):
            (count,) = struct.unpack_from("<Q", raw, at)
            blocks = -(-count // _BLOCK)
            bits = np.frombuffer(raw, np.uint8, blocks * _BLOCK // 8, at + 8)
            at += 8 + len(bits)
            ranks = np.frombuffer(raw, "<u4", blocks + 1, at)
            at += ranks.nbytes
            self.levels.append((bits, ranks, np.frombuffer(raw, np.uint8, count, at)))
            at += count

    def id_at(self, i: int) -> int:
        """One id, without decoding any other."""
        if not 0 <= i < self.n_ids:
            raise IndexError(i)
        value, shift = 0, 0
        for bits, ranks, chunks in self.levels:
            value |= int(chunks[i]) << shift
            byte, bit = divmod(i, 8)
            if not bits[byte] >> bit & 1:
                break
            block = i // _BLOCK
            inner = _ONES[bits[block * _BLOCK // 8 : byte]].sum()
            i = int(ranks[block] + inner + _ONES[bits[byte] & ((1 << bit) - 1)])
            shift += 8
        return value

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """The ids from ``start`` to ``end``; only their codes are read."""
        end = self.n_ids if end is None else end
        values, where, shift, a, b = np.zeros(end - start, np.uint32), None, 0, start, end
        for bits, ranks, chunks in self.levels:
            own = chunks[a:b].astype(np.uint32) << np.uint32(shift)
            if where is None:
                values += own
            else:
                values[where] += own
            first = a // 8
            flags = np.unpackbits(bits[first : -(-b // 8)], bitorder="little")[a - 8 * first :][: b - a]
            on = np.flatnonzero(flags)
            where = on if where is None else where[on]
            if not len(on):
                break
            block = a // _BLOCK
            before = np.unpackbits(bits[block * _BLOCK // 8 : first + 1], bitorder="little")
            a = int(ranks[block]) + int(before[: a - block * _BLOCK].sum())
            b = a + len(on)
            shift += 8
        return values


def segments(content: bytes) -> Iterator[Segment]:
    """The segments of a file."""
    raw, at = memoryview(content), 0
    while at < len(raw):
        segment = Segment(raw[at:])
        yield segment
        at += segment.size + 1


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end: int = 2,
    id: str = "doc_id",
    text: str = "text",
    segment_ids: int = 1 << 20,
) -> None:
    """Write the ids of all texts, each followed by ``end``, in ascending order of ``id``.

    The names of the files ascend with the ids in them. A NULL text is an empty
    one and gives only ``end``. Rows without an id come first; rows with the
    same id stand together, in the order of their texts. An empty table gives
    no segment. Other columns are ignored. ``id`` is a 64-bit integer.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = codec(tokenizer), [], 0

        def out() -> pa.RecordBatch:
            segment = encode_segment(held)
            return pa.RecordBatch.from_arrays([pa.array([segment], pa.binary())], ["segment"])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                found = own.encode(part.column(1).to_pylist())
                for key, ids in zip(part.column(0).to_pylist(), found):
                    held.append((key, np.append(ids, ids.dtype.type(end))))
                    size += len(ids) + 1
                    if size >= segment_ids:
                        yield out()
                        held, size = [], 0
        if held:
            yield out()

    rows = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blobs = ordered.mapInArrow(write, "segment binary")
    # The text writer writes a string's bytes as they are.
    blobs.select(F.col("segment").cast("string").alias("value")).write.text(path, lineSep="\n")


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of the documents in the files of a folder."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                before = 0
                for segment in segments(content.as_buffer()):
                    ids = segment.ids().astype("<u4")
                    starts = np.concatenate(([0], segment.ends[:-1])) if len(segment.ends) else segment.ends
                    crcs = [zlib.crc32(ids[a:b]) for a, b in zip(starts, segment.ends)]
                    keys = pa.array(segment.keys, mask=segment.known == 0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([name] * len(keys)), keys, pa.array(starts + before),
                            pa.array(segment.ends - starts), pa.array(crcs, pa.int64()),
                        ],
                        ["_file", "doc_id", "_inner", "n_tokens", "ids_crc32"],
                    )
                    before += segment.n_ids

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [sum(x.n_ids for x in segments(c.as_buffer())) for c in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums, pa.int64())], ["_file", "_ids"]
            )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    # One row for each file, whatever the number of documents in it.
    sizes = files.mapInArrow(total, "_file string, _ids bigint")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        "_file", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before")
    )
    rows = files.mapInArrow(
        read, "_file string, doc_id bigint, _inner bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return rows.join(F.broadcast(sizes), "_file").select(
        "doc_id", (F.col("_before") + F.col("_inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str, end: int = 2) -> DataFrame:
    """Write the files to the shared folder and read them back."""
    path = scratch_path(docs.sparkSession, "ids")
    write_token_files(docs, path, tokenizer, end)
    return read_token_files(docs.sparkSession, path)
