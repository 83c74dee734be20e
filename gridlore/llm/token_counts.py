"""Token counts by overlap resynchronisation.

A huge document is encoded in overlapping chunks with offsets. Two neighbouring
chunks are spliced at a boundary in their overlap that both encodings have and
that is proven stable: a single blank between two other characters, where a
tokenizer that cuts at white space always begins anew. Without such a boundary
the overlap is widened until there is one or the chunk reaches the end.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlore.llm.codec import Codec, codec


def _stable(codec: Codec, text: str, start: int, end: int) -> set[int]:
    """Places in ``text[start:end]`` where no piece of the tokenizer can reach across."""
    found, at = set(), text.find(" ", start + 1, end - 1)
    while at >= 0:
        if not text[at - 1].isspace() and not text[at + 1].isspace():
            found.add(at)
        at = text.find(" ", at + 1, end - 1)
    return found


def _begins(offsets: np.ndarray, start: int) -> dict[int, int]:
    """For each place where a token begins, how many tokens begin before it."""
    return {int(place) + start: i for i, place in reversed(list(enumerate(offsets[:, 0])))}


def _splice(codec: Codec, text: str, left, left_start, right, right_start, end) -> tuple | None:
    """``(place, tokens before it on the left, and on the right)`` near the overlap's middle."""
    a, b = _begins(left, left_start), _begins(right, right_start)
    # A token may begin at the blank or after it, as the tokenizer keeps blanks or not.
    common = []
    for at in _stable(codec, text, right_start, end):
        place = at if at in a else at + 1
        if place in a and place in b and right_start < place < end:
            common.append(place)
    middle = (right_start + end) // 2
    for place in sorted(common, key=lambda x: (abs(x - middle), x)):
        i, j = a[place], b[place]
        same = min(8, len(left) - i, len(right) - j)
        inner = (left[i : i + same] + left_start, right[j : j + same] + right_start)
        # The last token before the left chunk's end may be cut; the others must agree.
        if same > 1 and np.array_equal(inner[0][: same - 1], inner[1][: same - 1]):
            return place, i, j
    return None


def count_spliced(codec: Codec, text: str, chunk: int, overlap: int) -> int:
    """Tokens of one text, never encoding more than a chunk and its overlaps at once."""
    total, start, left, done = 0, 0, None, 0
    while True:
        end = min(len(text), start + chunk)
        if left is None:
            left = codec.offsets(text[start:end])
        if end >= len(text):
            return total + len(left) - done
        wide = overlap
        while True:
            right_start = max(start, end - wide)
            right_end = min(len(text), right_start + max(chunk, 2 * wide))
            right = codec.offsets(text[right_start:right_end])
            found = right_start > start and _splice(
                codec, text, left, start, right, right_start, end
            )
            if found:
                break
            if right_start == start:
                # No boundary in the whole chunk: make the chunk itself larger.
                chunk *= 2
                break
            wide *= 2
        if found:
            _, before, after = found
            total += before - done
            start, left, done = right_start, right, after
            chunk = right_end - right_start
        else:
            left = None
            # The chunk begins where it began; what was counted before stays.
            if done:
                end = min(len(text), start + chunk)
                left = codec.offsets(text[start:end])


def count_tokens(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    id: str = "doc_id",
    text: str = "text",
    chunk: int = 65_536,
    overlap: int = 512,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)``, one row for each row of ``docs``.

    Tokens are those of the library for the file ``tokenizer``, without added
    special tokens. A text of more than ``chunk`` characters goes through the
    chunks. A NULL text counts as an empty one: no bytes and no tokens. Repeated
    rows and NULL ids give a row each; other columns of ``docs`` are ignored;
    an empty table gives an empty result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(1).to_pylist()
                short = iter(own.count([x for x in texts if len(x) <= chunk]))
                counts = [
                    next(short) if len(x) <= chunk else count_spliced(own, x, chunk, overlap)
                    for x in texts
                ]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(counts, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    rows = docs.select(
        F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    counted = rows.mapInArrow(count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
