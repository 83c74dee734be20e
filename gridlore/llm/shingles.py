"""Words of texts as hashes, and shingles of five words made from them."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WIDTH = 5
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(text: Column) -> Column:
    """The words of a text in lower case, each as 64 bits; no text has none."""
    words = F.split(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]+")
    hashed = F.transform(words, lambda word: F.xxhash64(F.lower(word)))
    # A text that begins or ends with another character has an empty word there.
    return F.array_remove(hashed, F.xxhash64(F.lit("")))


def mix(x: np.ndarray) -> np.ndarray:
    """Well spread 64 bits of 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lists(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of lists as unsigned numbers, and where each list begins and ends."""
    offsets = array.offsets.to_numpy().astype(np.int64)
    values = array.values.slice(offsets[0], offsets[-1] - offsets[0])
    return values.to_numpy(zero_copy_only=False).view(np.uint64), offsets - offsets[0]


def shingle(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of many texts, and where each text's begin and end.

    A text of fewer than five words is one shingle; one without words has none.
    """
    sizes = np.diff(offsets)
    counts = np.where(sizes >= WIDTH, sizes - WIDTH + 1, np.minimum(sizes, 1))
    ends = np.concatenate(([0], np.cumsum(counts)))
    padded = np.concatenate((words, np.zeros(WIDTH, np.uint64)))
    at = np.arange(ends[-1]) + np.repeat(offsets[:-1] - ends[:-1], counts)
    own = np.repeat(sizes, counts)
    value = np.zeros(len(at), np.uint64)
    for i in range(WIDTH):
        value = np.where(i < own, (value ^ padded[at + i]) * _M1 + _M2, value)
    return mix(value), ends
