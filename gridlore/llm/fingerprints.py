"""Document fingerprints by consistent weighted sampling, with column functions only.

The terms of a text are its pairs of neighbouring words, weighted by how often
they occur. A hash deals the terms out to ``bins``. In each bin every term draws
from its own hash two gamma variables and a uniform one; they give an arrival
that is the smallest in two texts at once, with the same level of weight, with a
probability equal to the generalised Jaccard similarity of the texts' weights in
the bin. So a term is drawn for once and not once for every sample. Likeness is
the share of bins with equal samples among the bins that either text uses.
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_STEPS = 54 - 16  # bits that an arrival keeps


def _uniform(bits: Column) -> Column:
    """The low 32 bits of a hash as a number between 0 and 1, both excluded."""
    return (bits.bitwiseAND(F.lit((1 << 32) - 1)).cast("double") + 0.5) / float(1 << 32)


def _word_hashes(text: Column) -> Column:
    words = F.split(F.translate(F.lower(text), "\n\t\r", "   "), " ")
    return F.transform(words, lambda word: F.xxhash64(word))


def _sorted_terms(words: Column) -> Column:
    pairs = F.zip_with(words, F.slice(words, 2, 2**31 - 1), lambda a, b: F.xxhash64(a, b))
    return F.sort_array(pairs)


def _run_starts(values: Column, key=lambda x: x) -> Column:
    """Where a new value begins in a sorted array."""
    return F.filter(
        F.sequence(F.lit(0), F.size(values) - 1),
        lambda i: (i == 0) | (key(F.get(values, i)) != key(F.get(values, i - 1))),
    )


def _arrivals(terms: Column, starts: Column, bins: int) -> Column:
    """For each term its bin, arrival and sample, packed so that they sort in this order."""
    weighted = F.zip_with(
        starts,
        F.slice(starts, 2, 2**31 - 1),
        lambda i, j: F.struct(
            F.get(terms, i).alias("term"),
            F.ln((F.coalesce(j, F.size(terms)) - i).cast("double")).alias("weight"),
            F.xxhash64(F.get(terms, i), F.lit(1)).alias("a"),
            F.xxhash64(F.get(terms, i), F.lit(2)).alias("b"),
        ),
    )
    drawn = F.transform(
        weighted,
        lambda x: F.struct(
            x["term"].alias("term"),
            x["weight"].alias("weight"),
            # A gamma variable of shape 2 is a sum of two exponential ones.
            (-F.ln(_uniform(x["a"]) * _uniform(F.shiftrightunsigned(x["a"], 32)))).alias("r"),
            F.ln(-F.ln(_uniform(x["b"]) * _uniform(F.shiftrightunsigned(x["b"], 32)))).alias("c"),
            _uniform(F.xxhash64(x["term"], F.lit(3))).alias("beta"),
        ),
    )
    levelled = F.transform(
        drawn,
        lambda x: F.struct(
            x["term"].alias("term"),
            x["r"].alias("r"),
            x["c"].alias("c"),
            x["beta"].alias("beta"),
            F.floor(x["weight"] / x["r"] + x["beta"]).alias("t"),
        ),
    )
    # The logarithm of an arrival is between about -100 and 4 for any weight below 2 ** 63.
    scale = float(1 << (_STEPS - 8))

    def packed(x: Column) -> Column:
        log = x["c"] - x["r"] * (x["t"] - x["beta"]) - x["r"]
        place = F.floor((F.greatest(F.least(log, F.lit(63.0)), F.lit(-191.0)) + 192.0) * scale)
        sample = F.xxhash64(x["term"], x["t"]).bitwiseAND(F.lit(0xFFFF))
        return (
            F.shiftleft(F.pmod(x["term"], F.lit(bins)), _STEPS + 16)
            + F.shiftleft(place, 16)
            + sample
        )

    return F.sort_array(F.transform(levelled, packed))


def _samples(arrivals: Column, bins: int) -> Column:
    """The first arrival of each bin, as bin and sample."""
    whole = F.lit(1 << (_STEPS + 16))
    starts = _run_starts(arrivals, lambda x: F.shiftright(x, _STEPS + 16))
    return F.transform(
        starts,
        lambda i: F.shiftleft(F.shiftright(F.get(arrivals, i), _STEPS + 16), 16)
        + F.get(arrivals, i).bitwiseAND(F.lit(0xFFFF)),
    )


def with_samples(rows: DataFrame, texts: dict[str, str], bins: int = 64) -> DataFrame:
    """For each ``{out: text column}`` the samples of the text, as an array column ``out``."""
    if not 1 <= bins <= 256:
        raise ValueError("bins must be between 1 and 256")
    outs = list(texts)
    rows = rows.select("*", *[_word_hashes(F.col(texts[x])).alias(f"_words_{x}") for x in outs])
    rows = rows.select("*", *[_sorted_terms(F.col(f"_words_{x}")).alias(f"_terms_{x}") for x in outs])
    rows = rows.select("*", *[_run_starts(F.col(f"_terms_{x}")).alias(f"_starts_{x}") for x in outs])
    rows = rows.select(
        "*",
        *[
            _arrivals(F.col(f"_terms_{x}"), F.col(f"_starts_{x}"), bins).alias(f"_arrivals_{x}")
            for x in outs
        ],
    )
    rows = rows.select("*", *[_samples(F.col(f"_arrivals_{x}"), bins).alias(x) for x in outs])
    steps = ("words", "terms", "starts", "arrivals")
    return rows.drop(*[f"_{step}_{x}" for step in steps for x in outs])


def fingerprint(samples: Column) -> Column:
    """The samples as text: six hexadecimal digits for each used bin."""
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples among the bins that either side uses."""
    bins = [F.transform(x, lambda y: F.shiftright(y, 16)) for x in (a, b)]
    union = F.size(F.array_union(*bins))
    return F.size(F.array_intersect(a, b)).cast("double") / union


def _bounds(rows: DataFrame, block_bytes: int, max_blocks: int) -> list[int]:
    """Ids that begin blocks of about equally many rows; the first is the least id."""
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    blocks = max(1, min(max_blocks, math.ceil(size / block_bytes)))
    at = [i / blocks for i in range(blocks)]
    accuracy = max(10_000, 4 * blocks)
    found = rows.agg(F.percentile_approx("doc_id", at, accuracy)).first()[0] or []
    return sorted(set(found))


def _block(id: Column, bounds: Column, count: int) -> Column:
    """How many bounds an id has reached, by bisection."""
    steps = [1 << i for i in reversed(range(count.bit_length()))]
    return F.aggregate(
        F.array(*[F.lit(x) for x in steps]),
        F.lit(0),
        lambda n, step: F.when(F.get(bounds, n + step - 1) <= id, n + step).otherwise(n),
    )


def fingerprint_documents(
    docs: DataFrame,
    bins: int = 64,
    block_bytes: int = 4 << 20,
    max_blocks: int = 100_000,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Fingerprints of every text and of its edited text, and what they say of likeness.

    The edited text is the text with its last quarter of characters replaced by
    the first as many of the next document by ascending ``id``; after the last
    comes the first. Columns ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``, one row for each row of
    ``docs``. A NULL text counts as an empty one, which has one term. Rows
    without an id come before all others, and the row after the last is the
    first that has one. Rows with the same id stand in the order of their texts.
    Other columns are ignored; an empty table gives an empty result.

    Documents are dealt out once, by blocks of neighbouring ids. The first
    document of a block is also a guest of the block before, so no block needs
    another one.
    """
    rows = docs.select(
        F.col(id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    starts = _bounds(rows, block_bytes, max_blocks)
    count = max(1, len(starts))
    if starts:
        bounds = F.split(F.lit(",".join(map(str, starts))), ",").cast("array<bigint>")
        reached = F.coalesce(_block(F.col("doc_id"), bounds, len(starts)), F.lit(0))
        rows = rows.withColumn("_reached", reached)
        own = F.greatest(F.col("_reached") - 1, F.lit(0))
        begins = F.col("doc_id") == F.get(bounds, own)
        before = F.pmod(own - 1, F.lit(count))
        places = F.when(begins, F.array(F.struct(own.alias("b"), F.lit(0).alias("g")), F.struct(before.alias("b"), F.lit(1).alias("g"))))
        places = F.coalesce(places, F.array(F.struct(own.alias("b"), F.lit(0).alias("g"))))
        rows = rows.select("doc_id", "text", F.explode(places).alias("_at"))
        rows = rows.select(
            "doc_id", "text", F.col("_at.b").alias("_block"), F.col("_at.g").alias("_guest")
        )
    else:
        rows = rows.select("*", F.lit(0).alias("_block"), F.lit(0).alias("_guest"))
    rows = rows.repartition(count, "_block")

    order = Window.partitionBy("_block").orderBy("_guest", F.asc_nulls_first("doc_id"), "text")
    rows = rows.select(
        "_block", "_guest", "doc_id", "text",
        F.row_number().over(order).alias("_row"),
        F.coalesce(F.lead("text").over(order), F.lit("")).alias("_next"),
        F.length("text").cast("bigint").alias("n_chars"),
    )
    kept = (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), kept),
        F.substring(F.col("_next"), F.lit(1), F.floor(F.col("n_chars") / 4).cast("int")),
    )
    rows = rows.withColumn("_edited", edited)
    rows = with_samples(rows, {"_own_samples": "text", "_edited_samples": "_edited"}, bins)
    rows = rows.select(
        "_block", "_guest", "_row", "doc_id", "n_chars",
        F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        "_own_samples", "_edited_samples",
    )
    after = Window.partitionBy("_block").orderBy("_row")
    rows = rows.withColumn("_next_samples", F.lead("_own_samples").over(after))
    return rows.where(F.col("_guest") == 0).select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint(F.col("_own_samples")).alias("fingerprint"),
        fingerprint(F.col("_edited_samples")).alias("edited_fingerprint"),
        likeness(F.col("_own_samples"), F.col("_edited_samples")).alias("near_edited"),
        F.coalesce(
            likeness(F.col("_own_samples"), F.col("_next_samples")), F.lit(0.0)
        ).alias("near_next"),
    )
