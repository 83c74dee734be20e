"""Prefix tries of conversations against brute force."""
import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridlore.llm import ordered, prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
    members, leaves, saved, born = defaultdict(list), defaultdict(int), defaultdict(int), defaultdict(int)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    for k in members:
        if k:
            born[k[:-1]] += 1
    for k, v in members.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(v) - 1) * len(k[-1][1].encode()) if k else 0
            leaves[k[:d]] += born[k] == 0
    return {
        (min(v), len(k)): (
            min(members[k[:-1]]) if k else None, len(v), born[k], leaves[k], saved[k],
            hashlib.sha256(",".join(str(c) for c in sorted(v) if built[c] == k).encode()).hexdigest(),
        )
        for k, v in members.items()
    }


def found(table):
    rows = table.collect()
    result = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(result) == len(rows)
    return result


def conversations(seed, n, many=()):
    own, rows = random.Random(seed), []
    for c in range(n):
        for t in range(own.choice([0, 1, 3, 8, 12, *many])):
            text = own.choice(["hi", "so", "é\n", "", None]) if t < 3 else own.choice("abc") * own.randint(0, 5)
            rows.append((c * own.choice([1, 1, 3]) % n, t, own.choice(["user", "bot", None]), text))
    return rows


@pytest.fixture
def uncoalesced(spark):
    """Slices as on large data: none are put together."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed,n,many,rulers", [(1, 40, (), 3), (3, 12, (150, 260), 64)])
def test_nodes_are_those_of_brute_force(spark, uncoalesced, seed, n, many, rulers):
    rows = conversations(seed, n, many)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(prefix_trie.prefix_trie(table, rulers=rulers)) == brute(rows)


def test_one_conversation_and_one_parent_may_hold_most_rows(spark, uncoalesced):
    rows = [(5, None, "user", "same")] * 200 + [(5, 1, "user", str(i)) for i in range(80)]
    rows += [(i, 0, "user", f"t{i}") for i in range(6, 600)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(8)
    assert found(prefix_trie.prefix_trie(table)) == brute(rows)


@pytest.mark.parametrize("rulers", [1, 2, 10**6])
def test_list_ranks(spark, rulers):
    order = random.Random(5).sample(range(1000), 300)
    links = [(a, b) for a, b in zip(order, order[1:] + [None])] + [(5000, None)]
    ranks = prefix_trie.list_ranks(spark.createDataFrame(links, "arc bigint, next bigint"), rulers).collect()
    assert {r.arc: r["rank"] for r in ranks} == {a: 299 - i for i, a in enumerate(order)} | {5000: 0}


def test_odd_rows(spark):
    rows = [
        (None, 1, "user", "no id"), (0, None, None, None), (0, None, None, None), (1, 5, "a", ""), (1, 5, "a", ""),
        (-3, 2, "user", "neg"), (-5, 1, "user", "base"), (7, 1, "user", "x" * 200_000), (8, 1, "us", "er|x"), (9, 1, "user", "|x"),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    for extra in ("node", "parent", "depth", "slice", "pos", "k1", "_next", "copy"):
        table = table.withColumn(extra, F.lit("x"))
    assert found(prefix_trie.prefix_trie(table)) == brute(rows)
    assert prefix_trie.prefix_trie(table.where("false")).count() == 0


def test_running_totals_over_cut_groups(spark, uncoalesced):
    rows = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("v"))
    totals = {"n": (F.sum, F.lit(1)), "s": (F.sum, F.col("v")), "x": (F.bit_xor, F.col("v"))}
    cut = ordered.sliced(rows, ["g", "o"])
    assert cut.select("slice").distinct().count() > 2
    for r in ordered.running(cut, ["g"], ["o"], totals).collect():
        before = list(range(r.g, r.o + 1, 2))
        xor = 0
        for i in before:
            xor ^= i % 7
        assert (r.n, r.s, r.x) == (len(before), sum(i % 7 for i in before), xor)


def test_prefix_sums_over_blocks(spark):
    rows = spark.range(200_000).select("id", (F.col("id") % 5).alias("v"))
    wrong = ordered.prefix_sums(rows, "id", ["v"]).where(
        F.col("sum_v") != F.floor(F.col("id") / 5) * 10 + F.col("id") % 5 * (F.col("id") % 5 + 1) / 2
    )
    assert wrong.count() == 0
