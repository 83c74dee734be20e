"""The prefix trie of conversations, measured by an Euler tour.

A node is a distinct sequence of first turns. It is known by a 128-bit key: the
exclusive or of hashes of each turn with its place, a running total of which
gives the keys of all nodes along a conversation. Each node gets an arc that
enters it and one that leaves it. An arc is followed by the one that enters the
first child or the next sibling, or leaves the node or its parent, which makes
the tour a linked list. The list is ranked by rulers: arcs jump over each other
until they reach one of the rulers, a sample of the arcs, then the rulers over
each other. At the arcs' positions, prefix sums give what lies in a subtree:
the sum where the tour leaves the node less the sum before it enters.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlore.llm.ordered import prefix_sums, running, sliced
from gridlore.operators.skew import Limits, lookup
from gridlore.sources.shared import materialize, settled

BASES, MOST_SHARED = 5, 9
RULERS = 64  # one arc of so many is a ruler
_HOT = Limits(min_rows=10_000)


def _turn_keys(depth: Column, role: Column, text: Column) -> list[Column]:
    """128 bits of a turn at its place; lengths tell the fields apart."""
    whole = F.concat_ws(
        "|", depth.cast("string"), F.octet_length(role).cast("string"), role, text
    )
    digest = F.sha2(whole, 256)
    return [
        F.xxhash64(F.lit(i), digest) if i else F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
        for i in (0, 1)
    ]


def numbered(turns: DataFrame, id: str = "conv_id") -> DataFrame:
    """``(conv_id, pos, role, text)``: turns numbered from 1 in each conversation.

    Turns of the same number are ordered by role and text; NULL comes first and
    roles and texts of NULL are empty. Rows without a conversation are dropped.
    """
    rows = turns.where(F.col(id).isNotNull()).select(
        F.col(id).cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Equal rows are told apart only so that they can be dealt to several tasks.
    rows = rows.withColumn("copy", F.xxhash64(F.monotonically_increasing_id()))
    order = ["conv_id", "turn", "role", "text", "copy"]
    rows = running(sliced(rows, order, "turns"), ["conv_id"], order[1:], {"pos": (F.sum, F.lit(1))})
    return materialize(rows.select("conv_id", "pos", "role", "text"), "numbered")


def shared_turns(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its five."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(MOST_SHARED))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, n_turns)`` and ``(conv_id, pos, role, text)`` of conversations that share first turns.

    ``turns`` are as ``numbered`` gives them. Every conversation gets the first
    turns of the conversation whose id is the next lower multiple of five, and
    goes on with its own turns after as many.
    """
    sizes = materialize(turns.groupBy("conv_id").agg(F.max("pos").alias("own")), "sizes")
    convs = sizes.select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % BASES).alias("base"),
        shared_turns(F.col("conv_id")).alias("shared"),
    )
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("_has"))
    convs = convs.join(bases, "base", "left").select(
        "conv_id", "base", "shared", "own",
        F.least(F.coalesce("_has", F.lit(0)), "shared").alias("taken"),
    )
    left_over = F.greatest(F.col("own") - F.col("shared"), F.lit(0))
    convs = materialize(convs.withColumn("n_turns", F.col("taken") + left_over), "conversations")
    # At most eight turns of a base go to at most five conversations each.
    first = turns.where(F.col("pos") < MOST_SHARED).withColumnRenamed("conv_id", "base")
    lent = first.join(convs.select("base", "conv_id", "taken"), "base").where("pos <= taken")
    moves = convs.select(F.col("conv_id"), "shared", "taken")
    kept = lookup(turns, moves, ["conv_id"], _HOT).where("pos > shared")
    kept = kept.withColumn("pos", F.col("pos") - F.col("shared") + F.col("taken"))
    columns = ["conv_id", "pos", "role", "text"]
    return convs.select("conv_id", "n_turns"), lent.select(*columns).unionByName(kept.select(*columns))


def _members(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """``(conv_id, depth, k1, k2, p1, p2, bytes, ends)``: each conversation at each of its nodes, written."""
    own = _turn_keys(F.col("pos"), F.col("role"), F.col("text"))
    keyed = turns.select(
        "conv_id", F.col("pos").cast("bigint").alias("depth"), own[0].alias("t1"), own[1].alias("t2"),
        F.octet_length("text").cast("bigint").alias("bytes"),
    )
    roots = convs.select("conv_id", *[F.lit(0).cast("bigint").alias(x) for x in ("depth", "t1", "t2", "bytes")])
    order = ["conv_id", "depth"]
    steps = sliced(keyed.unionByName(roots), order, "steps")
    steps = running(
        steps, ["conv_id"], ["depth"], {"k1": (F.bit_xor, F.col("t1")), "k2": (F.bit_xor, F.col("t2"))}
    )
    steps = lookup(steps, convs, ["conv_id"], _HOT)
    return materialize(
        steps.select(
            "conv_id", "depth", "k1", "k2",
            F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("t2")).alias("p2"),
            "bytes", (F.col("depth") == F.col("n_turns")).alias("ends"),
        ),
        "members",
    )


def tour_arcs(children: DataFrame) -> DataFrame:
    """``(arc, next)`` of the Euler tour of ``(node, parent)`` rows; roots have no parent.

    Arc ``2 * node`` enters a node, ``2 * node + 1`` leaves it. The tour of a
    root ends with NULL. Children follow each other by their numbers.
    """
    below = sliced(children.where(F.col("parent").isNotNull()), ["parent", "node"], "children")
    siblings = Window.partitionBy("slice", "parent").orderBy("node")
    firsts = below.groupBy("parent", "slice").agg(F.min("node").alias("_first"))
    after = Window.partitionBy("parent").orderBy("slice")
    # A parent whose children were cut has a row for each slice.
    firsts = firsts.select(
        "parent", "slice", F.lead("_first").over(after).alias("_following"),
        F.count("*").over(Window.partitionBy("parent")).alias("_cuts"),
    ).where("_cuts > 1").select(F.col("parent").alias("_of"), F.col("slice").alias("_in"), "_following")
    linked = below.select("node", "parent", "slice", F.lead("node").over(siblings).alias("_next"))
    on = (F.col("parent") == F.col("_of")) & (F.col("slice") == F.col("_in"))
    linked = linked.join(firsts, on, "left").select(
        "node", "parent", F.coalesce("_next", "_following").alias("_next")
    )
    leaving = linked.select(
        (F.col("node") * 2 + 1).alias("arc"),
        F.coalesce(F.col("_next") * 2, F.col("parent") * 2 + 1).alias("next"),
    )
    ends = children.where(F.col("parent").isNull()).select(
        (F.col("node") * 2 + 1).alias("arc"), F.lit(None).cast("bigint").alias("next")
    )
    oldest = below.groupBy(F.col("parent").alias("node")).agg(F.min("node").alias("_child"))
    entering = children.select("node").join(oldest, "node", "left").select(
        (F.col("node") * 2).alias("arc"),
        F.coalesce(F.col("_child") * 2, F.col("node") * 2 + 1).alias("next"),
    )
    return leaving.unionByName(ends).unionByName(entering)


def _jumped(links: DataFrame, stops: Column | None) -> DataFrame:
    """``(arc, next, steps)`` with every arc pointing to a stop or to NULL; links that reach none go on."""
    spark = links.sparkSession
    halt = F.col("next").isNull() if stops is None else F.col("next").isNull() | stops
    current = materialize(links, "arcs")
    while not current.where(~halt).isEmpty():

        def step(table: DataFrame = current) -> DataFrame:
            further = table.select(
                F.col("arc").alias("_arc"), F.col("next").alias("_next"), F.col("steps").alias("_steps")
            )
            moving = table.where(~halt).join(further, F.col("next") == F.col("_arc"))
            moving = moving.select("arc", F.col("_next").alias("next"), (F.col("steps") + F.col("_steps")).alias("steps"))
            return table.where(halt).unionByName(moving)

        current = settled(spark, step, "arcs")
    return current


def list_ranks(links: DataFrame, rulers: int = RULERS) -> DataFrame:
    """``(arc, rank)``: how many arcs come after each in the lists of ``(arc, next)`` rows."""
    def ruler(x: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(11), x), F.lit(rulers)) == 0

    one = links.select("arc", "next", F.when(F.col("next").isNull(), 0).otherwise(1).cast("bigint").alias("steps"))
    to_ruler = _jumped(one, ruler("next"))
    ranked = _jumped(to_ruler.where(ruler("arc")), None).select(
        F.col("arc").alias("_arc"), F.col("steps").alias("_rest")
    )
    # A ruler ends a stretch of a few dozen arcs, so it is looked up by as many.
    joined = to_ruler.join(ranked, F.col("next") == F.col("_arc"), "left")
    return joined.select("arc", (F.col("steps") + F.coalesce("_rest", F.lit(0))).alias("rank"))


def subtree_sums(children: DataFrame, values: list[str], rulers: int = RULERS) -> DataFrame:
    """``(node, sum_<value>...)``: sums over subtrees of ``(node, parent, value...)`` with one root.

    The top of a subtree belongs to it.
    """
    nodes = children.select("node", *values)
    ranks = list_ranks(tour_arcs(children.select("node", "parent")), rulers)
    arcs = ranks.select(
        F.shiftright("arc", 1).alias("node"), (F.col("arc") % 2 == 1).alias("leaves"), F.col("rank").alias("pos")
    )
    # Counted from the tour's end, a node is left before it is entered.
    placed = arcs.join(nodes, "node").select(
        "node", "leaves", "pos", *[F.when(F.col("leaves"), 0).otherwise(F.col(x)).alias(x) for x in values]
    )
    summed = prefix_sums(placed, "pos", values)
    sign = F.when(F.col("leaves"), -1).otherwise(1)
    return summed.groupBy("node").agg(*[F.sum(sign * F.col(f"sum_{x}")).alias(f"sum_{x}") for x in values])


def _end_digests(ends: DataFrame) -> DataFrame:
    """``(node, ends_sha256)`` of ``(node, conv_id)``: the digest of the ids, joined in order.

    The ids pass through the digest in a stream; none are collected.
    """
    dealt = ends.repartition("node").sortWithinPartitions("node", "conv_id")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())],
                ["node", "ends_sha256"],
            )

        current, state, done = None, None, []
        for batch in batches:
            nodes, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(nodes):
                to = at
                while to < len(nodes) and nodes[to] == nodes[at]:
                    to += 1
                ids = ",".join(map(str, convs[at:to])).encode()
                if nodes[at] == current:
                    state.update(b"," + ids)
                else:
                    if state is not None:
                        done.append((current, state.hexdigest()))
                    current, state = nodes[at], hashlib.sha256(ids)
                at = to
            yield out(done)
            done = []
        yield out([(current, state.hexdigest())] if state is not None else [])

    return dealt.mapInArrow(digest, "node bigint, ends_sha256 string")


def prefix_trie(conversations: DataFrame, rebuild: bool = True, rulers: int = RULERS) -> DataFrame:
    """The nodes of the trie of ``(conv_id, turn, role, text)`` rows, one row each.

    ``conv_id`` is the smallest member's, ``parent_conv_id`` the parent's;
    ``depth`` the number of turns; ``n_convs`` the members; ``n_children``;
    ``n_leaves`` the childless nodes of the subtree, the node among them;
    ``saved_tokens`` the bytes of last texts that the subtree's nodes keep from
    being repeated; ``ends_sha256`` the digest of the ids of members that end at
    the node. With ``rebuild`` conversations first get the turns they share, see
    ``rebuilt``.

    Turns are ordered by ``turn``, NULL first, then by role and text, so
    repeated turns are turns like others. NULL roles and texts are empty. Ids are
    whole numbers; the remainder of a negative one is negative, as in SQL. Rows
    without a conversation id are ignored, and so are other columns. Without
    conversations the result is empty.
    """
    spark = conversations.sparkSession

    def nodes_and_ends() -> DataFrame:
        turns = numbered(conversations)
        if rebuild:
            convs, turns = rebuilt(turns)
        else:
            convs = turns.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))
        members = _members(convs, turns)
        nodes = members.groupBy("depth", "k1", "k2").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
            F.max("bytes").alias("bytes"), F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        )
        nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
        parents = nodes.select(
            (F.col("depth") + 1).alias("_d"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
            F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
        ).withColumnRenamed("_d", "depth")
        placed = lookup(nodes, materialize(parents, "parents"), ["depth", "p1", "p2"], _HOT)
        placed = materialize(placed, "placed")
        fertile = placed.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
        placed = placed.join(fertile.where(F.col("node").isNotNull()), "node", "left").select(
            "node", "parent", "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        )
        placed = materialize(placed.withColumn("leaf", (F.col("n_children") == 0).cast("bigint")), "trie")
        sums = subtree_sums(placed.select("node", "parent", "leaf", "saved"), ["leaf", "saved"], rulers)
        ends = members.where("ends").select("depth", "k1", "k2", F.col("conv_id").alias("_ending"))
        names = materialize(nodes.select("depth", "k1", "k2", "node"), "names")
        ends = lookup(ends, names, ["depth", "k1", "k2"], _HOT).select("node", F.col("_ending").alias("conv_id"))
        return placed.join(sums, "node").join(_end_digests(ends), "node", "left")

    found = settled(spark, nodes_and_ends, "trie")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.col("sum_leaf").alias("n_leaves"), F.col("sum_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
