"""Roles in raw transcripts by a hidden Markov model, and canonical turns.

A line's hidden state is a role and whether the line begins a turn. What is seen
of a line are its speaker marker, if any, whether a blank line stands before it,
its length, its last character, and whether it is the first. Transitions and
observations are counted in labelled conversations. Viterbi's algorithm finds
the likeliest states of all lines of a transcript at once, so lines without a
marker get their role from their neighbours.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("system", "user", "assistant")
STATES = tuple((role, begins) for role in ROLES for begins in (True, False))

# Words that mark a speaker, by role.
MARKERS = {
    "system": ("system", "instructions", "context"),
    "user": ("user", "human", "question", "q", "customer", "me"),
    "assistant": ("assistant", "ai", "bot", "answer", "a", "agent", "model"),
}
_ROLE_OF = {word: role for role, words in MARKERS.items() for word in words}
_MARKER = re.compile(r"\s*(?:#+\s*|\*\*|<\|?|\[)?\s*([A-Za-z]{1,12})\s*(?:\*\*)?\s*(?::|\|?>|\])\s?(?:\*\*)?")


def marker(line: str) -> tuple[str, str]:
    """The role that a line's marker names, or ``none``, and the line without it."""
    found = _MARKER.match(line)
    role = found and _ROLE_OF.get(found[1].lower())
    return (role, line[found.end() :]) if role else ("none", line)


def observe(lines: list[str]) -> list[tuple[tuple[str, ...], str, bool]]:
    """What is seen of each line: the values of all features, its text, and whether it is blank."""
    seen, gap = [], False
    for i, line in enumerate(lines):
        role, rest = marker(line)
        blank = not line.strip()
        last = rest.rstrip()[-1:]
        values = (
            f"marker={role}",
            f"gap={gap}",
            f"length={min(5, len(rest).bit_length() // 2)}",
            f"last={'?' if last == '?' else ':' if last == ':' else 'other'}",
            f"first={i == 0}",
            f"blank={blank}",
        )
        seen.append((values, rest, blank))
        gap = blank
    return seen


@dataclass(frozen=True)
class Model:
    """Logarithms of probabilities: of first states, of transitions, and of what is seen."""

    first: np.ndarray
    following: np.ndarray
    seen: dict[str, np.ndarray]
    unseen: np.ndarray

    def states(self, observed: list[tuple[str, ...]], later_part: bool = False) -> list[int]:
        """The likeliest states of lines. A later part of a transcript may begin anywhere."""
        if not observed:
            return []
        score, back = None, []
        for values in observed:
            emitted = sum(self.seen.get(value, self.unseen) for value in values)
            if score is None:
                score = emitted + (0.0 if later_part else self.first)
            else:
                through = score[:, None] + self.following
                best = through.argmax(axis=0)
                back.append(best)
                score = through[best, np.arange(len(STATES))] + emitted
        path = [int(score.argmax())]
        for best in reversed(back):
            path.append(int(best[path[-1]]))
        return path[::-1]

    def turns(self, text: str, later_part: bool = False) -> list[tuple[str, str]]:
        """The turns of a raw transcript, as role and text."""
        lines = text.split("\n")
        observed = observe(lines)
        states = self.states([values for values, _, _ in observed], later_part)
        turns: list[tuple[str, list[str]]] = []
        for line, state, (_, rest, _) in zip(lines, states, observed):
            role, begins = STATES[state]
            if begins or not turns or turns[-1][0] != role:
                turns.append((role, [rest]))
            else:
                turns[-1][1].append(line)
        return [(role, "\n".join(own).strip("\n")) for role, own in turns]


def render(turns: list[tuple[str, str]]) -> str:
    """Turns in the canonical form."""
    return "".join(f"<|{role}|>\n{text}\n<|end|>\n" for role, text in turns)


def _known(role: Column) -> Column:
    return F.when(role.isin(*ROLES), role).otherwise("user")


def raw_transcripts(
    conversations: DataFrame,
    turns_a_part: int = 512,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``(conv_id, part, turns, text)``: conversations as transcripts of four styles.

    Three styles mark speakers by different words, the fourth only by a blank
    line between turns; a hash of the id decides. A conversation of more than
    ``turns_a_part`` turns comes in parts, so no row grows without bound. NULL
    texts are empty; other roles and NULL are read as ``user``; repeated rows
    count once; a NULL turn stands first.
    """
    rows = conversations.select(
        F.col(id).alias("conv_id"),
        F.col(turn).cast("bigint").alias("_turn"),
        _known(F.col(role)).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).distinct()
    part = F.coalesce(F.floor(F.col("_turn") / turns_a_part), F.lit(0)).cast("bigint")
    listed = rows.groupBy("conv_id", part.alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("_turn", "role", "text"))).alias("_all")
    )
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    names = F.create_map(
        *[
            F.lit(x)
            for style, words in enumerate((("System", "User", "Assistant"), ("Context", "Human", "AI"), ("Instructions", "Q", "A")))
            for role, word in zip(ROLES, words)
            for x in (f"{style}{role}", f"{word}: ")
        ]
    )
    listed = listed.select("conv_id", "part", "_all", style.cast("string").alias("_style"))

    def spoken(x: Column) -> Column:
        return F.concat(F.coalesce(F.try_element_at(names, F.concat("_style", x["role"])), F.lit("")), x["text"])

    lines = F.transform("_all", spoken)
    return listed.select(
        "conv_id", "part",
        F.transform("_all", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"),
        F.when(F.col("_style") == "3", F.array_join(lines, "\n\n")).otherwise(F.array_join(lines, "\n")).alias("text"),
        (F.col("_style") != "3").alias("marked"),
    )


def held_out(id: Column) -> Column:
    """A fifth of the conversations, which the model never learns from."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(transcripts: DataFrame) -> Model:
    """Count states and observations in ``(turns, text, part)`` rows whose roles are known.

    Each task adds up its own counts. The table of all counts has a row for each
    pair of states and each state and feature value, some hundreds at most.
    Without any row, all states are equally likely.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(4))
            for turns, text, part, marked in zip(*columns):
                states = []
                for i, turn in enumerate(turns):
                    begin = STATES.index((turn["role"], True))
                    states += [begin] + [begin + 1] * turn["text"].count("\n")
                    if not marked and i + 1 < len(turns):
                        states.append(begin + 1)
                before = None
                for state, (values, _, _) in zip(states, observe(text.split("\n"))):
                    if before is not None:
                        counts["follows", str(before), state] += 1
                    elif not part:
                        counts["first", "", state] += 1
                    for value in values:
                        counts["seen", value, state] += 1
                    before = state
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([x[0] for x in keys], pa.string()), pa.array([x[1] for x in keys], pa.string()),
                pa.array([x[2] for x in keys], pa.int64()), pa.array([counts[x] for x in keys], pa.int64()),
            ],
            ["kind", "of", "state", "n"],
        )

    counted = transcripts.select("turns", "text", "part", "marked").mapInArrow(
        count, "kind string, of string, state bigint, n bigint"
    )
    rows = counted.groupBy("kind", "of", "state").agg(F.sum("n").alias("n")).collect()
    size = len(STATES)
    first, following, seen = np.full(size, 0.5), np.full((size, size), 0.5), {}
    for row in rows:
        if row["kind"] == "first":
            first[row["state"]] += row["n"]
        elif row["kind"] == "follows":
            following[int(row["of"]), row["state"]] += row["n"]
        else:
            seen.setdefault(row["of"], np.full(size, 0.5))[row["state"]] += row["n"]
    totals = np.full(size, 1.0)
    for value, counts in seen.items():
        if value.startswith("first="):
            totals += counts
    return Model(
        np.log(first / first.sum()),
        np.log(following / following.sum(axis=1, keepdims=True)),
        {value: np.log(counts / totals) for value, counts in seen.items()},
        np.log(0.5 / totals),
    )


def parse(transcripts: DataFrame, model: Model) -> DataFrame:
    """``transcripts`` with their recovered ``parsed`` turns and the ``rendered`` text.

    A NULL transcript is read as an empty one, which is one empty turn. Columns
    of the same names are replaced, all others stay.
    """
    kind = "struct<parsed: array<struct<role: string, text: string>>, rendered: string>"

    @F.arrow_udf(kind)
    def recover(texts: pa.Array, parts: pa.Array) -> pa.Array:
        rows = []
        for text, part in zip(texts.to_pylist(), parts.to_pylist()):
            turns = model.turns(text or "", bool(part))
            rows.append({"parsed": [{"role": r, "text": t} for r, t in turns], "rendered": render(turns)})
        of = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        return pa.array(rows, pa.struct([("parsed", of), ("rendered", pa.string())]))

    found = transcripts.withColumn("_found", recover(F.col("text"), F.col("part")))
    return found.withColumns({"parsed": F.col("_found.parsed"), "rendered": F.col("_found.rendered")}).drop("_found")


def format_chats(conversations: DataFrame, turns_a_part: int = 512, id: str = "conv_id") -> DataFrame:
    """``(conv_id, part, held_out, n_turns, n_parsed, n_right, rendered)`` of all conversations.

    Conversations are written as raw transcripts, from which their turns are
    recovered with a model of those not held out. ``n_right`` counts the turns
    whose role and text are recovered at their place. An empty table gives an
    empty result.
    """
    transcripts = raw_transcripts(conversations, turns_a_part, id)
    model = train(transcripts.where(~held_out(F.col("conv_id"))))
    parsed = parse(transcripts, model)
    right = F.filter(
        F.zip_with(
            "turns", "parsed",
            lambda a, b: (a["role"] == b["role"]) & (F.trim(a["text"]) == F.trim(b["text"])),
        ),
        lambda same: same,
    )
    return parsed.select(
        "conv_id", "part", held_out(F.col("conv_id")).alias("held_out"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.size("parsed").cast("bigint").alias("n_parsed"),
        F.size(right).cast("bigint").alias("n_right"), "rendered",
    )
