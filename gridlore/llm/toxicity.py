"""Toxicity scores by a learned lexicon, Levenshtein automata and context windows.

The lexicon is learned from labelled texts: words, and beginnings of words
(``stem*``), that labels show to stand in toxic texts only. The Levenshtein
automata of all its terms are run as one, intersected with the trie of the
terms: a state is the set of trie nodes that a word may have reached and the
edits spent on each. States are made when a word first needs them, so a word
costs a step for each letter until no term can be reached.

Each hit is judged in its window: hits of the neighbourhood add up, and one
inside quotation marks or a quoted line counts for half, as it may report abuse
instead of being it. A logistic regression makes a score of the sums.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlore.llm.codec import let_go

_WORD = re.compile(r"\w+")
_QUOTES = ("«»", "»«", "“”", "„“", "‹›")
STEMS = range(4, 8)
WINDOW = 10


def edits_allowed(term: str) -> int:
    """Short terms and beginnings of words must be spelled as they are."""
    return 0 if term.endswith("*") or len(term) < 5 else 1


class Automaton:
    """All terms' Levenshtein automata as one, made as far as words have needed it."""

    def __init__(self, terms: dict[str, float]):
        self.terms = list(terms)
        self.weights = list(terms.values())
        self.next: list[dict[str, int]] = [{}]
        self.word_at: dict[int, int] = {}
        self.stem_at: dict[int, int] = {}
        for number, term in enumerate(self.terms):
            node = 0
            for letter in term.removesuffix("*"):
                if letter not in self.next[node]:
                    self.next.append({})
                    self.next[node][letter] = len(self.next) - 1
                node = self.next[node][letter]
            (self.stem_at if term.endswith("*") else self.word_at)[node] = number
        self.most = max(map(edits_allowed, self.terms), default=0)
        self.forget()

    def forget(self) -> None:
        """Drop all states but the first."""
        self.states: list[dict[int, int]] = []
        self.number: dict[frozenset, int] = {}
        self.steps: list[dict[str, int]] = []
        self.begin = self._state(self._closed({0: 0}))

    def _closed(self, reached: dict[int, int]) -> dict[int, int]:
        """Also where letters of a term are left out."""
        queue = list(reached.items())
        for node, spent in queue:
            if spent < self.most:
                for child in self.next[node].values():
                    if reached.get(child, self.most + 1) > spent + 1:
                        reached[child] = spent + 1
                        queue.append((child, spent + 1))
        return reached

    def _state(self, reached: dict[int, int]) -> int:
        key = frozenset(reached.items())
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(reached)
            self.steps.append({})
        return self.number[key]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def add(node: int, spent: int) -> None:
            if spent <= self.most and reached.get(node, self.most + 1) > spent:
                reached[node] = spent

        for node, spent in self.states[state].items():
            for own, child in self.next[node].items():
                add(child, spent + (own != letter))
            add(node, spent + 1)
        found = self._state(self._closed(reached)) if reached else -1
        self.steps[state][letter] = found
        return found

    def find(self, word: str) -> tuple[int, int] | None:
        """The term for a word and the edits between them: least edits, then most weight."""
        state, best = self.begin, None
        for letter in word:
            following = self.steps[state].get(letter)
            state = self._step(state, letter) if following is None else following
            if state < 0:
                return best
            for node, spent in self.states[state].items():
                if not spent and node in self.stem_at:
                    best = self._better(best, self.stem_at[node], 0)
        for node, spent in self.states[state].items():
            number = self.word_at.get(node)
            if number is not None and spent <= edits_allowed(self.terms[number]):
                best = self._better(best, number, spent)
        return best

    def _better(self, best: tuple[int, int] | None, number: int, spent: int) -> tuple[int, int]:
        if best is None or (spent, -self.weights[number]) < (best[1], -self.weights[best[0]]):
            return number, spent
        return best


class _Words(dict):
    """What the automaton says of words, for a bounded number of words and states."""

    def __init__(self, automaton: Automaton, memory: int = 100_000):
        self.automaton, self.memory = automaton, memory

    def __missing__(self, word: str):
        if len(self) >= self.memory:
            self.clear()
        if len(self.automaton.states) >= self.memory:
            self.automaton.forget()
        found = self[word] = self.automaton.find(word)
        return found


FEATURES = ("exact", "misspelled", "window", "quoted", "density")


def _quoted(text: str, start: int, end: int) -> bool:
    """Does the place lie between quotation marks of its line, or in a quoted line?"""
    line = text.rfind("\n", 0, start) + 1
    stop = text.find("\n", end)
    before, after = text[line:start], text[end : stop if stop >= 0 else len(text)]
    if before.lstrip().startswith(">"):
        return True
    if before.count('"') % 2 and '"' in after:
        return True
    return any(before.rfind(a) > before.rfind(b) and b in after for a, b in _QUOTES)


def features(text: str, words: _Words) -> list[float]:
    """The sums over a text's hits, in the order of ``FEATURES``."""
    lowered = text.lower()
    tokens = _WORD.findall(lowered)
    hits = [(i, found) for i, found in enumerate(map(words.__getitem__, tokens)) if found]
    if not hits:
        return [0.0] * len(FEATURES)
    weights = words.automaton.weights
    wanted, spans = {i for i, _ in hits}, {}
    for i, match in enumerate(_WORD.finditer(lowered)):
        if i in wanted:
            spans[i] = match.span()
    exact = misspelled = quoted = 0.0
    values = []
    for i, (term, edits) in hits:
        inside = _quoted(lowered, *spans[i])
        value = weights[term] * (0.5 if inside else 1.0) * (0.7 if edits else 1.0)
        values.append((i, value))
        exact += value * (not edits)
        misspelled += value * bool(edits)
        quoted += weights[term] * inside
    window, low, total = 0.0, 0, 0.0
    for high, (i, value) in enumerate(values):
        total += value
        while values[low][0] < i - WINDOW:
            total -= values[low][1]
            low += 1
        window = max(window, total)
    return [
        np.log1p(exact), np.log1p(misspelled), np.log1p(window), np.log1p(quoted),
        np.log1p(100.0 * len(hits) / len(tokens)),
    ]


@dataclass(frozen=True)
class Model:
    """A lexicon with the terms' weights, and the regression on ``FEATURES``."""

    terms: dict[str, float]
    coefficients: tuple[float, ...]
    intercept: float

    def score(self, text: Column) -> Column:
        """How likely label 1 is, between 0 and 1; a NULL text counts as an empty one."""
        coefficients, intercept = np.array(self.coefficients), self.intercept

        def scores(values: pd.Series, words: _Words) -> pd.Series:
            sums = np.array([features(x, words) for x in values]).reshape(-1, len(FEATURES))
            return pd.Series(1.0 / (1.0 + np.exp(-(sums @ coefficients + intercept))))

        return _over(text, self.terms, scores, "double")


def _over(text: Column, terms: dict[str, float], use, kind: str) -> Column:
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        words = _Words(Automaton(terms))
        for batch in batches:
            yield use(batch, words)

    # The hints above are texts when this runs, so the kind of function is named here.
    each.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(each, kind)(F.coalesce(text, F.lit("")))


def held_out(id: Column) -> Column:
    """Rows that labels are never learned from: a fifth, by the id."""
    return F.coalesce(F.crc32(id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _terms(text: Column) -> Column:
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"))
    words = F.filter(words, lambda x: F.length(x) >= 3)
    stems = [
        F.transform(
            F.filter(words, lambda x: F.length(x) > size),
            lambda x: F.concat(F.substring(x, 1, size), F.lit("*")),
        )
        for size in STEMS
    ]
    return F.array_distinct(F.concat(words, *stems))


def learn_lexicon(labelled: DataFrame, max_terms: int = 2000, least: int = 4) -> dict[str, float]:
    """Terms of ``(text, toxic)`` rows that tell toxic texts, with their weights.

    Counted are texts, not occurrences, and of copies and near copies one: texts
    whose least triple of words, by hash, is the same. A term must be in ``least`` toxic texts,
    at least four times as likely there as in others, and too rarely elsewhere to
    be chance, given how many terms are looked at. A longer term is taken beside
    its beginning only if it tells more, or if it is a word that may be misspelled:
    its beginning must be spelled as it is. Such words don't count as ``max_terms``.
    """
    hashed = F.transform(F.split(F.lower("text"), r"\s+"), lambda x: F.xxhash64(x))
    labelled = labelled.select("toxic", "text", hashed.alias("_w"))
    pairs = F.zip_with("_w", F.slice("_w", 2, 2**31 - 1), lambda a, b: F.xxhash64(a, b))
    labelled = labelled.select("toxic", "text", "_w", pairs.alias("_p"))
    triples = F.zip_with("_p", F.slice("_w", 3, 2**31 - 1), lambda a, b: F.xxhash64(a, b))
    labelled = labelled.select("toxic", "text", F.array_min(triples).alias("_least"))
    labelled = labelled.dropDuplicates(["toxic", "_least"])
    sizes = {row["toxic"]: row["n"] for row in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        return {}
    listed = labelled.select("toxic", F.explode(_terms(F.col("text"))).alias("term"))
    seen = listed.where("toxic = 1").groupBy("term").agg(F.count("*").alias("a"))
    seen = seen.where(F.col("a") >= least)
    # Bounded by the labelled sample.
    counts = listed.where("toxic = 0").join(F.broadcast(seen.select("term")), "term", "left_semi")
    counts = counts.groupBy("term").agg(F.count("*").alias("b"))
    seen = seen.join(counts, "term", "left").fillna(0, "b")
    rate = F.log((F.col("a") + 0.5) / (toxic + 1.0)) - F.log((F.col("b") + 0.5) / (other + 1.0))
    share = toxic / (toxic + other)
    total = F.col("a") + F.col("b")

    def part(count: Column, of: float) -> Column:
        return F.when(count > 0, count * F.log(count / (total * of))).otherwise(0.0)

    surprise = 2.0 * (part(F.col("a"), share) + part(F.col("b"), 1.0 - share))
    scored = seen.select("term", "a", "b", rate.alias("weight"), surprise.alias("surprise"))
    tried = scored.count()
    bound = 2.0 * np.log(max(2, tried)) + 8.0
    found = scored.where((F.col("weight") > float(np.log(4.0))) & (F.col("surprise") > float(bound)))
    rows = found.orderBy(F.desc("surprise"), F.desc(F.length("term")), "term").limit(4 * max_terms).collect()
    chosen: dict[str, float] = {}
    stems: dict[str, tuple[int, float]] = {}
    beside = 0
    for row in rows:
        word = row["term"].removesuffix("*")
        shorter = [stems[word[:size]][1] for size in STEMS if word[:size] in stems]
        covered = bool(shorter) and row["weight"] <= max(shorter) + 1.0
        # A shorter beginning that says no more than a longer one only catches more by chance.
        within = row["term"].endswith("*") and sum(
            n for stem, (n, _) in stems.items() if stem.startswith(word)
        ) >= 0.95 * row["a"]
        if covered and edits_allowed(row["term"]):
            beside += 1
        elif covered or within or len(chosen) - beside >= max_terms:
            continue
        chosen[row["term"]] = float(row["weight"])
        if row["term"].endswith("*"):
            stems[word] = row["a"], float(row["weight"])
    return chosen


def _regression(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    weights = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (y - p) - penalty * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        weights = weights + step
        if np.abs(step).max() < 1e-8:
            break
    return weights[:-1], float(weights[-1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = 20_000,
    max_terms: int = 2000,
    id: str = "doc_id",
    text: str = "text",
) -> Model:
    """Learn from at most ``max_rows`` labelled rows that are not held out.

    The rows are chosen by a hash of the id. Three quarters of them give a
    lexicon, with which the regression sees the others, so it sees hits as they
    come in texts the lexicon was not made from. The lexicon of the model is
    made from all of them. If the labels or one of the two classes
    are missing, every score is the share of label 1, or 0 without labels.
    """
    chosen = labels.where(F.col("toxic").isNotNull() & F.col(id).isNotNull() & ~held_out(F.col(id)))
    chosen = chosen.groupBy(F.col(id).alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)
    rows = docs.select(F.col(id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(chosen), "_id")
    part = F.pmod(F.xxhash64(F.lit(7), "_id"), F.lit(4))
    terms = learn_lexicon(rows.where(part != 0), max_terms)

    def sums(values: pd.Series, words: _Words) -> pd.Series:
        return pd.Series([features(x, words) for x in values])

    sample = rows.where(part == 0).select("toxic", _over(F.col("text"), terms, sums, "array<double>").alias("x"))
    found = sample.toPandas()  # at most max_rows small rows
    y = found["toxic"].to_numpy(float)
    if not terms or not 0 < y.sum() < len(y):
        share = chosen.agg(F.avg("toxic")).first()[0] or 0.0
        odds = np.log(max(share, 1e-9) / max(1.0 - share, 1e-9))
        return Model({}, (0.0,) * len(FEATURES), float(odds))
    weights, intercept = _regression(np.stack(found["x"].to_numpy()), y)
    return Model(learn_lexicon(rows, max_terms), tuple(map(float, weights)), intercept)


def score_documents(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row for each row of ``docs``.

    NULL and empty texts get the score of a text without hits. Rows with a NULL
    or repeated id are scored each; other columns are ignored; an empty table
    gives an empty result.
    """
    scored = docs.select(
        F.col(id).alias("doc_id"), held_out(F.col(id)).alias("held_out"),
        model.score(F.col(text)).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without those that the model calls toxic."""
    return docs.where(model.score(F.col(text)) < 0.5)
