"""Toxicity and transcripts, by brute force and held-out accuracy."""
import random

import pytest
from conftest import words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridlore.llm import toxicity, transcripts


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


TERMS = {"abcde": 1.0, "abcce": 2.0, "bad": 3.0, "dabab": 1.5, "cce*": 2.5, "eeeee": 1.0}


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abcde", max_size=8))
def test_the_automaton_finds_what_distances_say(word):
    found = AUTOMATON.find(word)
    wanted = [
        (0 if term.endswith("*") else _distance(word, term), -weight, term)
        for term, weight in TERMS.items()
        if (word.startswith(term[:-1]) if term.endswith("*") else _distance(word, term) <= toxicity.edits_allowed(term))
    ]
    assert (found is None) == (not wanted)
    if found:
        assert (found[1], -TERMS[AUTOMATON.terms[found[0]]]) == min(wanted)[:2]


AUTOMATON = toxicity.Automaton(TERMS)


def test_quotations_weigh_less():
    words_of = toxicity._Words(toxicity.Automaton({"badword": 2.0}))
    plain = toxicity.features("you badword there", words_of)
    for text in ('he said "you badword there"', "> you badword there", "er sagte „you badword there“ laut"):
        assert toxicity.features(text, words_of)[2] < plain[2]
    assert toxicity.features("badwrd", words_of)[1] > 0 == toxicity.features("bawrd", words_of)[1]


@pytest.fixture(scope="module")
def labelled(spark, docs_of):
    own, rows, labels = random.Random(4), [], []
    for i in range(600):
        text = words(("t", i), 40)
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(own.randrange(40), own.choice(["xuzzle", "quorble", "zanky" + own.choice("abcdef")]))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs_of(rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_held_out_texts_are_told_apart(labelled):
    docs, labels = labelled
    found = toxicity.score_documents(docs, toxicity.train(docs, labels)).where("held_out").collect()
    assert len(found) > 80 and all(0 <= r.score <= 1 for r in found)
    assert sum(r.predicted == (r.doc_id % 4 == 0) for r in found) >= 0.98 * len(found)


def test_misspelled_forms_that_were_never_seen_are_found(labelled, docs_of):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    words_of = toxicity._Words(toxicity.Automaton(model.terms))
    for form in ("xvzzle", "xuzle", "quorbble", "qorble"):
        assert words_of[form] and words_of[form][1] == 1, form
    rows = [(i, " ".join(words(("u", i), 40) + ["xvzzle", "qorble", "xuzle"])) for i in range(20)]
    scored = toxicity.score_documents(docs_of(rows), model).collect()
    assert sum(r.predicted for r in scored) >= 19


def test_labels_of_held_out_rows_are_not_used(labelled):
    docs, labels = labelled
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, turned) == toxicity.train(docs, labels)


def test_odd_rows(labelled, odd, clashing, none):
    docs, labels = labelled
    model = toxicity.train(docs, labels)
    for table in (odd, clashing):
        found = toxicity.score_documents(table, model).collect()
        assert len(found) == odd.count() and all(r.predicted == 0 and r.held_out is not None for r in found)
        kept = toxicity.without_toxic(table, model)
        assert kept.columns == table.columns and kept.count() == odd.count()
    assert toxicity.score_documents(none, model).count() == 0
    for some in (labels.where("false"), labels.where("toxic = 0")):
        unknowing = toxicity.train(docs, some)
        assert toxicity.score_documents(odd, unknowing).where("score > 0.01").count() == 0


def _conversations(spark, n=160):
    own, rows = random.Random(5), []
    for c in range(n):
        turn = 0
        if own.random() < 0.3:
            rows.append((c, turn, "system", " ".join(words(("s", c), 8)) + "."))
            turn += 1
        for i in range(own.randint(1, 4)):
            rows.append((c, turn, "user", " ".join(words(("u", c, i), own.randint(3, 9))) + "?"))
            lines = [" ".join(words(("a", c, i, j), own.randint(15, 40))) + "." for j in range(own.randint(1, 3))]
            rows.append((c, turn + 1, "assistant", "\n".join(lines)))
            turn += 2
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_held_out_turns_are_recovered(spark):
    found = transcripts.format_chats(_conversations(spark)).where("held_out").collect()
    assert len(found) > 15
    assert sum(r.n_right for r in found) >= 0.97 * sum(r.n_turns for r in found)


def test_viterbi_against_all_paths(spark):
    from itertools import product

    model = transcripts.train(transcripts.raw_transcripts(_conversations(spark, 30)))
    observed = [x for x, _, _ in transcripts.observe(["User: a b?", "c", "", "AI: d e f"])]

    def weight(path):
        total = model.first[path[0]]
        for i, state in enumerate(path):
            total += sum(model.seen.get(x, model.unseen)[state] for x in observed[i])
            total += model.following[path[i - 1], state] if i else 0.0
        return total

    best = max(product(range(len(transcripts.STATES)), repeat=4), key=weight)
    assert weight(model.states(observed)) == pytest.approx(weight(best))


def test_odd_conversations(spark):
    rows = [
        (1, 0, None, None), (1, 0, None, None), (1, None, "narrator", ""), (None, 3, "user", "x"),
        (2, 0, "user", "a\n\nb"), (2, 700, "assistant", "y" * 50_000), (2, 0, "user", "a\n\nb"),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    table = table.withColumns({name: F.lit("x") for name in ("part", "turns", "parsed", "_all", "held_out")})
    found = transcripts.format_chats(table).collect()
    assert sorted((repr(r.conv_id), r.part, r.n_turns) for r in found) == [("1", 0, 2), ("2", 0, 1), ("2", 1, 1), ("None", 0, 1)]
    assert transcripts.format_chats(table.where("false")).count() == 0
