"""Exact copies against brute force."""
import hashlib
import re
from collections import defaultdict

import pytest
from conftest import words
from pyspark.sql import functions as F

from gridlore.llm.exact_dedup import drop_copies, exact_copies


def brute(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(i)
    return {
        hashlib.sha256(body.encode()).hexdigest(): (min([i for i in ids if i is not None], default=None), sorted(map(str, ids)))
        for body, ids in groups.items()
    }


def check(rows, found):
    groups = defaultdict(list)
    for r in found:
        groups[r.text_sha256].append(r)
    wanted = brute(rows)
    assert groups.keys() == wanted.keys() and len(found) == len(rows)
    for sha, of in groups.items():
        least, ids = wanted[sha]
        assert sorted(str(r.doc_id) for r in of) == ids
        assert {(r.keep_id, r.group_size) for r in of} == {(least, len(ids))}
        assert [r.doc_id for r in of if r.kept] == [least]


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_groups_whatever_the_digest_tells_apart(docs_of, digest_bytes):
    rows = [(i, " ".join(words(i % 37, 4 + i % 5))) for i in range(200)]
    rows += [(1000 + i, "many \t copies" if i % 3 else "many copies") for i in range(400)]
    rows += [(2000, "a b"), (2001, "a b"), (2002, " a b"), (2003, "a\x0b\x0c\x1cb"), (2004, "a\x0b \x0c\x1cb"), (2005, "a b")]
    check(rows, exact_copies(docs_of(rows).repartition(7), digest_bytes=digest_bytes).collect())


@pytest.mark.parametrize("digest_bytes", [32, 0])
def test_odd_rows(odd, clashing, none, digest_bytes):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for table in (odd, clashing):
        check(rows, exact_copies(table, digest_bytes=digest_bytes).collect())
    assert exact_copies(none).count() == 0


def test_dropping_keeps_one_row_of_a_group(odd, clashing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for table in (odd, clashing, odd.withColumnsRenamed({"doc_id": "name", "text": "body"})):
        id, text = ("doc_id", "text") if "text" in table.columns else ("name", "body")
        left = drop_copies(table, id=id, text=text)
        assert left.columns == table.columns
        kept = brute([(r[id], r[text]) for r in left.collect()])
        assert {k: v[0] for k, v in kept.items()} == {k: v[0] for k, v in brute(rows).items()}
        assert left.count() == len(kept)


def test_main_path_has_no_python(docs_of, plan):
    found = exact_copies(docs_of([(i, str(i % 3)) for i in range(30)]))
    assert "Python" not in plan(found) and "Arrow" not in plan(found)


def test_copies_are_combined_before_they_are_shuffled(docs_of, plan):
    from gridlore.llm import exact_dedup

    bodies = docs_of([(1, "a")]).select("doc_id", F.col("text").alias("body"), F.col("text").alias("key"))
    steps = re.findall(r"\(\d+\) (\w+)\n.*?Functions", plan(exact_dedup._combined(bodies, 8)), re.S)
    assert plan(exact_dedup._combined(bodies, 8)).count("partial_min") >= 2 and steps
