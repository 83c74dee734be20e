"""Shards, fingerprints, near duplicates, passages and leaks against brute force."""
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import words

from gridlore.llm import decontamination, fingerprints, near_dedup, passages, sharding
from gridlore.llm.components import components


def test_shards_are_equal_and_keep_copies_together(docs_of):
    rows = [(i, " ".join(words(i, 5 + i % 90))) for i in range(600)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]
    texts = dict(rows)
    found = sharding.shard(docs_of(rows), 8).collect()
    sizes, slots, places = Counter(), defaultdict(list), defaultdict(set)
    for r in found:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        places[texts[r.doc_id]].add(r.shard)
    assert sorted(sizes) == list(range(8)) and len(found) == len(rows)
    assert max(sizes.values()) < 1.06 * sum(sizes.values()) / 8
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert all(len(x) == 1 for x in places.values())


def test_copies_that_outweigh_a_shard_are_cut(docs_of):
    rows = [(i, " ".join(words(i, 30))) for i in range(300)] + [(1000 + i, "the same " * 25) for i in range(400)]
    sizes = Counter()
    for r in sharding.shard(docs_of(rows), 4).collect():
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) < 1.1 * sum(sizes.values()) / 4


def test_shards_of_odd_rows(odd, clashing, none):
    for table in (odd, clashing):
        found = sharding.shard(table, 4).collect()
        assert len(found) == odd.count()
        slots = defaultdict(list)
        for r in found:
            slots[r.shard].append(r.slot)
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.shard(none, 4).count() == 0


def _weights(text):
    w = text.lower().replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
    return Counter(zip(w, w[1:] + [None]))


def _generalised_jaccard(a, b):
    a, b = _weights(a), _weights(b)
    keys = set(a) | set(b)
    return sum(min(a[k], b[k]) for k in keys) / sum(max(a[k], b[k]) for k in keys)


def test_fingerprints_estimate_generalised_jaccard(docs_of):
    rows = [(i * 3, " ".join(words(i // 2, 60 + i % 7) + words(i, i % 50))) for i in range(200)]
    found = {r.doc_id: r for r in fingerprints.fingerprint_documents(docs_of(rows), block_bytes=4000).collect()}
    off, fingerprints_of = [], {}
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        off.append(r.near_edited - _generalised_jaccard(text, edited))
        off.append(r.near_next - _generalised_jaccard(text, following))
        assert fingerprints_of.setdefault(text, r.fingerprint) == r.fingerprint
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.08


def test_fingerprints_of_odd_rows(odd, clashing, none, docs_of):
    for table in (odd, clashing):
        found = fingerprints.fingerprint_documents(table, block_bytes=1000).collect()
        assert len(found) == odd.count()
        assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert fingerprints.fingerprint_documents(none).count() == 0
    alone = fingerprints.fingerprint_documents(docs_of([(5, "only one text")])).first()
    assert alone.near_next == 1.0
    nameless = fingerprints.fingerprint_documents(docs_of([(None, "x y"), (None, None)])).collect()
    assert len(nameless) == 2


def test_components(spark):
    links = [(9, 1), (1, 5), (7, 8), (8, 3), (3, 2), (20, 21), (21, 22), (22, 23), (23, 24), (4, 4)]
    found = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert found == {1: 1, 5: 1, 9: 1, 2: 2, 3: 2, 7: 2, 8: 2, 20: 20, 21: 20, 22: 20, 23: 20, 24: 20}


def _near_rows():
    """Groups of near copies of which some are linked only through others."""
    rows, at = [], 0
    for group in range(6):
        own = words(("g", group), 160)
        for copy in range(45 if group == 0 else 5):
            text = list(own)
            for i in range(copy % 7):
                text[(17 * i + 5 * copy) % 160] = f"new{copy}x{i}"
            rows.append((at, " ".join(text)))
            at += 1
    rows += [(at + i, " ".join(words(("other", i), 50))) for i in range(40)]
    return rows + [(at + 50, rows[0][1]), (at + 51, ""), (at + 52, None), (at + 53, "..."), (at + 54, "two words")]


def _classes_by_brute_force(rows):
    sets = {}
    for i, text in rows:
        w = (text or "").replace(".", "").split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i in sets}


@pytest.mark.parametrize("few", [32, 2])
def test_near_classes(docs_of, few):
    rows = _near_rows()
    found = near_dedup.near_classes(docs_of(rows), few=few).collect()
    assert {r.doc_id: r.class_id for r in found} == _classes_by_brute_force(rows)


def test_links_in_a_crowd_just_below_the_threshold_are_found(docs_of):
    """Copies of one text with up to a tenth of the words replaced: most pairs are no links, many are."""
    import random

    own, base, rows = random.Random(9), words("crowd", 120), []
    for i in range(250):
        text = list(base)
        for at in own.sample(range(120), own.randint(0, 9)):
            text[at] = f"{i}x{at}"
        rows.append((i, " ".join(text)))
    found = near_dedup.near_classes(docs_of(rows), few=4).collect()
    wanted = _classes_by_brute_force(rows)
    assert {r.doc_id: r.class_id for r in found} == wanted
    assert 1 < len(set(wanted.values())) < 250


def test_a_shared_line_makes_no_pairs(docs_of, monkeypatch):
    seen, verified = [], near_dedup._verified

    def counted(pairs, *rest):
        seen.append(pairs.distinct().count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    line, sums = words("line", 30), []
    for n in (200, 800):
        rows = [(i, " ".join(words(("own", i), 8) + line + words(("end", i), 7))) for i in range(n)]
        assert len({r.class_key for r in near_dedup.near_classes(docs_of(rows)).collect()}) == n
        sums.append(sum(seen))
        seen.clear()
    assert sums[1] < 4 * sums[0]


def test_counters_do_not_grow_with_the_pieces_of_a_crowd(spark):
    """Texts of one crowd in many pieces: each core hands out a counter once, and the sums are right."""
    own = [(i, [7, 8, 9, 9, 100 + i]) for i in range(400)]
    texts = spark.createDataFrame(own, "node bigint, shingles array<int>").repartition(100)
    cores = spark.sparkContext.defaultParallelism
    assert near_dedup._counted(texts).count() <= 400 + 3 * cores < 400 + 3 * 100
    table = near_dedup._counters(texts)
    assert table[[7, 8, 9]].tolist() == [400] * 3
    assert table[100:500].tolist() == [1] * 400 and table.sum() == 3 * 400 + 400


def test_near_copies_with_a_repeated_line_are_linked(docs_of):
    rows = []
    for group in range(20):
        own, line = words(("r", group), 200), words(("line", group), 12)
        for copy, times in enumerate((1, 20, 50)):
            rows.append((10 * group + copy, " ".join(own + line * times)))
    found = near_dedup.near_classes(docs_of(rows)).collect()
    wanted = _classes_by_brute_force(rows)
    assert wanted[2] == 0 and wanted[12] == 10
    assert {r.doc_id: r.class_id for r in found} == wanted


def test_prob_minhash_estimates_probability_jaccard():
    own = np.random.default_rng(1)
    items = own.integers(0, 2**63, 300).astype(np.uint64)
    a = np.concatenate((np.repeat(items[:100], 3), items[100:220]))
    b = np.concatenate((np.repeat(items[:100], 2), items[140:300]))
    signatures, _ = near_dedup.prob_minhash(np.concatenate((a, b)), np.array([0, len(a), len(a) + len(b)]), 4096)
    x, y = ({int(k): int(n) for k, n in zip(*np.unique(z, return_counts=True))} for z in (a, b))
    keys = set(x) | set(y)
    wanted = sum(
        1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in keys) for i in set(x) & set(y)
    )
    assert abs((signatures[0] == signatures[1]).mean() - wanted) < 0.04
    assert near_dedup.similarity(np.sort(a), np.sort(b)) == pytest.approx(max(wanted, 180 / 300), abs=1e-9)


def test_one_document_of_each_class_is_kept(odd, clashing, none, docs_of):
    rows = _near_rows()
    kept = {r.doc_id for r in near_dedup.keep_one(docs_of(rows)).collect()}
    assert kept == set(_classes_by_brute_force(rows).values())
    for table in (odd, clashing):
        found = near_dedup.keep_one(table)
        assert found.columns == table.columns
        texts = Counter((r.text or "").strip() for r in found.collect())
        assert texts["a b"] == 1 and texts["same row"] == 1 and texts[""] == 1
        assert sum(len(x) > 1000 for x in texts) == 1
    assert near_dedup.keep_one(none).count() == 0
    nameless = docs_of([(None, "a b c d e"), (None, "v w x y z"), (None, "a b c d e")])
    assert near_dedup.keep_one(nameless).count() == 2


def _passage_rows():
    shared, other = words("shared", 70), words("other", 55)
    rows = [(i, " ".join(words(("d", i), 40) + shared + words(("e", i), 30))) for i in range(12)]
    changed = list(other)
    changed[27] = "changed"
    rows += [(50, " ".join(words("f", 90) + other)), (51, " ".join(changed + words("g", 80)))]
    rows += [(60 + i, " ".join(words(("h", i), 60) + shared[:30] + words(("i", i), 60))) for i in range(5)]
    # A phrase of the passage below stands in an earlier document, too.
    late = words("late", 60)
    rows += [(20, " ".join(words("j", 70) + late[20:40] + words("k", 70)))]
    rows += [(70 + i, " ".join(words(("l", i), 30) + late + words(("m", i), 30))) for i in range(3)]
    return rows


def test_repeated_passages(docs_of):
    rows = _passage_rows()
    found = defaultdict(set)
    for r in passages.repeated_passages(docs_of(rows).coalesce(1)).collect():
        found[r.doc_id].update(range(r.start, r.end))
    exact = {i: set(range(40, 110)) for i in range(1, 12)} | {71: set(range(30, 90)), 72: set(range(30, 90))}
    for i, span in exact.items():
        assert span <= found[i] and len(found[i]) < len(span) + 8, i
    assert set(range(0, 55)) <= found[51]
    assert set(found) == {*exact, 51}


@pytest.mark.parametrize("size, replaced", [(55, (18, 37)), (60, (20, 40)), (80, (20, 40, 60)), (50, (25,))])
def test_passages_with_replaced_words_are_found(docs_of, size, replaced):
    rows = []
    for i in range(40):
        own = words(("p", size, i), size)
        rows.append((i, " ".join(words(("a", i), 60) + own + words(("b", i), 60))))
        for at in replaced:
            own[at] = f"new{at}"
        rows.append((100 + i, " ".join(words(("c", i), 60) + own + words(("d", i), 60))))
    rows.sort()
    found = passages.repeated_passages(docs_of(rows).coalesce(1)).collect()
    spans = {r.doc_id: (r.first_id, r.start, r.end) for r in found}
    assert spans == {100 + i: (i, 60, 60 + size) for i in range(40)}


@pytest.mark.parametrize("held", [30, 45])
def test_phrases_that_earlier_documents_share_hide_no_passage(docs_of, held):
    rows, wanted = [], {}
    for i in range(30):
        own = words(("p", i), 60)
        for j in range(20 if i < 3 else 6):
            at = j * (60 - held) // 5 % (61 - held)
            rows.append((100 * j + i, " ".join(words(("a", i, j), 40) + own[at : at + held] + words(("b", i, j), 40))))
        rows.append((5000 + i, " ".join(words(("c", i), 60) + own + words(("d", i), 60))))
        own = list(own)
        own[20], own[40] = "new", "other"
        rows.append((6000 + i, " ".join(words(("e", i), 60) + own + words(("f", i), 60))))
        wanted[6000 + i] = (5000 + i, 60, 120)
    rows.sort()
    found = passages.repeated_passages(docs_of(rows).coalesce(1)).collect()
    assert {r.doc_id: (r.first_id, r.start, r.end) for r in found if r.doc_id >= 6000} == wanted


def test_chains_and_least_places():
    own = np.random.default_rng(5)
    for _ in range(50):
        keys, places = own.integers(0, 4, 40).astype(np.uint64), np.cumsum(own.integers(1, 3, 40))
        got = defaultdict(set)
        for first, last, step in zip(*passages.chains(keys, places)):
            assert keys[first] == keys[last]
            got[int(keys[first])].update(range(places[first], places[last] + 1, step or 1))
        assert got == {int(k): set(places[keys == k].tolist()) for k in keys}
        order, ends = own.integers(1, 30, 40).astype(np.uint32), np.array([0, 3, 18, 18, 40])
        wanted = set()
        for x, y in zip(ends, ends[1:]):
            for i in range(x, y - 9):
                wanted.update(j for j in range(i, i + 10) if order[j] <= sorted(order[i : i + 10])[2])
        # A place is kept if it is in one interval that it is least in.
        assert set(passages.least_places(order, ends, 10, 3).tolist()) == wanted


def test_passages_with_a_word_put_in_or_left_out_are_found(docs_of):
    rows, wanted = [], {}
    for i, size in enumerate((50, 51, 60, 75, 90, 98) * 5):
        own = words(("p", i), size)
        changed = own[: size // 2] + ["new"] + own[size // 2 :] if i % 2 else own[: size // 2] + own[size // 2 + 1 :]
        rows.append((i, " ".join(words(("a", i), 60) + own + words(("b", i), 60))))
        rows.append((100 + i, " ".join(words(("c", i), 70) + changed + words(("d", i), 60))))
        wanted[100 + i] = (i, 70, 70 + len(changed))
    rows.sort()
    found = passages.repeated_passages(docs_of(rows).coalesce(1)).collect()
    assert {r.doc_id: (r.first_id, r.start, r.end) for r in found} == wanted


@pytest.mark.parametrize("module, make, tables", [
    (near_dedup, near_dedup.near_classes, {"signed", "links"}),
    (passages, passages.repeated_passages, {"windows", "runs"}),
])
def test_python_gets_words_and_shingles_in_small_batches(spark, docs_of, monkeypatch, module, make, tables):
    key, seen, write = "spark.sql.execution.arrow.maxRecordsPerBatch", {}, module.materialize

    def noted(df, name="table"):
        seen[name] = int(spark.conf.get(key))
        return write(df, name)

    monkeypatch.setattr(module, "materialize", noted)
    before = spark.conf.get(key)
    make(docs_of(_passage_rows())).collect()
    assert int(before) > 512 and spark.conf.get(key) == before
    assert {name: seen[name] for name in tables} == dict.fromkeys(tables, 512)


def test_cut_passages(docs_of, odd, clashing, none):
    rows = _passage_rows()
    docs = docs_of(rows).coalesce(1)
    left = {r.doc_id: r.text.split() for r in passages.cut_passages(docs, passages.repeated_passages(docs)).collect()}
    seen = Counter(tuple(w[k : k + 50]) for w in left.values() for k in range(len(w) - 49))
    assert max(seen.values()) == 1 and len(left) == len(rows)
    assert left[5][:40] == words(("d", 5), 40) and left[61] == dict(rows)[61].split()
    for table in (odd, clashing):
        cut = passages.cut_passages(table, passages.repeated_passages(table))
        assert cut.columns == table.columns
        texts = [r.text for r in cut.collect()]
        assert len(texts) == odd.count() - 1 and sum(len(x or "") > 1000 for x in texts) == 1
    assert passages.repeated_passages(none).count() == 0
    assert passages.cut_passages(none, passages.repeated_passages(none)).count() == 0


def test_compact_windows_are_the_long_nodes_of_the_cartesian_tree():
    own = np.random.default_rng(3)
    hashed = own.integers(0, 2**63, 300).astype(np.uint64)
    ends = np.array([0, 120, 120, 160, 300])
    texts, places, keys = passages.compact_windows(hashed, ends, 20, 2)
    found = defaultdict(set)
    for t, p, k in zip(texts, places, keys):
        found[int(t)].add((int(p), int(k)))
    for t in range(4):
        wanted = set()
        for i in range(2):
            own_hash = passages.mix(hashed[ends[t] : ends[t + 1]] ^ passages.mix(np.full(1, i + 1, np.uint64)))

            def nodes(a, b):
                if b - a >= 20:
                    at = a + int(np.argmin(own_hash[a:b]))
                    wanted.add((at, int(own_hash[at])))
                    nodes(a, at)
                    nodes(at + 1, b)

            nodes(0, len(own_hash))
        assert found[t] == wanted


@pytest.fixture(scope="module")
def leaks(spark, docs_of):
    items = [(i, " ".join(words(("item", i), 15 + 6 * i))) for i in range(6)] + [(None, " ".join(words("nameless", 20)))]
    items += [(90, None), (91, ""), (92, "too short"), (93, items[2][1])]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(i, " ".join(words(("c", i), 80))) for i in range(20)]
    for i in range(6):
        own = items[i][1].split()
        rows.append((100 + i, " ".join(words(("p", i), 20) + own + words(("q", i), 20))))
        own[len(own) // 2] = "other"
        rows.append((200 + i, " ".join([*own, *words(("r", i), 20)])))
        rows.append((300 + i, " ".join(words(("s", i), 30) + items[i][1].split()[:8] + words(("t", i), 30))))
    rows.append((400, items[6][1]))
    return docs_of(rows), benchmark


def test_contaminated(leaks):
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(*leaks).collect()}
    items = [{i} if i != 2 else {2, 93} for i in range(6)]
    assert found == {(base + i, j) for base in (100, 200) for i in range(6) for j in items[i]} | {(400, None)}


@pytest.mark.parametrize("size,replaced", [(10, [0]), (10, [3, 6]), (13, [0, 12]), (15, [1, 3, 5]), (15, None), (12, None), (30, None)])
def test_items_are_found_whichever_fifth_of_the_words_is_replaced(docs_of, spark, size, replaced):
    import random

    own, docs, items = random.Random(size), [], []
    for i in range(60):
        item = words(("item", size, i), size)
        items.append((i, " ".join(item)))
        text = list(item)
        for at in replaced or own.sample(range(size), size // 5):
            text[at] = f"new{at}"
        docs.append((i, " ".join(words(("a", i), 20) + text + words(("b", i), 20))))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs_of(docs), bench).collect()}
    assert found <= {(i, i) for i in range(60)}
    # Three masks of ten in a longer item may all be hit.
    assert len(found) == 60 if size <= 15 else len(found) >= 57


def test_agreeing_runs_are_the_longest_by_brute_force():
    import random

    own = random.Random(2)
    for _ in range(300):
        n = own.randint(1, 40)
        a = np.array([own.randint(0, 1) for _ in range(n)])
        b, least, share = np.ones(n, int), own.randint(1, 12), own.choice([0.5, 0.8, 1.0])
        every = [
            (x, y) for x in range(n) for y in range(x + least, n + 1)
            if a[x] and a[y - 1] and a[x:y].sum() >= share * (y - x) - 1e-9
        ]
        wanted = [(x, y) for x, y in every if not any((u <= x and y <= v) and (u, v) != (x, y) for u, v in every)]
        got = passages.agreeing_runs(a, b, 0, least, share)
        # A stretch may begin inside a run of agreeing places only if a longer one begins at the run.
        assert all(any(u <= x and y <= v for u, v in got) for x, y in wanted) and set(got) <= set(every)


def test_decontamination_keeps_clean_documents(leaks, odd, clashing, none):
    docs, benchmark = leaks
    found = decontamination.contaminated(docs, benchmark)
    left = {r.doc_id for r in decontamination.without_contaminated(docs, found).collect()}
    assert left == {*range(20), *range(300, 306)}
    for table in (odd, clashing):
        kept = decontamination.without_contaminated(table, decontamination.contaminated(table, benchmark))
        assert kept.columns == table.columns and kept.count() == odd.count()
    assert decontamination.contaminated(none, benchmark).count() == 0
    assert decontamination.contaminated(docs, benchmark.where("false")).count() == 0
