"""Token counts, packing and token files against the library."""
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from gridlore.llm import codec as codecs
from gridlore.llm import packing, passages, token_counts, token_files
from gridlore.llm.codec import Codec

WORD = public_tokenizers.path("word_bpe_49k.json")
BYTE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "  a  b\n\n c ", "x<|endoftext|>y", "İ ﬁ éa", "日本語 text", "a\tb\r\nc",
    "it's  'S don't 12 345 §5 § x", "\n\nfoo \n bar", "foo\n", " lead", "trail ", "Größe, ça «va»",
    "word. word, word\nword", "“quoted” — dash…",
]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_codec_gives_the_librarys_ids(path):
    own = Codec(path, memory=4)
    wanted = [own.tokenizer.encode(x, add_special_tokens=False).ids for x in TEXTS * 2]
    assert [x.tolist() for x in own.encode(TEXTS * 2)] == wanted


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab'sS12 .,\n§é\t", max_size=40))
def test_codec_on_any_text(text):
    for own in CODECS:
        wanted = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert own.encode([text])[0].tolist() == wanted


CODECS = [Codec(WORD, memory=100), Codec(BYTE, memory=100)]


def test_later_stages_free_the_tokenizer_of_a_worker(monkeypatch):
    """A worker that has packed goes on to other stages and must not hold the codec for them."""
    made = {}
    monkeypatch.setattr(codecs, "_CODECS", made)
    codecs.codec(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(made) == 1

    class Taken:
        def mapInArrow(self, function, schema):
            return list(function(iter([])))

    pairs = Taken()
    assert passages._agreeing(pairs, 46, 0.8) == [] and not made


@pytest.mark.parametrize("path", [WORD, BYTE])
@pytest.mark.parametrize("chunk, overlap", [(64, 8), (300, 40), (1000, 16)])
def test_spliced_chunks_count_like_the_whole(path, chunk, overlap):
    own = Codec(path)
    texts = ["ab" * 1500 + " " + "cd " * 800, "x" * 3000, "日本 語" * 500, "  ".join(["ab"] * 500), "a " * 900]
    for text in texts:
        wanted = len(own.tokenizer.encode(text, add_special_tokens=False).ids)
        assert token_counts.count_spliced(own, text, chunk, overlap) == wanted


def test_counts_of_odd_rows(odd, clashing, none):
    library = Tokenizer.from_file(WORD)
    wanted = sorted(
        (repr(r.doc_id), len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids))
        for r in odd.collect()
    )
    for table in (odd, clashing):
        found = token_counts.count_tokens(table, WORD, limit=5, chunk=1000).collect()
        assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens) for r in found) == wanted
        assert all(r.over_limit == (r.n_tokens > 5) for r in found)
    assert token_counts.count_tokens(none, WORD).count() == 0


def test_packing_of_odd_rows(odd, clashing, none):
    library = Tokenizer.from_file(BYTE)
    for table in (odd, clashing):
        pieces = packing.pack(table, BYTE, size=64, end=0).collect()
        wanted = sorted(tuple(library.encode(r.text or "", add_special_tokens=False).ids) + (0,) for r in odd.collect())
        sequences = defaultdict(list)
        for p in pieces:
            sequences[p.sequence_id].append((p.offset, p.length))
            assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        assert sorted(sequences) == list(range(len(sequences)))
        for spans in sequences.values():
            at = 0
            for offset, length in sorted(spans):
                assert offset == at
                at += length
            assert at <= 64
        assert sum(p.length for p in pieces) == sum(map(len, wanted))
        unique = [p for p in pieces if p.doc_id == 5]
        ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in sorted(unique, key=lambda p: p.start)])
        assert tuple(ids.tolist()) in wanted
    assert packing.pack(none, BYTE).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 16), min_size=1, max_size=40))
def test_best_fit_takes_the_tightest_window(lengths):
    window, offset, opened = packing.best_fit_decreasing(np.array(lengths), 16)
    room = []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in room if r >= lengths[i]]
        if fits:
            assert 16 - offset[i] == min(fits)
            room.remove(min(fits))
            room.append(min(fits) - lengths[i])
        else:
            assert offset[i] == 0
            room.append(16 - lengths[i])
    assert opened == len(room)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=700), max_size=5))
def test_segment_round_trip(docs):
    raw = token_files.encode_segment([(i or None, np.array(x, np.uint32)) for i, x in enumerate(docs)])
    segment = next(token_files.segments(raw + b"\n"))
    flat = [x for ids in docs for x in ids]
    assert segment.ids().tolist() == flat
    for i in range(0, len(flat), 37):
        assert segment.id_at(i) == flat[i]
        assert segment.ids(i, min(len(flat), i + 50)).tolist() == flat[i : i + 50]


def test_token_files_of_odd_rows(odd, clashing, none):
    library = Tokenizer.from_file(WORD)
    rows = sorted(odd.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""))
    wanted, start = [], 0
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids + [2]
        wanted.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    for table in (odd, clashing):
        found = token_files.token_files(table, WORD).collect()
        assert sorted(map(tuple, found), key=lambda x: x[1]) == wanted
    assert token_files.token_files(none, WORD).count() == 0
