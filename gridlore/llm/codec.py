"""Token ids of whole texts, as the tokenizers library gives them.

A byte-pair tokenizer cuts a text at white space and between kinds of characters
before it merges anything. So the ids of a text are those of its pieces, one
after the other, and a worker asks the library's model for each different piece
only once. That is done for the two ways of cutting named below, and for texts
of the characters in ``_PLAIN``, on which all parties agree what a letter and
what white space is. Any other file, any other text, and one that holds a
special token's string, is given to the library whole.
"""
from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterable

import numpy as np

_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-ÿ‘’“”–—…]*")
# White space of which the pieces of a byte-level tokenizer could split a run.
_RUNS = re.compile(r"\s[^\S\n]|[^\S\n]\s|[\t\r]|\A\s|\n\n")

# The patterns by which the known files cut a text.
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
_BYTE_CUT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+"
)


def _byte_letters() -> dict[int, int]:
    """Byte-level models spell each byte as one visible character."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in kept]
    return {byte: 256 + i for i, byte in enumerate(others)}


class _Pieces(dict):
    """The ids of pieces, asked for when they are missing.

    Bounded: when there are ``memory`` new pieces, those of the generation
    before are forgotten.
    """

    def __init__(self, model, style: str | None, kind: str, memory: int):
        self.tokenize, self.style, self.kind, self.memory = model.tokenize, style, kind, memory
        self.spell, self.old = _byte_letters(), {}

    def __missing__(self, piece: str) -> bytes:
        raw = self.old.get(piece)
        if raw is None:
            if self.style == "word":
                whole = piece.isalpha() and piece.islower()
                parts = None if whole else _WORD_CUT.findall(piece.lower())
            else:
                whole = piece.isalpha() or piece[:1] == " " and piece[1:].isalpha()
                parts = None if whole else _BYTE_CUT.findall(piece)
            if whole or parts == [piece]:
                raw = self._ask(piece)
            else:
                raw = b"".join([self[part] for part in parts])
        self[piece] = raw
        return raw

    def _ask(self, part: str) -> bytes:
        if not part.isascii() or not part.isalpha():
            part = part.encode().decode("latin-1").translate(self.spell)
        return array(self.kind, [token.id for token in self.tokenize(part)]).tobytes()

    def forget(self) -> None:
        if len(self) > self.memory:
            self.old = dict(self)
            self.clear()


class Codec:
    """A tokenizer file, with a bounded memory of the pieces seen last."""

    def __init__(self, path: str, memory: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = [x["content"] for x in spec.get("added_tokens", [])]
        small = self.tokenizer.get_vocab_size() <= 1 << 16 and sys.byteorder == "little"
        self.dtype, kind = (np.dtype("<u2"), "H") if small else (np.dtype("<u4"), "I")
        self.style = self._style(spec)
        self.known = _Pieces(self.tokenizer.model, self.style, kind, memory)

    @staticmethod
    def _style(spec: dict) -> str | None:
        """How the file cuts texts: by ``word``, by ``byte`` pattern, or another way."""
        cut = spec["pre_tokenizer"] or {}
        if spec["normalizer"] is None and cut.get("type") == "ByteLevel":
            return "byte" if cut["use_regex"] and not cut["add_prefix_space"] else None
        steps = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = cut.get("pretokenizers", [{}])
        known = cuts[0].get("pattern") == {"Regex": _WORD_PATTERN} and cuts[0]["invert"]
        return "word" if known and steps == ["NFC", "Replace", "Lowercase"] else None

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def pieces(self, text: str) -> list[str] | None:
        """The text in pieces that are encoded independently; None if it must stay whole."""
        if self.style is None or not _PLAIN.fullmatch(text):
            return None
        if any(x in text for x in self.specials):
            return None
        if self.style == "word":
            return text.split()
        if _RUNS.search(text):
            return _BYTE_CUT.findall(text)
        marked = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
        return [x for x in marked if x] if "" in marked else marked

    def encode_raw(self, texts: Iterable[str]) -> list[bytes]:
        """For each text its ids as little-endian numbers of ``dtype``."""
        out, get = [], self.known.__getitem__
        for text in texts:
            pieces = self.pieces(text)
            if pieces is None:
                out.append(np.array(self._ids(text), self.dtype).tobytes())
            else:
                out.append(b"".join(map(get, pieces)))
                self.known.forget()
        return out

    def encode(self, texts: Iterable[str]) -> list[np.ndarray]:
        return [np.frombuffer(raw, self.dtype) for raw in self.encode_raw(texts)]

    def count(self, texts: Iterable[str]) -> list[int]:
        return [len(raw) // self.dtype.itemsize for raw in self.encode_raw(texts)]

    def offsets(self, text: str) -> np.ndarray:
        """Where the tokens of a text begin and end, in characters."""
        found = self.tokenizer.encode(text, add_special_tokens=False).offsets
        return np.array(found, np.int64).reshape(-1, 2)


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a file; later tasks of the worker find it warm."""
    if path not in _CODECS:
        _CODECS.clear()
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def let_go() -> None:
    """Free the worker's codec, for tasks that have no use for it: Spark's workers outlive their stage."""
    _CODECS.clear()
