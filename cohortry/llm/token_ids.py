"""Ids of public tokenizers, made word by word.

Neither vocabulary merges across the cuts used here, so a text's ids are its pieces' ids in order and a worker
encodes a repeated piece once. ``tests/llm`` compares the result with the library's ids of whole texts. Strings of special
tokens in a text are ordinary text unless ``special`` is set: then a text is cut at them before any piece is looked up and
they give their own ids, as in the library's plain call.
"""

from __future__ import annotations

import re
from array import array
from functools import cache

from tokenizers import Tokenizer

from cohortry.llm.common import Remembered

#: Before a space with a visible character behind it, a byte-level vocabulary always starts a new piece.
BEFORE_WORD = re.compile(r"(?= \S)")
TOUCHING = re.compile(r"\s\s")
#: Both vocabularies start a new piece where a letter or digit is followed by one of these.
MARKS = ".,;:!?|#$%&*)"


@cache
def _tokenizer(path: str) -> Tokenizer:
    loaded = Tokenizer.from_file(path)
    loaded.encode_special_tokens = True
    return loaded


class _Pieces(Remembered):
    """piece -> little-endian 32-bit ids. A word and the marks behind it are remembered apart as well."""

    def __init__(self, path: str, before: str = "", lower: bool = False) -> None:
        super().__init__(self.ids)
        self.encode, self.before, self.lower = _tokenizer(path).encode, before, lower
        self.marks: dict[str, bytes] = {}

    def raw(self, text: str) -> bytes:
        return array("I", self.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, piece: str) -> bytes:
        core = piece.rstrip(MARKS)
        if core != piece and core and core[-1].isalnum():
            marks = piece[len(core) :]
            if marks not in self.marks:
                if len(self.marks) >= 10_000:
                    self.marks.clear()
                self.marks[marks] = self.raw(marks)
            return self[core] + self.marks[marks]
        if self.lower and piece.isascii() and (low := piece.lower()) != piece:
            return self[low]
        return self.raw(self.before + piece)


def _cutting(path: str, encode):
    """``encode`` between the special tokens' strings, which have to stand in the text exactly as in the vocabulary."""
    added = _tokenizer(path).get_added_tokens_decoder()
    if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
        raise ValueError(f"{path} has added tokens that are not found by their plain string")
    own = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
    if not own:
        return encode
    cut = re.compile("(" + "|".join(map(re.escape, sorted(own, key=len, reverse=True))) + ")")

    def run(text: str) -> bytes:
        parts = cut.split(text) if any(c in text for c in own) else (text,)
        return b"".join(own[p] if i % 2 else encode(p) for i, p in enumerate(parts) if p)

    return run


@cache
def byte_level(path: str, special: bool = False):
    """A function text -> little-endian 32-bit ids for a byte-level vocabulary that keeps white space."""
    whole, spaced = _Pieces(path), _Pieces(path, before=" ")
    newline = whole.raw("\n")

    def encode(text: str) -> bytes:
        if TOUCHING.search(text):
            return b"".join(map(whole.__getitem__, BEFORE_WORD.split(text)))
        lines = []
        for line in text.split("\n"):
            words = line.split(" ")
            lines.append(whole[words[0]] + b"".join(map(spaced.__getitem__, words[1:])))
        return newline.join(lines)

    return _cutting(path, encode) if special else encode


def word_level_once(path: str, special: bool = False):
    """A function text -> little-endian 32-bit ids for a vocabulary with word ends that drops white space and case."""
    known = _Pieces(path, lower=True)

    def encode(text: str) -> bytes:
        return b"".join(map(known.__getitem__, text.replace("\n", " ").split(" ")))

    return _cutting(path, encode) if special else encode


@cache
def word_level(path: str, special: bool = False):
    """The same function for all tasks of a worker, with one memory of pieces. It stays with the worker (up to some 300 MB), also
    when the worker goes on with other operators."""
    return word_level_once(path, special)
