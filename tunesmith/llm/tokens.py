"""Ids of whole texts, by the tokenizers library, with each distinct piece encoded once per worker.

Both vocabularies cut a text before its white space: no token spans such a cut. So a
text's ids are those of its pieces, one after another, and a worker keeps the ids of the
pieces it has met. Pieces are cut here, byte-mapped and handed to the library's BPE model;
a word with anything unusual (marks, scripts beyond Latin) under the vocabulary that
normalizes its text goes through the whole library call instead.
"""

from __future__ import annotations

import ctypes
import gc
import re
from array import array
from collections.abc import Callable

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, functions as F
from tokenizers import Tokenizer

# Entries a worker keeps in each of two generations (about 200 bytes each), and the longest piece it keeps.
KEPT, LONGEST = 300_000, 64

# Unicode white space, as the vocabularies' patterns see it: a fixed value.
WHITE = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_ODD_WHITE = [c for c in WHITE if c not in " \n"]
_ODD_ASCII = [c for c in _ODD_WHITE if c.isascii()]
_DOUBLE = ("  ", "\n\n", " \n", "\n ")
_PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")

# Up to here the library's character classes and case rules are checked against Python's in the tests.
# (but for the capital i with a dot, whose small form is two characters).
_BEYOND = re.compile("[^\x00-\u024f]|\u0130")
# Signs that may end a word; such a run is a token's end under both vocabularies.
_MARKS = ".,;:!?"


_held: dict[tuple, tuple] = {}


def worker_kept(key: tuple, make: Callable):
    """What ``make`` gives, kept by this worker for the tasks of a stage, and of the next one that asks for it first.

    When a task of another stage asks, all that was kept for earlier stages and is not asked for
    goes, and its memory is given back: a worker lives for a whole session, and what one
    step keeps must not weigh on the steps after it.
    """
    context = TaskContext.get()
    stage = context.stageId() if context else None
    known = _held.get(key)
    if known is None or known[0] != stage:
        old = [k for k, (s, _) in _held.items() if s != stage and k != key]
        for k in old:
            del _held[k]
        if old:
            given_back()
        _held[key] = known = (stage, known[1] if known else make())
    return known[1]


def given_back() -> None:
    """Return memory that nothing uses any more to the system, where the system's library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


class Memo(dict):
    """What ``make`` gives for a key, for the keys met last; a missing key is made."""

    def __init__(self, make: Callable, kept: int = KEPT):
        super().__init__()
        self.make, self.kept, self.older = make, kept, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > LONGEST:
                return value
        if len(self) >= self.kept:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


_LETTERS = dict(enumerate(byte_letters()))


def letters_of(pretoken: str) -> str:
    if pretoken.isascii() and pretoken[1:].isalpha():
        # Letters stand for themselves; only a blank before them does not.
        return _LETTERS[ord(pretoken[0])] + pretoken[1:]
    return pretoken.encode().decode("latin-1").translate(_LETTERS)


def cut(text: str) -> list[str] | None:
    """Pieces of a text whose only white space is single blanks and line ends; else None.

    Every piece but the first stands for itself with a blank before it, or, if it begins
    with a line end, for itself.
    """
    if not text or text[0] in WHITE or text[-1] in WHITE:
        return None
    odd = _ODD_ASCII if text.isascii() else _ODD_WHITE
    if any(c in text for c in _DOUBLE) or any(c in text for c in odd):
        return None
    return text.replace("\n", " \n").split(" ")


def cut_any(text: str) -> list[str]:
    """Pieces of any text: white space with what follows it."""
    return _PIECE.findall(text)


class ByteLevel:
    """Values of whole texts under byte_bpe_50k.json, put together from those of pre-tokens.

    ``of_pretoken`` gives a pre-token's value, ``of_special`` that of a special string.
    """

    SPECIAL = "<|endoftext|>"

    def __init__(self, of_pretoken: Callable, of_special, join: Callable):
        self.join, self.of_special = join, of_special
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.of_pretoken = of_pretoken
        self.pretokens = Memo(of_pretoken, KEPT // 8)
        self.chunks = Memo(self._chunk, KEPT // 8)
        self.pieces = Memo(self._piece)

    def _piece(self, piece: str):
        """The value of a piece with a blank before it, or of one that begins with a line end."""
        if piece.isalpha():
            return self.of_pretoken(" " + piece)
        bare = piece.rstrip(_MARKS)
        if bare.isalpha():
            return self.join([self.pieces[bare], self.pretokens[piece[len(bare) :]]])
        if piece[0] == "\n" and piece[1:].isalpha():
            return self.join([self.pretokens["\n"], self.pretokens[piece[1:]]])
        return self._chunk(piece if piece[0] == "\n" else " " + piece)

    def _chunk(self, chunk: str):
        body = chunk[1:] if chunk[0] == " " else chunk
        if body.isalpha():
            return self.pretokens[chunk]
        if self.SPECIAL in chunk:
            parts = []
            for k, part in enumerate(chunk.split(self.SPECIAL)):
                parts += [self.of_special] if k else []
                parts += [self.pretokens[p] for p in self.pattern.findall(part)]
            return self.join(parts)
        bare = body.rstrip(_MARKS)
        if bare.isalpha():
            cut_at = len(chunk) - len(body) + len(bare)
            return self.join([self.pretokens[chunk[:cut_at]], self.pretokens[chunk[cut_at:]]])
        return self.join([self.pretokens[p] for p in self.pattern.findall(chunk)])

    def __call__(self, text: str):
        pieces = cut(text)
        if pieces is None:
            return self.join(map(self.chunks.__getitem__, cut_any(text)))
        first = self.chunks[pieces[0]]
        return self.join([first, self.join(map(self.pieces.__getitem__, pieces[1:]))])


def _as_bytes(ids) -> bytes:
    return array("I", ids).tobytes()


def library(path: str) -> Tokenizer:
    return worker_kept(("library", path), lambda: Tokenizer.from_file(path))


def byte_level_ids(path: str) -> Callable[[str], bytes]:
    """Ids of a text as little-endian 32-bit integers, under byte_bpe_50k.json."""
    return worker_kept(("byte ids", path), lambda: _byte_level_ids(path))


def _byte_level_ids(path: str) -> Callable[[str], bytes]:
    whole = library(path)
    model = whole.model

    def of_pretoken(pretoken: str) -> bytes:
        return _as_bytes([t.id for t in model.tokenize(letters_of(pretoken))])

    return ByteLevel(of_pretoken, _as_bytes([whole.token_to_id(ByteLevel.SPECIAL)]), b"".join)


def word_ids(path: str) -> Callable[[str], bytes]:
    """Ids of a text as little-endian 32-bit integers, under word_bpe_49k.json, which drops white space."""
    return worker_kept(("word ids", path), lambda: _word_ids(path))


def _word_ids(path: str) -> Callable[[str], bytes]:
    whole = library(path)
    model = whole.model

    def of_letters(word: str) -> bytes:
        return _as_bytes([t.id for t in model.tokenize(letters_of(word.lower()))])

    letters = Memo(of_letters, KEPT // 2)

    def of_word(raw: bytes) -> bytes:
        word = raw.decode()
        if not _BEYOND.search(word):
            if word.isalpha():
                return letters[word]
            bare = word.rstrip(_MARKS)
            if bare.isalpha():
                return letters[bare] + letters[word[len(bare) :]]
        return _as_bytes(whole.encode(word, add_special_tokens=False).ids)

    words = Memo(of_word, KEPT)
    return lambda text: b"".join(map(words.__getitem__, text.encode().split()))


def id_column(text: Column, path: str, end: int) -> Column:
    """Ids of whole texts under byte_bpe_50k.json and ``end`` behind them, as little-endian 32-bit integers; a null text is empty."""

    @F.arrow_udf("binary")
    def encode(texts: pa.Array) -> pa.Array:
        of, last = byte_level_ids(path), np.array([end], "<u4").tobytes()
        found = pa.array([of(t.as_py() or "") + last for t in texts], pa.binary())
        pa.default_memory_pool().release_unused()
        return found

    return encode(text)
