"""Texts as pieces that a vocabulary encodes on its own, each distinct piece encoded once.

The cuts are places where the vocabularies end a token in any text: between letters and
punctuation, before a run of white space, before the last space in front of a word.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa

from pnlflow.llm.common import SLICE_BYTES

#: Pieces and characters of pieces that a worker remembers (some 100 MB); beyond, its memory starts anew.
REMEMBERED, REMEMBERED_CHARS = 500_000, 32 << 20

#: Letters that every Unicode version knows as such, composed and with a single lower case.
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ſȘ-ț"
_OTHER = re.compile(rf"[^\x00-\x7f{LETTERS}]")


def _patterns(letters: str) -> tuple[re.Pattern, re.Pattern]:
    """The words of byte-level vocabularies, and those of vocabularies that drop white space, in lower case."""
    short = "'(?:[stmd]|re|ve|ll)"
    return (re.compile(rf" ?[{letters}]+|{short}| ?[0-9]+| ?[^\s0-9{letters}]+|\s+(?!\S)|\s+", re.ASCII),
            re.compile(rf"[{letters}]+|{short}|[0-9]|[^\s0-9{letters}]+", re.ASCII))


_BYTE_LEVEL, _SPACELESS = _patterns(LETTERS)
_BYTE_LEVEL_ASCII, _SPACELESS_ASCII = _patterns("A-Za-z")
_ASCII_SPACE = re.compile(r"[ \t-\r]+")
# before a space: after a character that is no white space, or after other white space than spaces and before a word
_CUT = re.compile(r"(?<=\S)(?= )|(?<=[^\S ])(?= \S)")
#: A space between two visible ASCII characters.
_PLAIN = re.compile(r"(?<=[!-~])(?= [!-~])")


def simple(text: str) -> bool:
    """Only ASCII and known letters."""
    return text.isascii() or _OTHER.search(text) is None


def byte_level_words(text: str) -> list[str]:
    """The pre-tokens of a text; stretches with other letters or marks stay whole, from one safe cut to the next."""
    if text.isascii():
        return _BYTE_LEVEL_ASCII.findall(text)
    if simple(text):
        return _BYTE_LEVEL.findall(text)
    return [w for piece in _CUT.split(text) for w in (_BYTE_LEVEL.findall(piece) if simple(piece) else [piece])]


def spaceless_words(text: str) -> list[str]:
    """The words of a vocabulary that folds case and drops white space; what holds other letters or marks
    stays whole between white space."""
    if text.isascii():
        return _SPACELESS_ASCII.findall(text.lower())
    if simple(text):
        return _SPACELESS.findall(text.lower())
    return [w for piece in _ASCII_SPACE.split(text) for w in (_SPACELESS.findall(piece.lower()) if simple(piece) else [piece])]


#: Byte -> 0 white space, 1 letter, 2 digit, 3 other, for simple texts in lower case: beyond ASCII they hold letters alone.
_KIND = np.full(256, 3, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_KIND[0x30:0x3A] = 2
_STMD = np.isin(np.arange(256), list(b"stmd"))


def spaceless_arrays(texts: Sequence[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """What ``spaceless_words`` finds in simple texts that are in lower case already, all texts at once: the words, and
    how many each text has."""
    raw = np.frombuffer(b"\n".join(texts) + b"\n\n\n", np.uint8)
    data = raw[:-2]  # ends with white space; two more bytes to look ahead
    kind = _KIND[data]
    begins = np.ones(len(data) + 1, bool)
    begins[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    quote = np.flatnonzero(data == 0x27)
    quote = quote[begins[quote]]
    one = _STMD[raw[quote + 1]]
    a, b = raw[quote + 1], raw[quote + 2]
    two = (b == 0x65) & ((a == 0x72) | (a == 0x76)) | (a == 0x6C) & (b == 0x6C)  # re, ve, ll
    begins[quote[one | two] + 1] = False
    begins[quote[one] + 2] = True
    begins[quote[two] + 3] = True
    edge = np.flatnonzero(begins)
    word = kind[edge[:-1]] != 0
    at = np.zeros(int(np.count_nonzero(word)) + 1, np.int32)
    np.cumsum(np.diff(edge)[word], out=at[1:])
    words = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(data[kind != 0]))
    end = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    before = np.searchsorted(edge[:-1][word], end)
    return words.dictionary_encode(), np.diff(before, prepend=0)


def windows(text: str, most: int = SLICE_BYTES) -> Iterator[str]:
    """A long text in parts of about ``most`` characters, cut before spaces."""
    at = 0
    while len(text) - at > most and (cut := _PLAIN.search(text, at + most)):
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


class _Numbers(dict):
    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class PieceMemory:
    """``cut`` divides a text into pieces; ``learn`` gives the ids of new pieces, one list for each."""

    def __init__(self, cut: Callable[[str], list[str]], learn: Callable[[list[str]], list[Sequence[int]]], most: int = REMEMBERED) -> None:
        self.cut, self.learn, self.most = cut, learn, most
        self._forget()

    def _forget(self) -> None:
        self.known, self.chars = _Numbers(), 0
        self.ids, self.start = np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _learn(self) -> None:
        if new := self.known.new:
            got = self.learn(new)
            size = np.fromiter(map(len, got), np.int64, len(got))
            self.ids = np.append(self.ids, np.fromiter((x for y in got for x in y), np.uint32, int(size.sum())))
            self.start = np.append(self.start, self.start[-1] + np.cumsum(size))
            self.chars += sum(map(len, new))
            self.known.new = []

    def _start(self) -> Callable[[str], int]:
        if len(self.known) > self.most or self.chars > REMEMBERED_CHARS:
            self._forget()
        return self.known.__getitem__

    def _gather(self, begin: np.ndarray, size: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        edge = np.concatenate(([0], np.cumsum(count)))
        end = np.concatenate(([0], np.cumsum(size)))
        place = np.arange(end[-1]) + np.repeat(begin - end[:-1], size)
        return self.ids[place], end[edge[1:]] - end[edge[:-1]]

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and how many each text has."""
        get = self._start()
        parts = [np.fromiter(map(get, p), np.int64, len(p)) for p in map(self.cut, texts)]
        self._learn()
        number = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        begin = self.start[number]
        return self._gather(begin, self.start[number + 1] - begin, np.fromiter(map(len, parts), np.int64, len(parts)))

    def encode_words(self, words: pa.DictionaryArray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that are cut already; each distinct word of them is looked up once."""
        get = self._start()
        number = np.fromiter(map(get, words.dictionary.to_pylist()), np.int64, len(words.dictionary))
        self._learn()
        begin, size, index = self.start[number], self.start[number + 1] - self.start[number], words.indices.to_numpy()
        return self._gather(begin[index], size[index], count)
