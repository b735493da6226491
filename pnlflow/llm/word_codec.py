"""Whole texts to token ids with the tokenizers library, each distinct word encoded once.

``WordCodec`` cuts a text where the vocabulary's own pre-tokenizer cuts in any case, and each distinct
word goes through the library once.  ``PieceCodec`` cuts at spaces alone: at white space for
vocabularies that drop it, before a single space for byte-level ones; texts that hold no safe cut (runs
of spaces, space before other white space) go through whole.  The ids are those of the whole text.
"""

from __future__ import annotations

import os
import re

import numpy as np

from pnlflow.llm.common import SLICE_BYTES, remembered
from pnlflow.llm.pieces import PieceMemory, byte_level_words, simple, spaceless_arrays, spaceless_words, windows

#: Pieces that PieceCodec remembers (about 100 MB); beyond, its memory starts anew.
REMEMBERED = 500_000
#: Words that WordCodec remembers (about 170 MB).
WORDS = 800_000
#: A word of its own in any text, put between pieces that are encoded in one call.
MARK, JOINED = "\x01", 64


class _Numbers(dict):
    def __init__(self) -> None:
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        n = self[key] = len(self)
        self.new.append(key)
        return n


class PieceCodec:
    """keeps_space: the pre-tokenizer keeps white space (byte-level) or drops it.  ``_encode``
    gives the numbers of some texts; those of a text's pieces are those of the text."""

    def __init__(self, keeps_space: bool) -> None:
        self.keeps_space = keeps_space
        self._forget()

    def _encode(self, texts: list[str]) -> list[list[int]]:
        raise NotImplementedError

    def _forget(self) -> None:
        self.known, self.ids, self.start, self.unsafe = _Numbers(), np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(0, bool)

    def _learn(self) -> None:
        new = [p.decode("utf-8") for p in self.known.new]
        if not new:
            return
        self.known.new.clear()
        if self.keeps_space:  # a space before other white space belongs to one run with it
            self.unsafe = np.append(self.unsafe, [p[:1] == " " and p[1:2].isspace() or p == " " for p in new])
        got = self._encode(new)
        size = np.fromiter(map(len, got), np.int64, len(got))
        self.ids = np.append(self.ids, np.fromiter((x for y in got for x in y), np.uint32, int(size.sum())))
        self.start = np.append(self.start, self.start[-1] + np.cumsum(size))

    def whole(self, text: bytes) -> np.ndarray:
        return np.array(self._encode([text.decode("utf-8")])[0], np.uint32)

    def pieces(self, text: bytes) -> list[bytes] | None:
        if not self.keeps_space:
            return text.split()
        first, *rest = text.split(b" ")
        if b"" in rest:
            return None
        rest = [b" " + p for p in rest]
        return [first, *rest] if first else rest

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and how many each text has."""
        if len(self.known) > REMEMBERED:
            self._forget()
        parts, whole, get = [], {}, self.known.__getitem__
        for i, text in enumerate(texts):
            p = self.pieces(text)
            if p is None:
                whole[i] = self.whole(text)
                p = []
            parts.append(np.fromiter(map(get, p), np.int64, len(p)))
        self._learn()
        if self.keeps_space:
            for i, p in enumerate(parts):
                if len(p) and self.unsafe[p].any():
                    whole[i], parts[i] = self.whole(texts[i]), p[:0]
        n_parts = np.fromiter(map(len, parts), np.int64, len(parts))
        number = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        size = (self.start[1:] - self.start[:-1])[number]
        end = np.cumsum(size)
        place = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(self.start[number] - (end - size), size)
        ids = self.ids[place]
        total = np.concatenate(([0], end))
        edge = np.concatenate(([0], np.cumsum(n_parts)))
        count = total[edge[1:]] - total[edge[:-1]]
        if whole:
            at = np.concatenate(([0], np.cumsum(count)))
            ids = np.concatenate([whole.get(i, ids[at[i]:at[i + 1]]) for i in range(len(texts))])
            count = np.array([len(whole[i]) if i in whole else c for i, c in enumerate(count.tolist())], np.int64)
        return ids, count


class WordCodec:
    """A vocabulary file of the tokenizers library.  Added tokens found in a text are tokens of their own,
    as the library has it, or ordinary text (``plain_added``)."""

    def __init__(self, path: str, keeps_space: bool, plain_added: bool = False, most: int = WORDS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if plain_added:
            self.tokenizer.encode_special_tokens = True
        self.keeps_space = keeps_space
        self.memory = PieceMemory(byte_level_words if keeps_space else spaceless_words, self._apart if keeps_space else self._marked, most)
        added = [] if plain_added else [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)) if added else None
        mark = self._ids([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 and not keeps_space else None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _apart(self, words: list[str]) -> list[list[int]]:
        """Many words in one call, each on its own."""
        out: list[list[int]] = [[] for _ in words]
        for k in range(0, len(words), JOINED):
            e = self.tokenizer.encode(words[k:k + JOINED], is_pretokenized=True, add_special_tokens=False)
            for word, i in zip(e.word_ids, e.ids):
                out[k + word].append(i)
        return out

    def _marked(self, words: list[str]) -> list[list[int]]:
        """White space is dropped, so many words go in one call with marks between them."""
        if self.mark is None or any(MARK in t for t in words):
            return self._ids(words)
        out: list[list[int]] = []
        for ids in self._ids([f" {MARK} ".join([*words[k:k + JOINED], ""]) for k in range(0, len(words), JOINED)]):
            begin = 0
            for _ in range(ids.count(self.mark)):
                end = ids.index(self.mark, begin)
                out.append(ids[begin:end])
                begin = end + 1
        return out

    def _spaceless(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Simple parts are cut as arrays, some megabytes at once, the others one by one."""
        plain = np.fromiter(map(simple, parts), bool, len(parts))
        group: list[bytes] = []
        made, held = [], 0
        for at in np.flatnonzero(plain).tolist():
            group.append(parts[at].lower().encode())
            held += len(group[-1])
            if held > SLICE_BYTES:
                made.append(self.memory.encode_words(*spaceless_arrays(group)))
                group, held = [], 0
        made.append(self.memory.encode_words(*spaceless_arrays(group)))
        if not plain.all():
            made.append(self.memory.encode([parts[k] for k in np.flatnonzero(~plain).tolist()]))
        ids, size = (np.concatenate(x) for x in zip(*made))
        if plain.all():
            return ids, size
        place = np.argsort(~plain, kind="stable").argsort()  # where each part is in ``made``
        begin, size = (np.cumsum(size) - size)[place], size[place]
        return ids[np.arange(len(ids)) + np.repeat(begin - (np.cumsum(size) - size), size)], size

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts, and how many each text has.  A long text passes in windows; a text that
        holds an added token goes through the library whole."""
        whole: dict[int, np.ndarray] = {}
        row, parts = [], []
        for i, raw in enumerate(texts):
            text = raw.decode()
            if self.added and self.added.search(text):
                whole[i] = np.array(self._ids([text])[0], np.uint32)
            else:
                front = list(windows(text))
                row += [i] * len(front)
                parts += front
        ids, size = self.memory.encode(parts) if self.keeps_space else self._spaceless(parts)
        count = np.bincount(np.array(row, np.int64), weights=size, minlength=len(texts)).astype(np.int64)
        if whole:
            at = np.concatenate(([0], np.cumsum(count)))
            ids = np.concatenate([whole.get(i, ids[at[i]:at[i + 1]]) for i in range(len(texts))])
            count = np.array([len(whole[i]) if i in whole else c for i, c in enumerate(count.tolist())], np.int64)
        return ids, count


_codecs: dict[tuple, WordCodec] = remembered()


def codec(path: str, keeps_space: bool, plain_added: bool = False, most: int = WORDS) -> WordCodec:
    """The worker's own codec; it outlives a task, so a piece is seldom encoded twice.  Tasks say that they use it by
    ``slices(..., remembers=True)``."""
    key = (path, keeps_space, plain_added, most)
    if key not in _codecs:
        _codecs[key] = WordCodec(*key)
    return _codecs[key]


def with_end(ids: np.ndarray, count: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with ``end`` after each text's."""
    return np.insert(ids, np.cumsum(count), np.uint32(end)), count + 1
