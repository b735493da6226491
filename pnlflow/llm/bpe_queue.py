"""Byte-level BPE of whole texts by a priority queue of merge ranks.

The symbols of a word are a doubly linked list.  All neighbours that the vocabulary can merge wait in
a queue by (rank, place); the first is merged in place, its two new neighbourhoods join the queue, and
entries whose symbols have changed since are skipped when they come up.  A word of n bytes costs
n log n, however long it is.  Each distinct word is merged once per worker memory.  Decoding
concatenates the vocabulary's strings and reads them back as bytes.

Added tokens (such as an end mark) found in a text are tokens of their own, as in the library's default.

Defined results: null and empty texts have no ids.  Rows are encoded one by one, so repeated rows, ties
and null ids change nothing; further columns are dropped unless named in ``keep``.  Long texts pass in windows of
about 4 MB (a stretch without any space is one window); memory grows with a text's ids, four bytes each.
An empty table gives an empty result.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.common import SLICE_BYTES, slices
from pnlflow.llm.pieces import PieceMemory, byte_level_words, simple, windows

#: Ids decoded in one step.
STEP = 1 << 20


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is visible in
    Latin-1, else the next free one from 256 on."""
    free = iter(range(256, 512))
    return [chr(b) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174 else chr(next(free)) for b in range(256)]


class Vocabulary:
    """A byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, split = file["model"], file["pre_tokenizer"]
        if (model["type"], split["type"], split.get("add_prefix_space"), split.get("use_regex", True), file["normalizer"]) != ("BPE", "ByteLevel", False, True, None):
            raise ValueError(f"not a byte-level BPE vocabulary: {path}")
        if model.get("dropout") or model.get("ignore_merges") or any(t[k] for t in file["added_tokens"] for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError(f"unsupported options: {path}")
        self.path, vocab, letters = path, model["vocab"], byte_letters()
        self.byte_ids = [vocab[c] for c in letters]
        self.added = {t["content"]: t["id"] for t in file["added_tokens"]}
        #: left id -> right id -> rank; rank -> id of the joined symbol
        self.rank, self.made = defaultdict(dict), []
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[left]].setdefault(vocab[right], rank)
            self.made.append(vocab[left + right])
        self.rank = [self.rank.get(x, {}).get for x in range(1 + max(vocab.values()))]

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token."""
        symbols = [self.byte_ids[b] for b in word]
        n, rank, made = len(symbols), self.rank, self.made
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [r * n + i for i, (x, y) in enumerate(zip(symbols, symbols[1:])) if (r := rank[x](y)) is not None]
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i = entry % n
            j, x = after[i], symbols[i]
            if x < 0 or j == n or rank[x](symbols[j]) != entry // n:
                continue  # stale
            x = symbols[i] = made[entry // n]
            symbols[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank[x](symbols[k])) is not None:
                    heappush(queue, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank[symbols[h]](x)) is not None:
                heappush(queue, r * n + h)
        return [x for x in symbols if x >= 0]


def spellings(path: str) -> dict[int, bytes]:
    """The bytes that each id of a byte-level file stands for."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    to_byte = {c: b for b, c in enumerate(byte_letters())}
    named = [*file["model"]["vocab"].items(), *((t["content"], t["id"]) for t in file["added_tokens"])]
    return {i: bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode() for token, i in named}


def decode_ids(spelled: dict[int, bytes], ids: Sequence[int]) -> bytes:
    return b"".join(map(spelled.__getitem__, ids))


class QueueCodec:
    """A worker's encoder: each distinct pre-token is merged once per memory."""

    def __init__(self, path: str) -> None:
        from tokenizers.pre_tokenizers import ByteLevel

        self.vocabulary = Vocabulary(path)
        self._split = ByteLevel(add_prefix_space=False).pre_tokenize_str
        self._letters = {c: b for b, c in enumerate(byte_letters())}
        self.memory = PieceMemory(byte_level_words, self._merged)
        added = sorted(self.vocabulary.added, key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def _merged(self, pieces: list[str]) -> list[list[int]]:
        """A piece of known letters is a pre-token; others are divided by the library's own tables."""
        merge, letters = self.vocabulary.merge, self._letters
        return [merge(p.encode()) if simple(p) else [x for word, _ in self._split(p) for x in merge(bytes(map(letters.__getitem__, word)))]
                for p in pieces]

    def _segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Stretches of ordinary text, each with the added token after it (None: none)."""
        parts = self.added.split(text) if self.added else [text]
        for k in range(0, len(parts), 2):
            *front, last = windows(parts[k])
            for w in front:
                yield w, None
            yield last, self.vocabulary.added[parts[k + 1]] if k + 1 < len(parts) else None

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        rows, held, size = [], [], 0

        def close() -> None:
            ids, count = self.memory.encode([s for s, _ in held])
            at = np.concatenate(([0], np.cumsum(count))).tolist()
            for row, (_, mark), a, b in zip(rows, held, at, at[1:]):
                out[row].append(ids[a:b])
                if mark is not None:
                    out[row].append(np.array([mark], np.uint32))
            rows.clear()
            held.clear()

        for row, text in enumerate(texts):
            for segment in self._segments(text):
                if held and size + len(segment[0]) > SLICE_BYTES:
                    close()
                    size = 0
                rows.append(row)
                held.append(segment)
                size += len(segment[0])
        if held:
            close()
        return [x[0] if len(x) == 1 else np.concatenate([np.zeros(0, np.uint32), *x]) for x in out]


_codecs: dict[str, QueueCodec] = {}


def codec(path: str) -> QueueCodec:
    """The worker's own codec; it outlives a task."""
    if path not in _codecs:
        _codecs[path] = QueueCodec(path)
    return _codecs[path]


def _replaced(batch: pa.RecordBatch, name: str, new: str, values: list, kind: pa.DataType) -> pa.RecordBatch:
    at = batch.schema.get_field_index(name)
    return pa.RecordBatch.from_arrays([pa.array(values, kind) if k == at else c for k, c in enumerate(batch.columns)],
                                      names=[new if k == at else c for k, c in enumerate(batch.schema.names)])


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ids: a text's ids as little-endian unsigned 32-bit integers (binary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            ids = codec(path).encode([t or "" for t in batch.column("ids").to_pylist()])
            yield _replaced(batch, "ids", "ids", [x.astype("<u4").tobytes() for x in ids], pa.binary())

    told = docs.select(*keep, F.col("text").cast("string").alias("ids"))
    return told.mapInArrow(run, told.drop("ids").withColumn("ids", F.lit(None).cast("binary")).schema)


def decode(coded: DataFrame, path: str) -> DataFrame:
    """All columns of ``coded`` and text: what its ids spell; bytes that are no UTF-8 become U+FFFD."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = spellings(path)
        for batch in slices(batches, "ids"):
            out = []
            for raw in batch.column("ids").to_pylist():
                ids = np.frombuffer(raw or b"", "<u4")
                out.append(b"".join(decode_ids(spelled, ids[k:k + STEP].tolist()) for k in range(0, len(ids), STEP)).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "text"])

    return coded.mapInArrow(run, coded.withColumn("text", F.lit("")).schema)
