"""Quality rules: compression bands.

zstandard compresses each whole document and each of its fixed chunks.  Text that
repeats itself compresses too well, noise and encoded data hardly at all; how much is
normal depends on the length, so every length class has its own band of
compressed/original.  A document is kept if its own ratio lies in its band and at most
``chunk_share`` of its chunks lie outside theirs.  Four plain counts (word characters,
symbols, repeated lines, repeated 5-word windows) accompany the verdict and reject the
plainest cases first (``base_failed``).

Defined results: null and empty text have no words, so they fail the base rule.  Rows are
judged one by one: repeated rows, ties and further columns change nothing.  A document is
read whole, however long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.common import numbered, own_numbers, slices, sums, texts, utf8


@dataclass(frozen=True)
class Bands:
    """From this many bytes up: the smallest and the largest normal ratio."""

    #: Prose of one to three languages at zstandard's level 3 lies well inside these.
    limits: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, float("inf")), (64, 0.0, 1.35), (128, 0.42, 1.05), (256, 0.40, 0.95), (512, 0.38, 0.88), (1024, 0.36, 0.80),
        (2048, 0.34, 0.75), (4096, 0.32, 0.72), (8192, 0.29, 0.70), (16384, 0.26, 0.68), (65536, 0.22, 0.66))
    level: int = 3
    chunk: int = 2048
    chunk_share: float = 0.25

    def outside(self, size: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        """-1 below the band (repetitive), 1 above it (incompressible), else 0."""
        start, low, high = (np.array(x) for x in zip(*self.limits))
        k = np.searchsorted(start, size, side="right") - 1
        return np.where(ratio < low[k], -1, np.where(ratio > high[k], 1, 0))


MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_FIRST = (np.arange(256) & 0xC0) != 0x80  # a byte that begins a code point

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_bytes long, zstd_ratio double, n_chunks long, n_low_chunks long, n_high_chunks long")


def window_keys(ids: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """A 64-bit key of each window of words and its document; different windows may share one."""
    m = len(ids) - window + 1
    key = doc[:m].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(window):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + ids[j:m + j].astype(np.uint64)
    return (key ^ (key >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)


def repeated_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, window: int = REPEAT_WINDOW) -> np.ndarray:
    """Per document, the words that lie in a window of words found twice or more in it.
    ids: the words' numbers, documents one after another; doc: each word's document."""
    m = len(ids) - window + 1
    if m < 2:
        return np.zeros(n_docs, np.int64)
    key = window_keys(ids, doc, window)
    whole = doc[:m] == doc[window - 1:]
    at = np.flatnonzero(whole)
    order = at[np.argsort(key[at], kind="stable")]
    a, b = order[:-1], order[1:]
    same = key[a] == key[b]
    a, b = a[same], b[same]
    equal = doc[a] == doc[b]
    for j in range(window):
        equal &= ids[a + j] == ids[b + j]
    if not equal.all():  # two windows share a 64-bit key: compare the windows themselves
        rows = np.stack([doc[at], *(ids[at + j] for j in range(window))], axis=1)
        _, inverse, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        hit = at[count[inverse.ravel()] > 1]
    else:
        hit = np.union1d(a, b)
    cover = np.zeros(len(ids) + 1, np.int64)
    cover[hit] += 1
    np.subtract.at(cover, hit + window, 1)
    return np.bincount(doc, weights=np.cumsum(cover[:-1]) > 0, minlength=n_docs).astype(np.int64)


def _judge(bands: Bands, whole_rows: bool = False):
    """Verdicts, or with ``whole_rows`` the input's rows that are kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=bands.level)
        size = lambda b: len(press.compress(b))
        for batch in slices(batches, most=1 << 20):
            data, at = utf8(batch.column("text"))
            docs, n = texts(batch.column("text")), batch.num_rows
            known, words, n_words = own_numbers(), [], np.zeros(n, np.int64)
            dup = np.zeros(n, np.int64)
            for i, b in enumerate(docs):
                w = b.split()  # exactly the separators 20 and 09-0D
                n_words[i] = len(w)
                words.append(numbered(w, known, len(w)))
                lines = [x for x in b.split(b"\n") if x and not x.isspace()]
                dup[i] = len(lines) - len(set(lines))
            ids = np.concatenate(words) if words else np.zeros(0, np.int64)
            repeat = repeated_words(ids, np.repeat(np.arange(n), n_words), n)
            chars = sums(_FIRST[data] & ~_SPACE[data], at)
            symbols = sums(_SYMBOL[data], at)
            n_bytes = np.diff(at)
            whole = np.array([size(b) for b in docs], np.float64) / np.maximum(n_bytes, 1)
            pieces = [(i, b[k:k + bands.chunk]) for i, b in enumerate(docs) for k in range(0, len(b), bands.chunk)]
            owner = np.array([i for i, _ in pieces], np.int64)
            long = np.array([len(b) for _, b in pieces], np.int64)
            side = bands.outside(long, np.array([size(b) for _, b in pieces], np.float64) / np.maximum(long, 1))
            n_chunks = np.bincount(owner, minlength=n)
            low, high = (np.bincount(owner[side == s], minlength=n) for s in (-1, 1))
            failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
            kept = ~failed & (bands.outside(n_bytes, whole) == 0) & (low + high <= bands.chunk_share * n_chunks)
            if whole_rows:
                yield batch.filter(pa.array(kept))
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), *(pa.array(x.astype(np.int64)) for x in (n_words, chars, symbols, dup, repeat)),
                 pa.array(failed), pa.array(kept), pa.array(n_bytes), pa.array(whole), *(pa.array(x.astype(np.int64)) for x in (n_chunks, low, high))],
                names=[x.split()[0] for x in SCHEMA.split(", ")])
    return run


def compression_bands(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """One row per document: the counts, the ratios and the verdict (``kept``).  No shuffle."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_judge(bands), SCHEMA)


def kept_rows(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The rows of ``docs`` whose text is kept, with all their columns.  No shuffle."""
    return docs.mapInArrow(_judge(bands, whole_rows=True), docs.schema)
