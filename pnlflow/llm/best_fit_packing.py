"""Best-fit packing by exact complements.

Documents become token ids plus an end id; those longer than a sequence are cut, the
first piece taking the remainder.  What then matters of a piece is its length, and there
are no more lengths than a sequence has places.  So the plan is made on the counts of the
lengths: single lengths, pair sums and triple sums are looked up for the exact complement
of each gap, and each combination is used as often as the counts allow; what remains is
packed by best fit, again a whole combination at a time.  Every step leaves fewer pieces of
some length than it takes, so the plan has a few thousand entries, whatever the corpus.  Pieces find their place by
their rank among the pieces of their length; ranks are counted in salted groups, so that
one very common length is spread over many tasks.

Defined results: null and empty texts are one piece, the end id.  Rows that repeat are
pieces of their own; which of two equal pieces comes first is of no effect.  An empty
table packs into nothing.  A text is never dropped or cut short.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pnlflow.llm.common import slices, spread, stored, texts
from pnlflow.llm.word_codec import WORDS, codec, with_end

SEQUENCE = 2048
#: Pieces of one length that one task ranks, about.
RANKED = 200_000


def _pieces(path: str, end: int, size: int, with_ids: bool, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20, remembers=True):
            ids, count = with_end(*codec(path, True, most=words).encode(texts(batch.column("text"))), end)
            n = -(-count // size)
            doc, piece = spread(n)
            head = count - (n - 1) * size  # the first piece takes the remainder
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * size)
            length = np.where(piece == 0, head[doc], size)
            begin = (np.cumsum(count) - count)[doc] + start
            raw = ids.astype("<u4")
            cut = [raw[a:a + b].tobytes() for a, b in zip(begin.tolist(), length.tolist())]
            made = [batch.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                    pa.array([zlib.crc32(c) for c in cut], pa.int64())]
            yield pa.RecordBatch.from_arrays(made + [pa.array(cut, pa.binary())] * with_ids,
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
    return run


def pieces(docs: DataFrame, path: str, end: int = 0, size: int = SEQUENCE, with_ids: bool = False, words: int = WORDS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if wanted, the ids (little-endian, 4 bytes each).
    words: how many a worker remembers."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_pieces(path, end, size, with_ids, words),
                        "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids))


# ---- the plan --------------------------------------------------------------------------

def combinations(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """counts[l]: pieces of length l.  Returns combinations of lengths and how often each is used;
    together they use every piece."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[tuple[int, ...], int]] = []

    def take(*lengths: int) -> bool:
        use = Counter(lengths)
        times = min(left[x] // k for x, k in use.items())
        if times > 0:
            out.append((lengths, int(times)))
            for x, k in use.items():
                left[x] -= k * times
        return times > 0

    def pair(total: int, most: int) -> Iterator[tuple[int, int]]:
        """Available lengths b >= c that sum to total, b at most ``most``, the largest b first."""
        b = np.arange(min(most, total - 1), (total + 1) // 2 - 1, -1)
        for x in b[(left[b] > 0) & (left[total - b] > 0)].tolist() if len(b) else []:
            yield x, total - x

    if left[size]:
        take(size)
    for a in range(size - 1, (size + 1) // 2 - 1, -1):  # single complements
        if left[a] and left[size - a]:
            take(a, size - a)
    for a in range(size - 1, 0, -1):  # pair sums
        for b, c in pair(size - a, a) if left[a] else ():
            take(a, b, c)
            if not left[a]:
                break
    for a in range(size - 1, 0, -1):  # triple sums
        for b in range(min(a, size - a - 2), 0, -1) if left[a] else ():
            if not left[a]:
                break
            if not left[b]:
                continue
            for c, d in pair(size - a - b, b):
                take(a, b, c, d)
                if not left[a] or not left[b]:
                    break
    for a in range(size, 0, -1):  # best fit for the rest
        while left[a]:
            chosen, gap, free = [a], size - a, left.copy()
            free[a] -= 1
            while gap:
                fits = np.flatnonzero(free[1:gap + 1])
                if not len(fits):
                    break
                b = int(fits[-1]) + 1
                k = int(min(gap // b, free[b]))
                chosen += [b] * k
                free[b] -= k
                gap -= k * b
            take(*chosen)
    return out


def layout(plan: list[tuple[tuple[int, ...], int]]) -> dict[str, np.ndarray]:
    """For each length in turn, ranges of ranks: rank r of a range goes to sequence
    first + (r - rank) // per at offset + (r - rank) % per * length."""
    rows, used, sequence = [], Counter(), 0
    for lengths, times in plan:
        offset = 0
        for length, per in Counter(lengths).items():
            rows.append((length, used[length], sequence, per, offset))
            used[length] += per * times
            offset += length * per
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "first", "per", "offset"), table.T))


def _place(plan: dict[str, np.ndarray], columns: list[str]):
    key = plan["length"] << 44 | plan["rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(key, length << 44 | rank, side="right") - 1
            inside = rank - plan["rank"][k]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in columns]
                + [pa.array(plan["first"][k] + inside // plan["per"][k]), pa.array(plan["offset"][k] + inside % plan["per"][k] * length)],
                names=columns + ["sequence_id", "offset"])
    return run


def pack(found: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """found: rows with doc_id, piece and length (1 to size).  Adds sequence_id and offset."""
    counts = np.zeros(size + 1, np.int64)
    for r in found.groupBy("length").count().collect():  # one row for each length, ``size`` at most
        counts[r[0]] = r[1]
    plan = layout(combinations(counts, size))
    salts = int(max(1, -(-counts.max() // RANKED))) * 8
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before")))
    ranked = (salted.withColumn("nth", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1)
              .join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("nth")).drop("salt", "before", "nth"))
    columns = found.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema) + ", sequence_id long, offset long"
    return ranked.select(*columns, "rank").mapInArrow(_place(plan, columns), schema)


def pack_documents(docs: DataFrame, path: str, end: int = 0, size: int = SEQUENCE, with_ids: bool = False, words: int = WORDS) -> DataFrame:
    """Tokenize, cut and pack: one row per piece, with its ids if wanted."""
    return pack(stored(pieces(docs, path, end, size, with_ids, words), "pieces"), size)
