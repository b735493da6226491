"""What each filter of a chain removes, in every order of the chain.

1.  *Judge.*  Four filters look at one text alone, the fifth at the texts of smaller ids.  Only the
    verdicts, the id and a digest of the text go on.
2.  *List.*  Documents are dealt out by ranges of (part, id) of equal size, so a part that holds most
    rows is many ranges.  Within a range of at most ``run`` documents each filter has a sorted
    posting list of the documents that fail it.
3.  *Merge.*  Galloping k-way merges give the union of the lists of each set of filters, and each
    filter's difference to the union of any other filters: what it still removes after them.
    Ranges hold different documents, so the sizes of all ranges are summed.
4.  *Order.*  A step of an order is one (filter, filters before it), so all orders read the sums.

Defined results: null and empty texts are equal and have no words.  A null part is the empty string.
Rows are documents: a repeated id is listed as often as it occurs (entries are places in the order of
ids, not ids).  A row without id fails no comparison with smaller ids, is nobody's smaller row and has
no label; rows of one id are not smaller than each other.  A document is good (toxic) if any of its
label rows says so.  Further columns are ignored.  Long texts are read in windows; memory holds one text
and its distinct words.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator, Sequence
from itertools import permutations

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.common import SLICE_BYTES, slices, stored, texts

#: The filters in the order of their bits: few words, repeated words, capitals, symbols, copy of an earlier text.
FILTERS = "ABCDE"
#: Documents of one set of posting lists.
RUN = 1 << 16

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_CAPITALS, _SYMBOLS, _FOLLOWING = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))


def words(text: bytes, most: int = SLICE_BYTES) -> tuple[int, int]:
    """How many words a text has, and how many different ones; read in windows cut at white space."""
    n, seen, at = 0, set(), 0
    while at < len(text):
        cut = _SPACE.search(text, at + most) if at + most < len(text) else None
        end = cut.start() if cut else len(text)
        found = text[at:end].split()  # of bytes: at the same six characters
        n += len(found)
        seen.update(found)
        at = end + 1
    return n, len(seen)


def _without(text: bytes, chars: bytes) -> int:
    return len(text.translate(None, chars))


def verdicts(text: bytes) -> int:
    """Bits of the filters A to D that a text fails."""
    n, different = words(text)
    capitals, points = len(text) - _without(text, _CAPITALS), _without(text, _FOLLOWING)
    return ((n < 200) | (100 * different < 50 * n) << 1 | (100 * capitals > 3 * points) << 2
            | (_without(text, _SYMBOLS) < len(text)) << 3)


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 32
    for batch in slices(batches):
        raw = texts(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(range(row, row + len(raw)), pa.int64()),
             pa.array([verdicts(t) for t in raw], pa.int32()), pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary())],
            names=["doc_id", "part", "row", "fails", "digest"])
        row += len(raw)


def gallop(ids: Sequence[int], value: int, at: int) -> int:
    """The first place from ``at`` on whose id is not below ``value``: doubled steps, then halves."""
    step, far = 1, at
    while far < len(ids) and ids[far] < value:
        at, far, step = far + 1, far + step, 2 * step
    return bisect_left(ids, value, at, min(far, len(ids)))


def union(lists: Iterable[Sequence[int]]) -> list[int]:
    """K-way merge of sorted lists without repeats: the list of the least head gives all below the next head."""
    queue = [(ids[0], 0, k, ids) for k, ids in enumerate(lists) if len(ids)]
    heapq.heapify(queue)
    out: list[int] = []
    while len(queue) > 1:
        head, at, k, ids = heapq.heappop(queue)
        if head == queue[0][0]:  # the other list gives it
            end = at + 1
        else:
            end = gallop(ids, queue[0][0], at)
            out += ids[at:end]
        if end < len(ids):
            heapq.heappush(queue, (ids[end], end, k, ids))
    for _, at, _, ids in queue:
        out += ids[at:]
    return out


def difference(ids: Sequence[int], gone: Sequence[int]) -> list[int]:
    """What of one sorted list another lacks; both sides gallop over what the other side skips."""
    out, i, j = [], 0, 0
    while i < len(ids) and j < len(gone):
        if ids[i] < gone[j]:
            end = gallop(ids, gone[j], i)
            out += ids[i:end]
            i = end
        elif gone[j] < ids[i]:
            j = gallop(gone, ids[i], j)
        else:
            i, j = i + 1, j + 1
    out += ids[i:]
    return out


def audit_run(fails: Sequence[int], good: bytes, toxic: bytes, n_filters: int = len(FILTERS)) -> list[tuple[int, ...]]:
    """For each filter and each set of others before it: filter, set, documents, size of the set's
    union, what the filter removes after them, good and toxic ones among these."""
    posts = [[k for k, f in enumerate(fails) if f >> x & 1] for x in range(n_filters)]
    out = []
    for before in range(1 << n_filters):
        gone = union([posts[x] for x in range(n_filters) if before >> x & 1])
        for x in range(n_filters):
            if not before >> x & 1:
                removed = difference(posts[x], gone)
                out.append((x, before, len(fails), len(gone), len(removed), sum(map(good.__getitem__, removed)),
                            sum(map(toxic.__getitem__, removed))))
    return out


_SIZES = pa.schema([("part", pa.string()), ("filter", pa.int32()), ("before", pa.int32()), ("docs", pa.int64()), ("gone", pa.int64()),
                    ("removed", pa.int64()), ("good_lost", pa.int64()), ("toxic_lost", pa.int64())])


def _audit(run: int):
    """Rows come sorted by part and id; a set of posting lists covers at most ``run`` of one part."""
    def close(part: str, kept: list) -> pa.RecordBatch:
        fails, good, toxic = zip(*kept)
        rows = audit_run(fails, bytes(good), bytes(toxic))
        return pa.RecordBatch.from_arrays([pa.array([part] * len(rows), pa.string()), *(pa.array(c, f.type) for c, f in zip(zip(*rows), list(_SIZES)[1:]))],
                                          schema=_SIZES)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, kept = None, []
        for batch in batches:
            for p, *row in zip(*(batch.column(c).to_pylist() for c in ("part", "fails", "good", "toxic"))):
                if kept and (p != part or len(kept) == run):
                    yield close(part, kept)
                    kept = []
                part = p
                kept.append(row)
        if kept:
            yield close(part, kept)
    return work


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, part, row, fails (bits of FILTERS), good, toxic."""
    one = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                             F.col("text").cast("string").alias("text"))
                 .mapInArrow(_judge, "doc_id long, part string, row long, fails int, digest binary"), "verdicts")
    # the least id of each text; matched by id and text, so that a text with many copies is no hot key
    first = one.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    copy = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return (one.join(first, ["doc_id", "digest"], "left").join(said, "doc_id", "left")
            .select("doc_id", "part", "row", F.col("fails").bitwiseOR(F.when(copy, 16).otherwise(0)).alias("fails"),
                    F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))


def interactions(judged: DataFrame, run: int = RUN) -> DataFrame:
    """part, filter, before, docs, gone, removed, good_lost, toxic_lost: all sets of filters before each
    filter, summed over the id ranges of a part."""
    shape = "part string, filter int, before int, docs long, gone long, removed long, good_lost long, toxic_lost long"
    dealt = stored(judged, "judged").repartitionByRange("part", "doc_id", "row").sortWithinPartitions("part", "doc_id", "row")
    return (dealt.select("part", "fails", "good", "toxic").mapInArrow(_audit(run), shape)
            .groupBy("part", "filter", "before").agg(*(F.sum(c).alias(c) for c in ("docs", "gone", "removed", "good_lost", "toxic_lost"))))


def audit(docs: DataFrame, labels: DataFrame, run: int = RUN) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley:
    one row per part, order of the filters and step."""
    spark, n = docs.sparkSession, len(FILTERS)
    sums = stored(interactions(judge(docs, labels), run), "interactions")
    orders = spark.createDataFrame(
        [("".join(FILTERS[x] for x in order), step + 1, x, sum(1 << y for y in order[:step])) for order in permutations(range(n)) for step, x in enumerate(order)],
        "filter_order string, step int, filter int, before int")  # n! * n rows
    others = F.lit((1 << n) - 1) - F.expr("shiftleft(1, filter)")
    # a set of k filters stands before a filter in k! (n - 1 - k)! orders
    weight = F.element_at(F.array(*(F.lit(math.factorial(k) * math.factorial(n - 1 - k)) for k in range(n))), F.bit_count("before") + 1)
    own = sums.groupBy("part", "filter").agg(F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("failing"),
                                             F.sum(F.when(F.col("before") == others, F.col("removed"))).alias("unique_fails"),
                                             F.sum(F.col("removed") * weight).alias("shapley"))
    return (sums.join(own, ["part", "filter"]).join(F.broadcast(orders), ["filter", "before"])
            .select("part", "filter_order", "step", (F.col("docs") - F.col("gone") - F.col("removed")).alias("kept"), "removed",
                    (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley"))
