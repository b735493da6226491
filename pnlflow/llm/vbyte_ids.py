"""Token ids in binary files: frequency ranks in byte-aligned variable-length coding.

Ids are counted over the corpus and replaced by their rank, the commonest being 0.  Ranks
are written in one to four bytes each; the lengths, two bits each, stand apart in control
bytes, four to a byte, so that decoding is a table lookup of control bytes, a running sum
and a gather, without a loop over values.

A file is a folder of Parquet part files, one for each range of ids in ascending order,
whose rows are blocks: the part and block number, how many ids of the part come before,
the documents and their counts, the control bytes and the data bytes.  ``write`` makes
it, ``read`` gives back every document's ids.  Any store that Spark reaches will do.

Defined results: null and empty texts have the end id alone.  Rows are ordered by doc_id
(null first), equal ids by the hash of their text; rows that agree in both are alike.  An
empty table makes an empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pnlflow.llm.common import SLICE_BYTES, opened, press, slices, stored
from pnlflow.llm.packed import pack, unpack
from pnlflow.llm.word_codec import codec, with_end

#: Words that a worker remembers (some 200 MB).
WORDS = 1_200_000

_SHIFT = np.arange(4, dtype=np.uint8) * 2
#: Control byte -> the lengths of its four values.
LENGTHS = (((np.arange(256)[:, None] >> _SHIFT) & 3) + 1).astype(np.uint8)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    v = values.astype("<u4", copy=False)
    width = max(1, -(-int(v.max(initial=0)).bit_length() // 8))  # bytes of the largest value
    more = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    for k in range(1, width):
        more[:len(v)] += v >= 1 << 8 * k
    four = more.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    end = np.cumsum(more[:len(v)] + 1, dtype=np.int64)
    out = np.empty(int(end[-1]) if len(v) else 0, np.uint8)
    at = end - 1 - more[:len(v)]
    out[at] = v.astype(np.uint8)
    for k in range(1, width):
        some = np.flatnonzero(more[:len(v)] >= k)
        out[at[some] + k] = (v[some] >> 8 * k).astype(np.uint8)
    return control.tobytes(), out.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of control and data bytes."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    at = np.cumsum(size, dtype=np.int64) - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32)
    for k in range(1, int(size.max(initial=1))):
        some = np.flatnonzero(size > k)
        out[some] |= raw[at[some] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def _tokenize(path: str, end: int):
    """Blocks of ids as they are; rows come in order, so a block knows what is before it in its part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for block, batch in enumerate(slices(batches, most=SLICE_BYTES, pressed=True, remembers=True)):
            ids, count = with_end(*codec(path, False, most=WORDS).encode([opened(z) for z in batch.column("text").to_pylist()]), end)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()),
                 pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([count.tolist()], pa.list_(pa.int64())),
                 pa.array([pack(ids.astype(np.uint32))], pa.binary())], names=["part", "block", "before", "doc_ids", "counts", "ids"])
            before += len(ids)
    return run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, np.int64)
    for batch in batches:
        for data in batch.column("ids").to_pylist():
            n = np.bincount(unpack(data, np.uint32), minlength=len(total))
            n[:len(total)] += total
            total = n
    at = np.flatnonzero(total)
    if len(at):
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["id", "n"])


def frequency_ranks(blocks: DataFrame) -> np.ndarray:
    """The ids in the order of their counts over all blocks, ties by id; those that never occur
    come last.  One row for each id of the vocabulary reaches the driver."""
    counted = blocks.select("ids").mapInArrow(_count, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    size = max((r.id + 1 for r in counted), default=1)
    n = np.zeros(size, np.int64)
    for r in counted:
        n[r.id] = r.n
    return np.lexsort((np.arange(size), -n)).astype(np.uint32)


PLACE = "part int, block int, before long, doc_ids array<long>, counts array<long>"
BLOCK = f"{PLACE}, control binary, data binary"


def _encode(order: np.ndarray):
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [encode(rank[unpack(data, np.uint32)]) for data in batch.column("ids").to_pylist()]
            control, data = zip(*made) if made else ((), ())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(control, pa.binary()), pa.array(data, pa.binary())],
                                             names=[x.split()[0] for x in BLOCK.split(", ")])
    return run


def write(docs: DataFrame, tokenizer: str, end: int, path: str) -> None:
    """Write the ids of all documents, each followed by ``end``, below ``path``: ``blocks`` and the
    table of ``ranks``.  Each text is tokenized once; its ids wait, packed, in the shared
    checkpoint folder until all are counted."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"), F.col("text").cast("string").alias("text"))
    ordered = (rows.mapInArrow(press, "doc_id long, tie long, text binary")
               .repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))
    blocks = stored(ordered.mapInArrow(_tokenize(tokenizer, end), f"{PLACE}, ids binary"), "token-ids")
    order = frequency_ranks(blocks)
    spark.createDataFrame([(order.astype("<u4").tobytes(),)], "ids binary").write.parquet(f"{path}/ranks")
    blocks.mapInArrow(_encode(order), BLOCK).write.option("compression", "none").parquet(f"{path}/blocks")


def _read(order: np.ndarray, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k] for c in batch.schema.names}
                count = r["counts"].values.to_numpy()
                ids = order[decode(r["control"].as_py(), r["data"].as_py(), int(count.sum()))].astype("<u4")
                at = np.concatenate(([0], np.cumsum(count)))
                cut = [ids[a:b].tobytes() for a, b in zip(at.tolist(), at[1:].tolist())]
                made = [r["doc_ids"].values, pa.array(at[:-1] + r["first"].as_py() + r["before"].as_py()), pa.array(count),
                        pa.array([zlib.crc32(c) for c in cut], pa.int64())]
                yield pa.RecordBatch.from_arrays(made + [pa.array(cut, pa.binary())] * with_ids,
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids)
    return run


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if wanted, the ids."""
    order = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()[0], "<u4")
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    size = blocks.select("part", "before", F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    # one row for each part file, as many as the writer had partitions
    parts = size.groupBy("part").agg(F.sum("n").alias("n"))
    first = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    return blocks.join(F.broadcast(first), "part").mapInArrow(
        _read(order, with_ids), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
