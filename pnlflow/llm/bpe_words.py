"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1.  *Explode.*  Texts are split into pre-tokens.  A block of documents keeps their
    positions as numbers into its own list of distinct pre-tokens; the list itself is
    dealt out by word hash, one row for each block and hash bucket.  A word leaves a
    block once, however often it occurs there, so no word is hot.
2.  *Encode.*  A bucket sees all blocks' words of its hashes and encodes each distinct
    one once, with tiktoken's merges.
3.  *Join back.*  The ids return to the blocks in the order of the words, and every
    position takes its word's ids.  Decoding looks ids up in the table of token bytes, a
    fixed few hundred kilobytes.

Blocks are stored in the shared checkpoint folder, so that a lost executor never sees a
block cut differently the second time.

Defined results: null and empty texts have no ids.  Rows are encoded one by one; repeated
rows, ties and further columns change nothing.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.common import slices, stored, texts
from pnlflow.llm.packed import by_count, pack, pack_strings, unpack, unpack_strings
from pnlflow.llm.vbyte_ids import decode as decode_small
from pnlflow.llm.vbyte_ids import encode as encode_small
from pnlflow.llm.word_codec import PieceCodec, _Numbers

#: Splits a text before the merges; a fixed value of these vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Bytes of text in a block: the larger, the fewer times a word travels.
BLOCK_BYTES = 32 << 20


class _Words(PieceCodec):
    """Numbers pre-tokens in the order of their first use."""

    def __init__(self, pattern: str) -> None:
        self.words, self.find = _Numbers(), regex.compile(pattern).findall
        super().__init__(keeps_space=True)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [[self.words[w] for w in self.find(t)] for t in texts]


def merges(path: str) -> dict[bytes, int]:
    """The rank file: token bytes -> id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_encodings: dict = {}


def _encoding(path: str, pattern: str):
    import tiktoken

    if (path, pattern) not in _encodings:
        _encodings[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=merges(path), special_tokens={})
    return _encodings[path, pattern]


def _explode(pattern: str, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        kinds = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("counts", pa.binary()),
                           ("homes", pa.binary()), ("data", pa.binary())])
        for k, batch in enumerate(slices(batches, most=BLOCK_BYTES)):
            block, words = task << 32 | k, _Words(pattern)
            parts = [words.encode(texts(b.column("text"))) for b in slices([batch])]
            place, listed = by_count(np.concatenate([p[0] for p in parts]), len(words.words))
            all_words = list(words.words)
            byte = [all_words[i].encode() for i in listed.tolist()]
            home = (np.fromiter(map(zlib.crc32, byte), np.int64, len(byte)) % buckets).astype(np.uint32)
            order = np.argsort(home, kind="stable")  # by bucket, then by number
            rows = [{"block": block, "bucket": -1, "doc_ids": batch.column("doc_id").to_pylist(),
                     "counts": pack(np.concatenate([p[1] for p in parts])), "homes": pack(home), "data": pack_strings([*encode_small(place)])}]
            edge = np.searchsorted(home[order], np.arange(buckets + 1))
            rows += [{"block": block, "bucket": b, "data": pack_strings([byte[i] for i in order[edge[b]:edge[b + 1]].tolist()])}
                     for b in range(buckets) if edge[b] < edge[b + 1]]
            yield pa.RecordBatch.from_pylist(rows, schema=kinds)
    return run


def _encode(path: str, pattern: str):
    """Rows come sorted by bucket; the words of one bucket are encoded once each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, bucket, known = _encoding(path, pattern), None, {}
        for batch in batches:
            out = []
            for b, data in zip(batch.column("bucket").to_pylist(), batch.column("data").to_pylist()):
                if b != bucket:
                    bucket, known = b, {}
                got = []
                for w in unpack_strings(data):
                    if (ids := known.get(w)) is None:
                        ids = known[w] = enc.encode_ordinary(w.decode("utf-8"))
                    got.append(ids)
                size = np.fromiter(map(len, got), np.uint32, len(got))
                ids = np.fromiter((x for y in got for x in y), np.uint32, int(size.sum()))
                out.append((pack(size), pack_strings([*encode_small(ids)])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("bucket"), *(pa.array(c, pa.binary()) for c in zip(*out))] if out else
                [pa.array([], k) for k in (pa.int64(), pa.int32(), pa.binary(), pa.binary())], names=["block", "bucket", "sizes", "ids"])
    return run


def _reassemble(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        byte = {i: b for b, i in merges(path).items()}
        for batch in batches:
            for r in range(batch.num_rows):
                doc_ids, counts, homes, data, answers = (batch.column(c)[r].as_py() for c in ("doc_ids", "counts", "homes", "data", "answers"))
                number = np.argsort(unpack(homes, np.uint32), kind="stable").tolist()  # words were sent by bucket, then by number
                size, text, spelled = (np.empty(len(number), k) for k in (np.int64, object, object))
                k = 0
                for a in sorted(answers or [], key=lambda a: a["bucket"]):
                    end = np.cumsum(unpack(a["sizes"], np.uint32)).tolist()
                    ids = decode_small(*unpack_strings(a["ids"]), end[-1]).tolist()
                    for x, y in zip([0, *end], end):
                        w, i = ids[x:y], number[k]
                        size[i], text[i], spelled[i] = y - x, b"".join([byte[j] for j in w]), ("%d," * (y - x) % tuple(w)).encode()
                        k += 1
                n = unpack(counts, np.int64)
                place = decode_small(*unpack_strings(data), int(n.sum()))
                edge = np.concatenate(([0], np.cumsum(n))).tolist()
                rows = []
                for a, b in zip(edge, edge[1:]):
                    at = place[a:b]
                    line = b"".join(spelled[at].tolist())[:-1]
                    row = (int(size[at].sum()), hashlib.sha256(line).hexdigest(), hashlib.sha256(b"".join(text[at].tolist())).hexdigest())
                    rows.append(row + (np.array(line.split(b","), np.int64).tolist() if line else [],) * with_ids)
                cols = list(zip(*rows)) or [()] * (3 + with_ids)
                kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                                 names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)
    return run


def encode(docs: DataFrame, path: str, pattern: str = PATTERN, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256 (of the
    bytes the ids decode to) and, if wanted, the ids."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                    .mapInArrow(_explode(pattern, buckets), "block long, bucket int, doc_ids array<long>, counts binary, homes binary, data binary"), "blocks")
    answers = (blocks.where("bucket >= 0").select("block", "bucket", "data").repartition(buckets, "bucket").sortWithinPartitions("bucket")
               .mapInArrow(_encode(path, pattern), "block long, bucket int, sizes binary, ids binary")
               .groupBy("block").agg(F.collect_list(F.struct("bucket", "sizes", "ids")).alias("answers")))  # bounded by a block
    return (blocks.where("bucket < 0").select("block", "doc_ids", "counts", "homes", "data").join(answers, "block", "left")
            .select("doc_ids", "counts", "homes", "data", "answers")
            .mapInArrow(_reassemble(path, with_ids),
                        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<long>" * with_ids))
