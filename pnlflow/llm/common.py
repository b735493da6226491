"""Helpers shared by the operators: stored cuts, batches of bounded size, byte views."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pnlflow.session import ensure_checkpoint_dir

#: Bytes of text that one numpy step works on; bounds a task's memory.
SLICE_BYTES = 4 << 20


def reach(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if it is not installed
    (on a cluster: a shared path, or ``--py-files``)."""
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    reach(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared checkpoint folder, all of one application below one folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet to the shared checkpoint folder and read it
    again.  Later readers prune columns; a lost executor costs a re-read, not a recompute."""
    path = scratch_path(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove what ``stored`` has written in this application.  Call it when every result
    that depends on stored tables has been consumed."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark)}/llm-{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remainder_of_id(key: str, n: int) -> Column:
    """crc32 of the id written as text, modulo n (null id: 0)."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(0)) % n


#: What a worker remembers from task to task, some hundred megabytes.
_remembered: list[dict] = []


def remembered() -> dict:
    """A dict that outlives a task, until the worker has one that does not use it (see ``slices``)."""
    _remembered.append({})
    return _remembered[-1]


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES, pressed: bool = False, remembers: bool = False) -> Iterator[pa.RecordBatch]:
    """The batches cut into row ranges of at most ``most`` bytes of ``column`` (one row at least);
    ``pressed``: of what its values open to, as their frames say; ``remembers``: for a task that uses
    what others left in memory, which goes otherwise."""
    if not remembers and any(_remembered):
        for d in _remembered:
            d.clear()
        give_back()
    for batch in batches:
        if pressed:
            size = np.fromiter((zstandard.frame_content_size(z) if z else 0 for z in batch.column(column).to_pylist()), np.int64, batch.num_rows)
        else:
            size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        end, start, n = np.cumsum(size), 0, batch.num_rows
        while start < n:
            before = end[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(end, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop
    give_back()


def give_back() -> None:
    """Hand freed memory back to the system: Python workers outlive their tasks, and an executor's
    workers share its limit with the JVM."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array (null: empty), and where each value starts and the last ends."""
    array = pc.fill_null(array, "")
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, where, data = array.buffers()
    at = np.frombuffer(where, dtype=np.int64 if wide else np.int32)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    if data is None or not len(array):
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def press(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, so that a shuffle of them is small."""
    squeeze = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches):
        raw = batch.column("text").cast(pa.binary())
        yield batch.set_column(batch.schema.get_field_index("text"), "text",
                               pa.array([None if b is None else squeeze.compress(b) for b in raw.to_pylist()], pa.binary()))


def opened(z: bytes | None) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z) if z else b""


def texts(array: pa.Array) -> list[bytes]:
    """Each value as UTF-8 bytes (null: empty)."""
    data, at = utf8(array)
    raw = data.tobytes()
    at = at.tolist()
    return [raw[a:b] for a, b in zip(at, at[1:])]


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of ``values`` over each range of ``at`` (empty ranges: 0)."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def numbered(words: Iterable[bytes], known: dict, n: int = -1) -> np.ndarray:
    """A number for each word; ``known`` is a dict as ``own_numbers`` makes it."""
    return np.fromiter(map(known.__getitem__, words), np.int64, n)


def own_numbers() -> dict:
    """A dict that numbers new keys in the order of their first use."""
    from collections import defaultdict
    from itertools import count

    return defaultdict(count().__next__)  # not its own length: a dict that holds itself waits for the collector


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts c: each row number repeated c times, and 0..c-1 within each row."""
    counts = np.asarray(counts, np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.cumsum(counts) - counts
    return row, np.arange(len(row)) - start[row]


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file is: in $LLM_TOKENIZERS, else in the installed package."""
    if folder := os.environ.get("LLM_TOKENIZERS"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)
