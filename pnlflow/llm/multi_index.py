"""Approximate nearest neighbours: an inverted multi-index.

Vectors are scaled to length one and cut into two halves; each half has a codebook of its
own, fitted by k-means on a bounded sample.  A cell is a pair of centroids, and every
vector is in one.  A query walks through the cells in the order of the summed distance of
its halves to the two centroids, with a heap over the two sorted centroid lists, until
the cells seen hold a given share of all vectors.  What they hold is ranked again by the
exact cosine in double precision.

The share is not guessed: on the sample it is the share at which the walk meets
``recall`` of the true neighbours (by brute force within the sample), so data without
structure get a long walk and clustered data a short one.

Queries are taken in blocks.  A block goes to each first centroid that it visits, once,
with the queries' vectors and a bit for each second centroid; the vectors lie there in
tiles of bounded size.  A task keeps the best few of each query and passes on nothing
else.  A crowded cell, of copies say, is many tiles.

Defined results: vectors that are null, zero, or hold null or non-finite components take
no part, nor do those whose dimension is not the commonest one (ties: the larger) or
whose id is null.  Rows that share a query's id count as its own row, rows that share another
id as one candidate, with the nearest of their vectors.  Components may be as large or small as
doubles are.  Ties go to the smaller id.  Fewer candidates than asked for: all of them.  No vectors: an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pnlflow.llm.common import stored


@dataclass(frozen=True)
class Settings:
    centroids: int = 64  # of each half
    sample: int = 12_000  # vectors that the codebooks and the share are fitted on, about
    recall: float = 0.95  # of the neighbours within the sample
    trial: int = 256  # queries of the sample
    tile: int = 2048  # vectors
    block: int = 512  # queries
    rounds: int = 10  # of k-means
    seed: int = 5


@dataclass(frozen=True)
class Index:
    left: np.ndarray  # centroids of the first half, row by row
    right: np.ndarray
    share: float


def nearest(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return distances(x, centroids).argmin(axis=1)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(axis=1)[:, None] + (centroids ** 2).sum(axis=1) - 2 * x @ centroids.T, 0)


def k_means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    c = distinct[rng.choice(len(distinct), min(k, len(distinct)), replace=False)].copy()
    for _ in range(rounds):
        a = nearest(x, c)
        n = np.bincount(a, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, a, x)
        c[n > 0] = total[n > 0] / n[n > 0, None]
        if (n == 0).any():  # an idle centroid moves to a vector far from its own
            far = distances(x, c).min(axis=1).argsort()[::-1][:int((n == 0).sum())]
            c[np.flatnonzero(n == 0)[:len(far)]] = x[far]
    return c


def walk(left: np.ndarray, right: np.ndarray, size: np.ndarray, want: float) -> list[tuple[int, int]]:
    """Cells in the order of left[a] + right[b], until they hold ``want`` vectors."""
    a, b = np.argsort(left, kind="stable").tolist(), np.argsort(right, kind="stable").tolist()
    da, db = left[a].tolist(), right[b].tolist()
    heap, out, seen, got = [(da[0] + db[0], 0, 0)], [], {0: 0}, 0
    while heap and got < want:
        _, i, j = heapq.heappop(heap)
        n = int(size[a[i], b[j]])
        if n:
            out.append((a[i], b[j]))
            got += n
        if j + 1 < len(b):
            heapq.heappush(heap, (da[i] + db[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):  # a new row of the grid is begun from its first column only
            heapq.heappush(heap, (da[i + 1] + db[0], i + 1, 0))
    return out


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component near one: exact, and squares
    neither overflow nor vanish."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row; the same two vectors give the same number anywhere."""
    q, x = scaled(q), scaled(x)
    return (q * x).sum(axis=1) / (np.sqrt((q * q).sum(axis=1)) * np.sqrt((x * x).sum(axis=1)))


def fit(sample: np.ndarray, top: int, s: Settings) -> Index:
    rng = np.random.default_rng(s.seed)
    x, half = unit(sample), sample.shape[1] // 2
    left, right = k_means(x[:, :half], s.centroids, s.rounds, rng), k_means(x[:, half:], s.centroids, s.rounds, rng)
    a, b = nearest(x[:, :half], left), nearest(x[:, half:], right)
    size = np.zeros((len(left), len(right)), np.int64)
    np.add.at(size, (a, b), 1)
    need = []
    for q in rng.choice(len(x), min(s.trial, len(x)), replace=False).tolist():
        score = x @ x[q]
        score[q] = -2
        cells = walk(distances(x[q:q + 1, :half], left)[0], distances(x[q:q + 1, half:], right)[0], size, len(x))
        after = dict(zip(cells, np.cumsum([size[c] for c in cells]).tolist()))
        need += [after[a[k], b[k]] for k in np.argsort(-score, kind="stable")[:min(top, len(x) - 1)].tolist()]
    share = float(np.quantile(need, s.recall)) / len(x) if need else 1.0
    return Index(left, right, min(1.0, share * 1.05))


# ---- tasks -----------------------------------------------------------------------------

def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths without nulls as a matrix of doubles."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _assign(index: Index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(_matrix(batch.column("vec")))
            half = x.shape[1] // 2
            a, b = nearest(x[:, :half], index.left), nearest(x[:, half:], index.right)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vec"), batch.column("asks"), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32))],
                                             names=["id", "vec", "asks", "a", "b"])
    return run


def _probe(index: Index, size: np.ndarray, s: Settings):
    want = max(64.0, index.share * size.sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, s.block):
                batch = whole.slice(k, s.block)
                raw = _matrix(batch.column("vec"))
                x, half = unit(raw), raw.shape[1] // 2
                left, right = distances(x[:, :half], index.left), distances(x[:, half:], index.right)
                visits = np.zeros((len(x), len(index.left), len(index.right)), bool)
                for q in range(len(x)):
                    cells = np.array(walk(left[q], right[q], size, want))
                    visits[q, cells[:, 0], cells[:, 1]] = True
                ids = batch.column("id").to_numpy()
                for a in np.flatnonzero(visits.any(axis=(0, 2))).tolist():
                    q = np.flatnonzero(visits[:, a].any(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([a], pa.int32()), pa.array([ids[q].tobytes()], pa.binary()), pa.array([raw[q].tobytes()], pa.binary()),
                         pa.array([np.packbits(visits[q, a], axis=1).tobytes()], pa.binary())], names=["a", "queries", "query_vecs", "visits"])
    return run


def repeated(ids: np.ndarray) -> list[np.ndarray]:
    """The places of each id that occurs twice or more."""
    order = np.argsort(ids, kind="stable")
    edge = np.flatnonzero(np.diff(ids[order], prepend=ids[order[:1]] - 1, append=ids[order[-1:]] + 1)) if len(ids) else np.zeros(0, np.int64)
    return [order[a:b] for a, b in zip(edge.tolist(), edge[1:].tolist()) if b - a > 1]


class _Best:
    """The best few of each query so far."""

    def __init__(self, top: int) -> None:
        self.top, self.rows, self.n = top, [], 0

    def add(self, q: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        self.rows.append((q, ids, score))
        self.n += len(q)
        if self.n > 200_000:
            self.rows, self.n = [self.cut()], 0
            self.n = len(self.rows[0][0]) // 2  # grows at most by half before the next cut

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, ids, score = (np.concatenate(c) for c in zip(*self.rows)) if self.rows else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((-score, ids, q))  # an id counts once, by its nearest vector
        q, ids, score = q[order], ids[order], score[order]
        once = np.ones(len(q), bool)
        once[1:] = (q[1:] != q[:-1]) | (ids[1:] != ids[:-1])
        q, ids, score = q[once], ids[once], score[once]
        order = np.lexsort((ids, -score, q))
        q, ids, score = q[order], ids[order], score[order]
        first = np.searchsorted(q, q, side="left")
        keep = np.arange(len(q)) - first < self.top
        return q[keep], ids[keep], score[keep]


def _rank(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(top)
        for batch in batches:
            for k in range(batch.num_rows):
                r = {c: batch.column(c)[k] for c in batch.schema.names}
                queries, visits = np.frombuffer(r["queries"].as_py(), np.int64), r["visits"].as_py()
                qv = np.frombuffer(r["query_vecs"].as_py()).reshape(len(queries), -1)
                rows = r["rows"].values
                ids, b = rows.field("id").to_numpy(), rows.field("b").to_numpy()
                xv = _matrix(rows.field("vec"))
                seen = np.unpackbits(np.frombuffer(visits, np.uint8).reshape(len(queries), -1), axis=1).astype(bool)[:, b]
                score = np.where(seen & (queries[:, None] != ids), unit(qv) @ unit(xv).T, -9.0)
                thin = score
                if groups := repeated(ids):  # rows of one id count once: the nearest of them
                    thin = score.copy()
                    for same in groups:
                        near = score[:, same] >= score[:, same].max(axis=1, keepdims=True) - 1e-9
                        score[:, same] = np.where(near, score[:, same], -9.0)
                        thin[:, same] = np.where(near & (np.cumsum(near, axis=1) == 1), score[:, same], -9.0)
                edge = np.partition(thin, -top, axis=1)[:, -top] if thin.shape[1] > top else np.full(len(thin), -8.0)
                q, x = np.nonzero(score >= np.maximum(edge - 1e-9, -8.0)[:, None])  # and what rounding may hide
                for j in range(0, len(q), 1 << 16):
                    i, y = q[j:j + (1 << 16)], x[j:j + (1 << 16)]
                    best.add(queries[i], ids[y], cosines(qv[i], xv[y]))
        q, ids, score = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(ids), pa.array(score)], names=["query_id", "vec_id", "score"])
    return run


# ---- the operator ----------------------------------------------------------------------

def neighbours(vectors: DataFrame, id_column: str, vector_column: str, asks: Column, top: int = 5, s: Settings = Settings()) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row where ``asks`` holds the ``top`` nearest
    of all other rows by cosine, as far as the walk meets them."""
    vec = F.col(vector_column).cast("array<double>")
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    rows = (vectors.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec"), F.coalesce(asks, F.lit(False)).alias("asks"))
            .where(F.col("id").isNotNull() & F.col("vec").isNotNull()).where(sound))
    sizes = rows.groupBy(F.size("vec").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    if not sizes:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, n = sizes[0]
    rows = rows.where(F.size("vec") == dim)
    limit = int(min(1.0, s.sample / n) * (1 << 30))
    drawn = rows.where(F.pmod(F.xxhash64("id", F.lit(s.seed)), F.lit(1 << 30)) < limit).select("id", "vec").orderBy(F.xxhash64("id"), "id").limit(2 * s.sample).collect()
    drawn = drawn or rows.select("id", "vec").limit(s.sample).collect()
    index = fit(np.array([r.vec for r in drawn]), top, s)
    placed = stored(rows.mapInArrow(_assign(index), "id long, vec array<double>, asks boolean, a int, b int"), "index")
    size = np.zeros((len(index.left), len(index.right)), np.int64)
    for r in placed.groupBy("a", "b").count().collect():  # one row for each cell, centroids squared at most
        size[r.a, r.b] = r["count"]
    crowd = {a: int(-(-c // s.tile)) for a, c in enumerate(size.sum(axis=1).tolist())}
    parts = F.element_at(F.array(*(F.lit(max(1, crowd[a])) for a in range(len(index.left)))), F.col("a") + 1)
    tiles = (placed.groupBy("a", F.pmod(F.xxhash64("id", "vec"), parts).cast("int").alias("part"))  # copies of a vector have ids of their own
             .agg(F.collect_list(F.struct("id", "vec", "b")).alias("rows")))
    probes = placed.where("asks").select("id", "vec").mapInArrow(_probe(index, size, s), "a int, queries binary, query_vecs binary, visits binary")
    # every tile of a centroid is a key of its own, so no centroid is one task
    found = (tiles.join(probes.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))), ["a", "part"]).select("rows", "queries", "query_vecs", "visits")
             .mapInArrow(_rank(top), "query_id long, vec_id long, score double")
             .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score"))
