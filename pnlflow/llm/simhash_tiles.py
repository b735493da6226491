"""SimHash near-dedup: tiled exact comparison.

Every text gets a 64-bit fingerprint: the majority, bit by bit, over the XXH64 of its
shingles.  Equal fingerprints are one row from then on.  The distinct fingerprints are
laid out in tiles by the population counts of their four 16-bit quarters.  Two
fingerprints within d bits have quarter counts that differ by d in all at most, so a pair
of tiles whose counts differ by more is skipped; all other tile pairs are compared whole
with numpy's exclusive-or and bit count.  A tile holds at most about ``tile`` rows, a
crowded cell is split into many, so no task sees an unbounded group.  From a tile pair
only a spanning forest of its links leaves the task, and connected components of those
forests are the groups.

Defined results: null and empty texts (no words) have fingerprint 0 and link like any
other.  Rows that repeat belong to the same component, and rows that share an id are linked
by their texts only.  Components are those of the rows with an id, and a component_id is the
smallest id in it; a row without doc_id gets a fingerprint, and the component of that
fingerprint if a row with an id has the same one, else null.  ``one_of_each_group`` groups
all rows alike.  An empty table gives an empty result; further columns are ignored.

The comparison is exact and so its work grows with the square of the distinct
fingerprints, less what the tiles skip (about 97 % of the pairs for spread-out bits).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.common import slices, stored, texts
from pnlflow.llm.components import components

SHINGLE, RADIUS, TILE, SEED = 3, 2, 2048, 42
PARTS, PART_BITS = 4, 16


#: Byte -> its eight bits as eight counters of a byte each.
_LANES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def ones(hashes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits is set, over consecutive ranges of ``count`` hashes."""
    blocks = -(-count // 255)  # a counter of one byte holds 255
    row = np.repeat(np.arange(len(count)), blocks)
    first = np.cumsum(blocks) - blocks
    start = (np.cumsum(count) - count)[row] + (np.arange(len(row)) - first[row]) * 255
    part = np.add.reduceat(_LANES[hashes.view(np.uint8).reshape(-1, 8)], start, axis=0)
    return np.add.reduceat(np.ascontiguousarray(part).view(np.uint8).astype(np.int64), first, axis=0)


def _marked(shingle: int):
    """The other columns as they are, and for ``text`` its fingerprint ``fp``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh64_intdigest
        for batch in slices(batches, most=1 << 20):
            hashes: list[int] = []
            count = np.zeros(batch.num_rows, np.int64)
            for i, b in enumerate(texts(batch.column("text"))):
                words = b.lower().split()  # bytes: A-Z only, and exactly the separators 20 and 09-0D
                if not words:
                    continue
                line = b" ".join(words)
                end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                start = np.concatenate(([0], end[:-1] + 1)).tolist()
                last = end.tolist()[min(shingle, len(words)) - 1:]
                hashes += [digest(line[p:q], SEED) for p, q in zip(start, last)]
                count[i] = len(last)
            out = np.zeros(batch.num_rows, np.uint64)
            if hashes:
                some = np.flatnonzero(count)
                over = (2 * ones(np.array(hashes, np.uint64), count[some]) > count[some, None]).astype(np.uint8)
                out[some] = np.packbits(over, axis=1, bitorder="little").view(np.uint64).ravel()
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(out.view(np.int64))], names=[*others, "fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint ``fp`` (the 64 bits as a long) of each whole text."""
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(_marked(shingle), "doc_id long, fp long"))


def steps(radius: int) -> list[tuple[int, ...]]:
    """The differences of quarter counts that ``radius`` bits can make, one of each pair +x, -x."""
    near = [d for d in product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, d)) <= radius]
    return [d for d in near if d >= (0,) * PARTS]


def _cell(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, PART_BITS * k).bitwiseAND(F.lit((1 << PART_BITS) - 1))).cast("int") for k in range(PARTS)]


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """The smallest row of each row's component, for rows 0..n-1 and links i-j."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, least)
        np.minimum.at(new, j, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for name in ("left", "right"):
                column = batch.column(name)
                fp, ids = (column.values.field(k).to_numpy(zero_copy_only=False) for k in ("fp", "id"))
                sides.append((fp.view(np.uint64), ids, column.offsets.to_pylist()))
            (xs, xi, xo), (ys, yi, yo) = sides
            got: list[np.ndarray] = []
            for k in range(batch.num_rows):
                i, j = np.nonzero(np.bitwise_count(xs[xo[k]:xo[k + 1], None] ^ ys[None, yo[k]:yo[k + 1]]) <= radius)
                if len(i):
                    ids = np.concatenate([xi[xo[k]:xo[k + 1]], yi[yo[k]:yo[k + 1]]])
                    label = forest(i, j + xo[k + 1] - xo[k], len(ids))
                    got.append(np.stack([ids, ids[label]])[:, ids != ids[label]])
            pairs = np.concatenate(got, axis=1) if got else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
    return run


def links(points: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """points: distinct fingerprints ``fp``, each with its ``id``.  Returns (a, b) ids whose
    connected components are those of all pairs at ``radius`` or fewer differing bits."""
    cells = points.select("fp", "id", F.array(*_cell(F.col("fp"))).alias("cell"))
    # at most 17^4 cells of a few bytes each, whatever the corpus: safe to broadcast
    crowd = cells.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("tiles"))
    tiles = stored(cells.join(F.broadcast(crowd), "cell")
                   .groupBy("cell", F.pmod(F.xxhash64("fp"), F.col("tiles")).alias("part"))
                   .agg(F.collect_list(F.struct("fp", "id")).alias("rows")), "tiles")
    near = F.array(*(F.struct(F.lit(k).alias("step"), F.array(*(F.col("cell")[p] + F.lit(x) for p, x in enumerate(d))).alias("cell"))
                     for k, d in enumerate(steps(radius))))
    left = tiles.select("part", F.col("rows").alias("left"), F.explode(near).alias("to")).select(
        "part", "left", F.col("to.step").alias("step"), F.col("to.cell").alias("cell"))
    right = tiles.select("cell", F.col("part").alias("other"), F.col("rows").alias("right"))
    own = steps(radius).index((0,) * PARTS)
    pairs = left.join(right, "cell").where((F.col("step") != own) | (F.col("other") >= F.col("part")))
    return pairs.select("left", "right").mapInArrow(_compare(radius), "a long, b long").where("a <> b")


def _grouped(marks: DataFrame, radius: int, tile: int) -> DataFrame:
    """marks: rows with ``doc_id`` and ``fp``.  For each distinct fingerprint its group's ``root``
    (the least fingerprint of the group) and ``component_id`` (the least id, null if none has one).
    The fingerprints are the graph's nodes, so rows that share an id link nothing."""
    points = stored(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    group = components(links(points.select("fp", F.col("fp").alias("id")), radius, tile))
    rooted = stored(points.join(group, points["fp"] == group["node"], "left").select("fp", F.coalesce("component", "fp").alias("root"), "least"), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.drop("least").join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the group)."""
    marks = stored(fingerprints(docs, shingle), "fingerprints")
    return marks.join(_grouped(marks.where("doc_id is not null"), radius, tile), "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents of smallest doc_id of each group, whole rows; of rows that repeat an id, one.
    Rows without an id have no place in this result; ``one_of_each_group`` keeps them."""
    keep = near_duplicates(docs, shingle, radius).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)


def one_of_each_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """One whole row of each group of near duplicates: of smallest doc_id (none comes last), then of
    least hash of the text.  A row without an id, or with another's, counts by its own text."""
    named = docs.select(F.struct("*").alias("kept"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    place = ["none", "id", "hash", "other"]  # which row it is; two hashes, since ids may be missing
    named = named.select("kept", "text", F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                         F.xxhash64("text").alias("hash"), F.xxhash64(F.lit(SEED), "text").alias("other"))
    marks = stored(named.select(*place, "text").mapInArrow(_marked(shingle), "none boolean, id long, hash long, other long, fp long"), "fingerprints")
    groups = _grouped(marks.select(F.when(~F.col("none"), F.col("id")).alias("doc_id"), "fp"), radius, tile)
    least = marks.groupBy("fp").agg(F.min(F.struct(*place)).alias("first"))  # a group's first is among its fingerprints' firsts
    keep = least.join(groups, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    # rows that repeat are reduced before they are dealt out; the join then finds them in place
    return named.drop("text").dropDuplicates(place).join(keep, place, "left_semi").select("kept.*")
