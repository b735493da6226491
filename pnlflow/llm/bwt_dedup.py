"""Suffix-array dedup: merged Burrows-Wheeler transforms.

Removes each byte covered by a string of ``length`` bytes that also starts anywhere else
in the corpus.  Texts are bytes, matches never cross documents, strings are judged on
the input.

1.  *Candidates.*  A string's seed is the smallest hash of its ``gram``-byte pieces, so
    equal strings have equal seeds, wherever they are.  A run of starts with one seed is a
    stretch.  Seeds that occur once are left out: their strings cannot repeat.
2.  *Equal stretches count once.*  Stretches are pre-aggregated to (text, multiplicity).
    Every group of a seed is then of distinct texts.  A group beyond ``crowd`` texts is
    split by what all strings at one distance from the seed have in common (``narrow``),
    which keeps equal strings together; at distance ranges of one start the common part is
    the string itself and nothing is left to crowd.
3.  *Transforms.*  Groups are dealt out by Spark.  A task takes some groups at a time,
    deals their texts to shards, and builds each shard's Burrows-Wheeler transform over
    an alphabet of ``block``-byte blocks (exact names of the blocks, not hashes).
4.  *Merge.*  The shards' transforms are merged by iterative interleave refinement: the
    interleave vector starts as plain concatenation, each round deals its slots out anew
    by their transform symbol, stably, and so extends the order by one block.  The round
    in which two neighbours part is their common prefix.  No suffix of the union is
    sorted.  Neighbours that never part in length/block rounds form the intervals of
    repeated strings; those of multiplicity two or more are removed.
5.  The removed ranges go back to all stretches of equal text and to the documents.

Defined results: null and empty texts have no bytes and lose none (hash of the empty
string).  Rows that repeat are documents of their own and so lose all that is long enough.
Rows without doc_id take part.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.common import SLICE_BYTES, opened, press, slices, spread, stored, utf8

U = np.uint64
_MUL = 0xD6E8FEB86659FD93
#: Bytes of text hashed at a time: each needs about 100 bytes of numpy arrays.
NUMPY_BYTES = 1 << 20


@dataclass(frozen=True)
class Settings:
    length: int = 200  # bytes of a string that must not repeat
    gram: int = 32  # bytes of a seed piece (a power of two)
    block: int = 40  # bytes of a symbol; divides length
    shards: int = 4  # transforms merged at a time
    chunk: int = 96 << 10  # bytes of text merged at a time, if no group is larger
    crowd: int = 4096  # distinct texts in a group before it is split
    crowd_bytes: int = 4 << 20  # or bytes of them
    run: int = 4096  # starts in a stretch at most (periodic text has long runs)


# ---- hashes of pieces ----------------------------------------------------------------

def piece_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` consecutive bytes, by doubling."""
    one = (data.astype(U) + U(1)) * U(0x9E3779B97F4A7C15)
    one ^= one >> U(32)
    have, width, out, done, factor = one, 1, None, 0, _MUL
    while True:  # out: the pieces of the first ``done`` bytes; have: pieces of ``width``
        if size & width:
            if out is None:
                out, done = have, width
            else:
                n = len(have) - done
                out = have[:n] * U(pow(_MUL, done, 1 << 64)) + out[width:width + n]
                done += width
        width *= 2
        if width > size:
            return out
        half = width // 2
        have = have[:len(have) - half] * U(factor) + have[half:]
        factor = factor * factor % (1 << 64)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U(32))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(29)
    return h


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    m, have = h, 1
    while 2 * have <= width:
        m = np.minimum(m[:len(m) - have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[:len(m) - rest], m[rest:]) if rest else m


def stretches(data: np.ndarray, at: np.ndarray, s: Settings, own: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of string starts with one seed, within documents: document, start, count, seed, and if
    ``own``, whether the run holds its seed piece more than once (its own strings may repeat)."""
    none = np.zeros(0, np.int64)
    long = np.flatnonzero(np.diff(at) >= s.length)
    if not len(long):
        return none, none, none, none.astype(U), none
    pieces, width = mixed(piece_hashes(data, s.gram)), s.length - s.gram + 1
    least = sliding_least(pieces, width)
    begin, end = at[:-1][long], at[1:][long] - s.length + 1  # of the starts in each document
    new = np.zeros(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    new[begin] = True
    p = np.flatnonzero(new)
    doc = np.searchsorted(begin, p, side="right") - 1
    inside = (doc >= 0) & (p < end[np.maximum(doc, 0)])
    p, doc = p[inside], doc[inside]
    count = np.minimum(np.append(p[1:], len(least)), end[doc]) - p
    row, k = spread(-(-count // s.run))  # very long runs in parts
    start, count = p[row] + k * s.run, np.minimum(count[row] - k * s.run, s.run)
    if not own:
        return long[doc[row]], start - at[:-1][long[doc[row]]], count, least[start], none
    # pieces that are the least of a string: the largest of the leasts around them is their own
    edge = np.zeros(width - 1, U)
    top = ~sliding_least(~np.concatenate((edge, least, edge)), width)
    chosen = np.flatnonzero(pieces == top)
    value, number = np.unique(pieces[chosen], return_inverse=True)
    order = number * len(data) + chosen  # by value, then by place
    order.sort()
    mine = np.searchsorted(value, least[start]) * len(data) + start
    twice = np.searchsorted(order, mine + count + width - 1) - np.searchsorted(order, mine) > 1
    return long[doc[row]], start - at[:-1][long[doc[row]]], count, least[start], twice


# ---- transforms and their merge --------------------------------------------------------

def block_names(data: np.ndarray, size: int) -> np.ndarray:
    """A number from 1 for each ``size`` consecutive bytes, the same for equal bytes and for them only."""
    h = piece_hashes(data, size)
    order = np.argsort(h)
    new = np.ones(len(h), bool)
    new[1:] = h[order[1:]] != h[order[:-1]]
    a, b = order[:-1][~new[1:]], order[1:][~new[1:]]
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    equal = np.ones(len(a), bool)
    word = np.ascontiguousarray(words).view(U).ravel() if len(a) else np.zeros(0, U)
    for k in [*range(0, size - 8, 8), size - 8]:
        equal &= word[a + k] == word[b + k]
    names = np.empty(len(h), np.int32)
    if equal.all():
        names[order] = np.cumsum(new, dtype=np.int32)
    else:  # two blocks share a hash: name the bytes themselves
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, size)).view(f"V{size}").ravel()
        names[:] = np.unique(rows, return_inverse=True)[1] + 1
    return names


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the keys, and each one's rank (equal keys: equal rank)."""
    order = np.argsort(key)
    sorted_key = key[order]
    new = np.zeros(len(key), np.int64)
    np.cumsum(sorted_key[1:] != sorted_key[:-1], out=new[1:])
    rank = np.empty(len(key), np.int64)
    rank[order] = new
    return order, rank


def stable_order(key: np.ndarray) -> np.ndarray:
    """argsort for keys below 2^31 in fewer than 2^31 rows: one plain sort of (key, row)."""
    if len(key) and int(key.max()) >= 1 << 31:
        return np.argsort(key, kind="stable")
    both = (key.astype(np.int64) << 32) | np.arange(len(key))
    both.sort()
    return both & 0xFFFFFFFF


def shard_order(symbol: np.ndarray, last: np.ndarray, block: int, depth: int) -> np.ndarray:
    """The order of a shard's suffixes by their first ``depth`` blocks, by rank doubling.
    symbol: of each suffix, 0 at a text's end; last: the last suffix of each one's text."""
    here = np.arange(len(symbol))
    order, rank = ranked(symbol)
    have = 1
    while have < depth:
        more = min(have, depth - have)
        there = here + more * block
        follow = np.where(there <= last, rank[np.minimum(there, len(rank) - 1)] + 1, 0)
        order, rank = ranked(rank * (len(rank) + 2) + follow)
        have += more
    return order


def merge(transforms: list[np.ndarray], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave refinement.  transforms: each shard's symbols before its suffixes, in suffix
    order.  Returns the shard of every slot of the union's order, and the common prefix of
    every slot with the one before it, in symbols, ``depth`` standing for that many or more."""
    n = sum(map(len, transforms))
    z = np.repeat(np.arange(len(transforms), dtype=np.int8), [len(t) for t in transforms])
    common = np.full(n, depth, np.int16)
    common[:1] = 0
    group = np.zeros(n, np.int32)
    parted = np.zeros(n, bool)
    for h in range(depth):
        symbol = np.empty(n, np.int32)
        for k, t in enumerate(transforms):
            symbol[z == k] = t
        order = stable_order(symbol)
        z, symbol, group = z[order], symbol[order], group[order]
        np.logical_or(symbol[1:] != symbol[:-1], group[1:] != group[:-1], out=parted[1:])
        common[parted & (common == depth)] = h
        group = np.cumsum(parted, dtype=np.int32)
    return z, common


def repeated_starts(data: np.ndarray, at: np.ndarray, weight: np.ndarray, s: Settings) -> np.ndarray:
    """For each byte of the texts: does a string that starts there have other starts?
    weight: how many places in the corpus hold each text."""
    size, block, depth = np.diff(at), s.block, s.length // s.block
    row, place = spread(size + 1)  # suffixes: one for each byte and the empty one
    byte = at[row] + place
    names = block_names(data, block)
    symbol = np.where(place <= size[row] - block, names[np.minimum(byte, len(names) - 1)], 0)
    before = np.where(place >= block, names[np.minimum(np.maximum(byte - block, 0), len(names) - 1)], 0)
    base = np.concatenate(([0], np.cumsum(size + 1)))
    last = base[1:][row] - 1
    cuts = base[np.linspace(0, len(size), min(s.shards, len(size)) + 1).astype(int)]
    orders = [a + shard_order(symbol[a:b], last[a:b] - a, block, depth) for a, b in zip(cuts, cuts[1:])]
    z, common = merge([before[o] for o in orders], depth)
    suffix = np.empty(len(z), np.int64)
    for k, o in enumerate(orders):
        suffix[z == k] = o
    interval = np.cumsum(common < depth)
    start = place[suffix] <= size[row[suffix]] - s.length
    suffix, interval = suffix[start], interval[start]
    total = np.bincount(interval, weights=weight[row[suffix]])
    out = np.zeros(len(data), bool)
    out[byte[suffix[total[interval] > 1]]] = True
    return out


# ---- tasks -----------------------------------------------------------------------------

def _find(s: Settings):
    """Document key, stretch (start, count), seed and the hash of its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in slices(batches, most=NUMPY_BYTES):
            data, at = utf8(batch.column("text"))
            doc, start, count, seed, _ = stretches(data, at, s)
            begin = at[doc] + start
            raw = data.tobytes()
            text = np.fromiter((digest(raw[a:b]) for a, b in zip(begin.tolist(), (begin + count + s.length - 1).tolist())), U, len(doc))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(doc)), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)),
                 pa.array(seed.view(np.int64)), pa.array(text.view(np.int64))], names=["key", "start", "n", "seed", "hash"])
    return run


def _seeds(s: Settings):
    """Seeds and how often they occur in a slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=16 << 20):
            found = [stretches(*utf8(b.column("text")), s, own=True)[3:] for b in slices([batch], most=NUMPY_BYTES)]
            seed, where = np.unique(np.concatenate([x for x, _ in found]), return_inverse=True)
            count = np.bincount(where, weights=np.concatenate([1 + y for _, y in found]), minlength=len(seed))
            yield pa.RecordBatch.from_arrays([pa.array(seed.view(np.int64)), pa.array(count.astype(np.int64))], names=["seed", "n"])
    return run


def _cut(s: Settings):
    """The texts of the wanted stretches of each document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in slices([batch], most=SLICE_BYTES, pressed=True):
                rows, cols = [], one.to_pydict()
                for z, want in zip(cols["text"], cols["want"]):
                    b = opened(z)
                    rows += [(w["seed"], w["hash"], w["copies"], b[w["start"]:w["start"] + w["n"] + s.length - 1]) for w in want]
                seed, text, copies, cut = zip(*rows) if rows else ((), (), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(seed, pa.int64()), pa.array(text, pa.int64()), pa.array(copies, pa.int64()),
                                                  pa.array(cut, pa.binary())], names=["seed", "hash", "copies", "bytes"])
    return run


def narrow(cut: bytes, seed: int, reach: int, s: Settings) -> Iterator[tuple[int, int, int]]:
    """Splits a stretch: (first start, starts, key).  The key hashes what all strings whose
    seed piece lies at one range of ``reach`` distances have in common; equal strings have
    equal keys."""
    data = np.frombuffer(cut, np.uint8)
    n = len(data) - s.length + 1
    where = np.flatnonzero(mixed(piece_hashes(data, s.gram)) == U(seed))
    anchor = where[np.searchsorted(where, np.arange(n))]
    part = (anchor - np.arange(n)) // reach
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))))
    for a, b in zip(new.tolist(), [*new[1:].tolist(), n]):
        first, final = int(anchor[a] - (part[a] + 1) * reach + 1), int(anchor[a] - part[a] * reach)
        core = cut[final:first + s.length]
        yield a, b - a, xxhash.xxh3_64_intdigest(core, (seed + int(part[a])) % (1 << 64))


def _narrow(reach: int, s: Settings):
    """Texts of crowded groups, split: where each piece comes from, its new group and its text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in slices([batch], "bytes", 64 << 10):
                rows = []
                for r in one.to_pylist():
                    for a, n, key in narrow(r["bytes"], r["seed"] % (1 << 64), reach, s):
                        cut = r["bytes"][a:a + n + s.length - 1]
                        rows.append((r["seed"], r["part"], r["hash"], a, r["copies"], signed(key), signed(xxhash.xxh3_64_intdigest(cut)), cut))
                columns = list(zip(*rows)) or [()] * 8
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:7]), pa.array(columns[7], pa.binary())],
                                                 names=["seed", "from_part", "from_hash", "offset", "copies", "part", "hash", "bytes"])
    return run


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _merge(s: Settings):
    """Repeated starts of the groups of a partition; its rows come sorted by group."""
    def solve(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows).combine_chunks()
        data, at = utf8(t.column("bytes"))
        hit = repeated_starts(data, at, t.column("copies").to_numpy(), s)
        edge = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
        a, b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        row = np.searchsorted(at, a, side="right") - 1
        take = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [t.column(c).take(take).combine_chunks() for c in ("level", "seed", "part", "hash")] + [pa.array(a - at[row]), pa.array(b - a)],
            names=["level", "seed", "part", "hash", "first", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, group = [], 0, None
        for batch in batches:
            seeds, parts = batch.column("seed").to_numpy(), batch.column("part").to_numpy()
            new = np.ones(len(seeds), bool)
            new[1:] = (seeds[1:] != seeds[:-1]) | (parts[1:] != parts[:-1])
            _, at = utf8(batch.column("bytes"))
            cuts = [*np.flatnonzero(new).tolist(), len(seeds)]
            begin = 0
            for a, b in zip(cuts, cuts[1:]):
                if (seeds[a], parts[a]) != group and size + at[a] - at[begin] >= s.chunk:  # groups stay whole
                    held.append(batch.slice(begin, a - begin))
                    if held := [x for x in held if x.num_rows]:
                        yield solve(held)
                    held, size, begin = [], 0, a
                group = (seeds[a], parts[a])
            held.append(batch.slice(begin))
            size += at[-1] - at[begin]
        if held := [x for x in held if x.num_rows]:
            yield solve(held)
    return run


def covered(spans: list[tuple[int, int]], n: int, length: int) -> list[tuple[int, int]]:
    """The maximal ranges covered by strings that start at (first, count)."""
    out: list[list[int]] = []
    for a, b in sorted((f, min(n, f + c + length - 1)) for f, c in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _remove(s: Settings, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in slices([batch], most=SLICE_BYTES, pressed=True):
                out = [[] for _ in range(5 + 2 * with_text)]
                for z, spans in zip(one.column("text").to_pylist(), one.column("spans").to_pylist()):
                    b = opened(z)
                    gone = covered([(x["first"], x["n"]) for x in spans or ()
                                    if xxhash.xxh3_64_intdigest(b[x["start"]:x["start"] + x["size"] + s.length - 1]) == x["hash"] % (1 << 64)], len(b), s.length)
                    edges = [0, *(x for span in gone for x in span), len(b)]
                    rest = b"".join(b[x:y] for x, y in zip(edges[::2], edges[1::2]))
                    values = [len(b), len(b) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), [{"start": x, "end": y} for x, y in gone]]
                    if with_text:  # a code point cut in two is dropped
                        values += [None if z is None else rest.decode("utf-8", "ignore"), z is None]
                    for column, x in zip(out, values):
                        column.append(x)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.bool_()]
                made = [pa.array(x, k) for x, k in zip(out, kinds)]
                keep = [c for c in one.schema.names if c not in ("text", "spans")]
                names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"] + ["kept_text", "was_null"] * with_text
                yield pa.RecordBatch.from_arrays([one.column(c) for c in keep] + made, names=keep + names)
    return run


# ---- the operator ----------------------------------------------------------------------

def _key() -> Column:
    """A row's key.  Rows that agree in it agree in id and text, and so in their result;
    chance agreement is caught by the hash of each stretch when it is removed."""
    return F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string"))


def repeated_strings(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Key of the document's row, and the starts of repeated strings in it as ranges:
    key, start and size of the stretch, its hash, first, n (starts first..first+n-1)."""
    keyed = docs.select(_key().alias("key"), F.col("text").cast("string").alias("text"))
    long = keyed.where(F.octet_length("text") >= s.length)
    twice = (long.select("text").mapInArrow(_seeds(s), "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
             .where("n > 1").select("seed"))
    every = long.mapInArrow(_find(s), "key long, start int, n int, seed long, hash long")
    places = stored(every.join(twice, "seed", "left_semi"), "stretches")

    distinct = places.groupBy("seed", "hash").agg(F.count("*").alias("copies"), F.min(F.struct("key", "start", "n")).alias("at"))
    wanted = (distinct.select("seed", "hash", "copies", "at.*").groupBy("key")
              .agg(F.collect_list(F.struct("seed", "hash", "copies", "start", "n")).alias("want")))  # bounded by one document
    packed = long.mapInArrow(press, "key long, text binary")
    # rows that repeat share a key and count in ``copies``; one of them gives the text
    texts = (packed.join(wanted, "key").dropDuplicates(["key"]).mapInArrow(_cut(s), "seed long, hash long, copies long, bytes binary")
             .select("seed", F.lit(0).cast("long").alias("part"), "hash", "copies", "bytes"))

    def crowd(t: DataFrame) -> DataFrame:
        """Groups of too many texts, or of too many bytes, for one merge."""
        sums = t.groupBy("seed", "part").agg(F.count("*").alias("rows"), F.sum("size").alias("size"))
        return stored(sums.where((F.col("rows") > s.crowd) | (F.col("size") > s.crowd_bytes)).select("seed", "part"), "crowd")

    size = (F.col("at.n") + (s.length - 1)).cast("long").alias("size")
    crowded, leaves, pieces = crowd(distinct.select("seed", F.lit(0).cast("long").alias("part"), size)), [], []
    for reach in (16, 1):
        if crowded.isEmpty():
            break
        texts = texts if pieces else stored(texts, "texts")
        leaves.append(texts.join(crowded, ["seed", "part"], "left_anti").select(*texts.columns))
        pieces.append(stored(texts.join(crowded, ["seed", "part"], "left_semi").select(*texts.columns).mapInArrow(
            _narrow(reach, s), "seed long, from_part long, from_hash long, offset long, copies long, part long, hash long, bytes binary"), "pieces"))
        texts = stored(pieces[-1].groupBy("seed", "part", "hash").agg(F.sum("copies").alias("copies"), F.min("bytes").alias("bytes")), "texts")
        crowded = crowd(texts.withColumn("size", F.octet_length("bytes").cast("long")))
    work = texts.withColumn("level", F.lit(len(pieces)))
    for level, leaf in enumerate(leaves):
        work = work.unionByName(leaf.withColumn("level", F.lit(level)))
    found = (work.repartition("seed", "part").sortWithinPartitions("level", "seed", "part")
             .mapInArrow(_merge(s), "level int, seed long, part long, hash long, first long, n long"))
    if pieces:
        found = stored(found, "found")
    hits = found.where(F.col("level") == len(pieces)).drop("level")
    for level in reversed(range(len(pieces))):  # what is found in pieces holds for the texts they come from
        up = hits.join(pieces[level].drop("bytes", "copies"), ["seed", "part", "hash"]).select(
            "seed", F.col("from_part").alias("part"), F.col("from_hash").alias("hash"), (F.col("first") + F.col("offset")).alias("first"), "n")
        hits = up.unionByName(found.where(F.col("level") == level).drop("level"))
    return (places.join(hits.select("seed", "hash", "first", F.col("n").alias("count")), ["seed", "hash"])
            .select("key", "start", F.col("n").alias("size"), "hash", (F.col("first") + F.col("start")).alias("first"), F.col("count").alias("n")))


def remove_repeats(docs: DataFrame, s: Settings = Settings(), keep: tuple[str, ...] = ("doc_id",), with_text: bool = False) -> DataFrame:
    """One row per document: the columns ``keep``, n_bytes, n_removed, n_spans, kept_sha256, the
    removed ranges, and with ``with_text`` the remaining text (null stays null)."""
    spans = (repeated_strings(docs, s).groupBy("key")
             .agg(F.collect_set(F.struct("start", "size", "hash", "first", "n")).alias("spans")))  # bounded by one document
    rows = docs.select(F.struct(*keep).alias("kept"), _key().alias("key"), F.col("text").cast("string").alias("text"))
    packed = rows.mapInArrow(press, _with_binary_text(rows))
    more = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<start:long,end:long>>"
    more += ", kept_text string, was_null boolean" if with_text else ""
    both = packed.join(spans, "key", "left").select("kept", "text", "spans")
    kind = rows.schema["kept"].dataType.simpleString()
    return both.mapInArrow(_remove(s, with_text), f"kept {kind}, {more}").select("kept.*", *(x.split()[0] for x in more.split(", ")))


def _with_binary_text(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in rows.schema)
