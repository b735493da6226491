"""Which tokens of two tokenizers cover the same text, and how often each pair does in a corpus.

1.  *Tokens.*  Both tokenizers read the text with a space before it.  Their tokens are two rising
    lists of byte ends, laid end to end for all texts of a slice.
2.  *Merge path.*  Merging the two lists walks a path of len(a) + len(b) steps.  A binary search on each
    ``work``-th diagonal finds where the path crosses it, so the walk falls into pieces of equal
    work that need nothing of each other.  All pieces advance together, one step of each at a time.  A
    piece emits the overlap of two tokens that every step ends, and closes a group where both lists
    end.  A group that is open at the edge of a piece goes on in the next; the pieces' groups are
    numbered by the sum of what was closed before.
3.  *Links.*  All tokens of a group are linked.  Documents are counted once for each pair of ids: a block of
    documents sends each of its pairs once, with the number of its documents that hold it; the sums
    return to the block's pairs.

Blocks are stored in the shared checkpoint folder, so a lost executor never sees a block cut differently
the second time.

Defined results: null and empty texts, and texts that either tokenizer does not spell back, have no tokens
and count for no pair.  Each row is a document: repeated rows, ties and null ids count as often as they
occur.  Further columns are ignored.  A long text passes in windows cut where both tokenizers end a token;
memory grows with a block's text and its distinct linked pairs of ids, and a group of many tokens is
reduced to its distinct ids before they are paired.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.bpe_queue import spellings
from pnlflow.llm.common import slices, spread, stored, sums
from pnlflow.llm.packed import by_count, pack, pack_strings, unpack, unpack_strings
from pnlflow.llm.pieces import LETTERS, PieceMemory, simple, windows
from pnlflow.llm.vbyte_ids import decode as decode_small
from pnlflow.llm.vbyte_ids import encode as encode_small
from pnlflow.llm.word_codec import WordCodec

#: The space in a sentencepiece model's pieces.
SPACE = "\u2581"
#: Words that a worker remembers of each tokenizer.
REMEMBERED = 300_000
#: Bytes of text in a block: the larger, the fewer times a pair travels.
BLOCK_BYTES = 16 << 20
#: Characters of text that one merge works on, and steps of a piece of it.
SLICE, WORK = 2 << 20, 256
#: Links of a group that are listed one by one; larger groups are reduced to distinct ids first.
LISTED = 4096


# ---- merge path ------------------------------------------------------------------------

def crossings(a: np.ndarray, b: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
    """How many of ``a`` the merged list holds before each diagonal; equal ends: that of ``a`` first."""
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (open_ := low < high).any():
        middle = (low + high) >> 1
        further = a[np.minimum(middle, len(a) - 1)] <= b[np.clip(diagonal - 1 - middle, 0, len(b) - 1)]
        low = np.where(open_ & further, middle + 1, low)
        high = np.where(open_ & ~further, middle, high)
    return low


def merge_path(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """a, b: rising ends with the same last one.  Returns the group of each token of ``a`` and of ``b``, and the
    overlaps in the order of the text: places in ``a`` and in ``b``."""
    total = len(a) + len(b)
    if not total:
        return (np.zeros(0, np.int64),) * 4
    edge = np.append(np.arange(0, total, work), total)
    i = crossings(a, b, edge[:-1])
    j, never = edge[:-1] - i, np.iinfo(np.int64).max
    ends_a, ends_b = np.append(a, never), np.append(b, never)
    before = np.maximum(np.where(i > 0, a[i - 1], 0), np.where(j > 0, b[j - 1], 0))
    closed = np.zeros(len(i), np.int64)  # groups that a piece has closed so far
    # by step: the list whose token it ends, whether two tokens overlap up to there, their places, the piece's group
    from_a, overlaps, left, right, group = (np.empty(total, k) for k in (bool, bool, np.int64, np.int64, np.int64))
    for step in range(min(work, total)):
        n = len(i) - (edge[-2] + step >= total)  # the last piece may be shorter
        at, x, y = edge[:n] + step, ends_a[i[:n]], ends_b[j[:n]]
        take, end = x <= y, np.minimum(x, y)
        same = end == before[:n]  # where ``a`` ended one step earlier, maybe in the piece before
        from_a[at], overlaps[at], left[at], right[at], group[at] = take, ~same, i[:n], j[:n], closed[:n]
        closed[:n] += same
        i[:n] += take
        j[:n] += ~take
        before[:n] = end
    group += np.repeat(np.cumsum(closed) - closed, np.diff(edge))  # stitched: a piece goes on with the group it finds open
    return group[from_a], group[~from_a], left[overlaps], right[overlaps]


# ---- tokens ----------------------------------------------------------------------------

class Pieces:
    """A sentencepiece model, read word by word: no piece of it may join a letter with another visible
    character, or hold a space after one."""

    _WORD = re.compile(rf" *[{LETTERS}]+| *[^ {LETTERS}]+| +")
    _CUT = re.compile(r"(?<=[^ ])(?= )")
    #: Stands for a piece of text whose tokens do not spell it.
    UNSPELLED = (1 << 32) - 1

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        letter = re.compile(f"[{LETTERS}]").match
        for i, name in enumerate(names):
            if not (self.model.is_byte(i) or self.model.is_control(i) or self.model.is_unknown(i)):
                for x, y in zip(name, name[1:]):
                    if x != SPACE and (y == SPACE or simple(x + y) and bool(letter(x)) != bool(letter(y))):
                        raise ValueError(f"a token crosses words: {name!r} of {path}")
        self.spelled = [bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(SPACE, " ").encode() for i, name in enumerate(names)]
        self.first = {c: len(self.model.encode(c)) for c in "a,"}
        self.memory = PieceMemory(self.cut, self._learn, REMEMBERED)

    def cut(self, text: str) -> list[str]:
        if simple(text):
            return self._WORD.findall(text)
        return [w for piece in self._CUT.split(text) for w in (self._WORD.findall(piece) if simple(piece) else [piece])]

    def _learn(self, words: list[str]) -> list[list[int]]:
        """The library puts a space before what it reads, so each word follows one of another kind."""
        lead = ["," if w[0].isalpha() else "a" for w in words]
        out = []
        for c, w, ids in zip(lead, words, self.model.encode([c + w for c, w in zip(lead, words)], num_threads=1)):
            ids = ids[self.first[c]:]
            out.append(ids if b"".join(map(self.spelled.__getitem__, ids)) == w.encode() else [self.UNSPELLED])
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each text begins with a space.  The ids of all texts, and how many each has."""
        return self.memory.encode(texts)


class Pair:
    """A worker's two tokenizers and what depends on them alone."""

    def __init__(self, a: str, b: str) -> None:
        self.a, self.b = WordCodec(a, True, plain_added=True, most=REMEMBERED), Pieces(b)
        spelled = spellings(a)
        self.size_a = np.array([len(spelled.get(i, b"")) for i in range(max(spelled) + 1)])
        self.size_b = np.array([len(x) for x in self.b.spelled])
        digits = [str(i).encode() for i in range(max(len(self.size_a), len(self.size_b)))]
        self.width = np.array([len(d) for d in digits])
        self.digits = np.zeros((len(digits), int(self.width.max()) + 1), np.uint8)
        self.digits[:, :-1] = np.array(digits).view(np.uint8).reshape(len(digits), -1)


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(a: str, b: str) -> Pair:
    """The worker's own tokenizers; they outlive a task."""
    if (a, b) not in _pairs:
        _pairs[a, b] = Pair(a, b)
    return _pairs[a, b]


# ---- groups and links of a slice -------------------------------------------------------

def reduced(key: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of ``times`` of each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(times[order], first) if len(first) else times[:0]


def links(group_a: np.ndarray, group_b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, n_groups: int, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The linked ids of all groups: group, id of a * n_b + id of b, times."""
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    start_a, start_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
    large = in_a * in_b > LISTED
    token, nth = spread(np.where(large, 0, in_b)[group_a])
    group = group_a[token]
    found = [(group, ids_a[token] * n_b + ids_b[start_b[group] + nth], np.ones(len(group), np.int64))]
    for g in np.flatnonzero(large).tolist():
        (x, times_x), (y, times_y) = (np.unique(ids[s[g]:s[g] + n[g]], return_counts=True) for ids, s, n in ((ids_a, start_a, in_a), (ids_b, start_b, in_b)))
        pairs = (x[:, None] * n_b + y).ravel()
        found.append((np.full(len(pairs), g), pairs, np.outer(times_x, times_y).ravel()))
    return tuple(np.concatenate(c) for c in zip(*found)) if len(found) > 1 else found[0]


def written(pair: Pair, group_a: np.ndarray, group_b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, n_groups: int) -> tuple[bytes, np.ndarray]:
    """All groups as ``a1,a2|b1;``, and how many bytes each takes."""
    in_a, in_b = np.bincount(group_a, minlength=n_groups), np.bincount(group_b, minlength=n_groups)
    upto_a, upto_b = np.cumsum(in_a), np.cumsum(in_b)
    ids, mark = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    ids[np.arange(len(ids_a)) + (upto_b - in_b)[group_a]] = ids_a
    ids[np.arange(len(ids_b)) + upto_a[group_b]] = ids_b
    last = upto_a + upto_b - 1
    mark[last], mark[last - in_b] = ord(";"), ord("|")
    rows, width = pair.digits[ids], pair.width[ids]
    rows[np.arange(len(ids)), width] = mark
    end = np.concatenate(([0], np.cumsum(width + 1)))
    return rows[rows > 0].tobytes(), np.diff(end[np.concatenate(([0], last + 1))])


class _Block:
    """What the documents of a block have in common, filled slice by slice."""

    def __init__(self, pair: Pair, n: int, with_groups: bool) -> None:
        self.pair, self.n = pair, n
        self.stats = np.zeros((4, n), np.int64)  # n_a, n_b, n_groups, n_links
        self.hashes: list = [None] * n
        self.groups: list | None = [[] for _ in range(n)] if with_groups else None
        self.bad, self.split = np.zeros(n, bool), False
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.all_pairs = len(pair.size_a) * len(pair.size_b)

    def add(self, rows: list[int], parts: list[str]) -> None:
        """Some windows of documents; all begin with a space."""
        pair, row = self.pair, np.array(rows, np.int64)
        (ids_a, n_a), (ids_b, n_b) = pair.a.memory.encode(parts), pair.b.encode(parts)
        of_a, of_b = np.repeat(row, n_a), np.repeat(row, n_b)
        self.bad[of_b[ids_b == Pieces.UNSPELLED]] = True
        keep_a, keep_b = ~self.bad[of_a], ~self.bad[of_b]
        ids_a, ids_b, of_a, of_b = ids_a[keep_a].astype(np.int64), ids_b[keep_b].astype(np.int64), of_a[keep_a], of_b[keep_b]
        if not len(ids_a):
            return
        group_a, group_b, _, _ = merge_path(np.cumsum(pair.size_a[ids_a]), np.cumsum(pair.size_b[ids_b]))
        n_groups = int(group_a[-1]) + 1
        doc = of_a[np.flatnonzero(np.diff(group_a, prepend=-1))]  # of each group
        group, pairs, times = links(group_a, group_b, ids_a, ids_b, n_groups, len(pair.size_b))
        for k, (at, weight) in enumerate(((of_a, None), (of_b, None), (doc, None), (doc[group], times))):
            self.stats[k] += np.bincount(at, weight, self.n).astype(np.int64)
        key, times = reduced(doc[group] * self.all_pairs + pairs, times)
        self.keys.append(key)
        self.times.append(times)
        text, size = written(pair, group_a, group_b, ids_a, ids_b, n_groups)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        edge = np.concatenate((np.concatenate(([0], np.cumsum(size)))[first], [len(text)])).tolist()
        for d, x, y in zip(doc[first].tolist(), edge, edge[1:]):
            line = text[x:y - 1]
            if self.hashes[d] is None:
                self.hashes[d] = hashlib.sha256(line)
            else:
                self.split = True
                self.hashes[d].update(b";" + line)
            if self.groups is not None:
                self.groups[d].append(line)

    def rows(self, block: int, doc_ids: pa.Array) -> pa.RecordBatch:
        """One row for each distinct pair, in the order of its number, and one for the documents."""
        key, times = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (self.keys, self.times))
        doc = key // self.all_pairs
        if self.bad.any():
            self.stats[:, self.bad] = 0
            key, times = key[~self.bad[doc]], times[~self.bad[doc]]
        if self.split:  # a document's windows lay in several slices
            key, times = reduced(key, times)
        doc, pairs = key // self.all_pairs, key % self.all_pairs
        pairs, number, docs = np.unique(pairs, return_inverse=True, return_counts=True)
        number, listed = by_count(number, len(pairs))
        n = len(pairs)
        ok = [h if not b else None for h, b in zip(self.hashes, self.bad.tolist())]
        blank = pa.nulls(n, pa.binary())
        head = [pack(self.stats.ravel()), pack_strings([h.digest() if h else b"" for h in ok]), pack(np.bincount(doc, minlength=self.n)),
                pack_strings([*encode_small(number)]), pack_strings([*encode_small(times.astype(np.uint32))]),
                pack_strings([b";".join(g) if h else b"" for g, h in zip(self.groups, ok)]) if self.groups is not None else None]
        return pa.RecordBatch.from_arrays(
            [pa.array([block] * (n + 1), pa.int64()), pa.array([*range(n), -1], pa.int32()),
             pa.array(np.append(pairs[listed], 0)), pa.array(np.append(docs[listed], 0).astype(np.int64)),
             pa.concat_arrays([pa.nulls(n, pa.list_(pa.int64())), pa.array([doc_ids.to_pylist()], pa.list_(pa.int64()))]),
             *(pa.concat_arrays([blank, pa.array([x], pa.binary())]) for x in head)], names=[c.split()[0] for c in _BLOCK.split(", ")])


_BLOCK = ("block long, number int, pair long, docs long, doc_ids array<long>, stats binary, hashes binary, counts binary, links binary, times binary, "
          "groups binary")


def _blocks(a: str, b: str, with_groups: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, pair = TaskContext.get().partitionId(), pair_of(a, b)
        for k, batch in enumerate(slices(batches, most=BLOCK_BYTES)):
            block, rows, parts, size = _Block(pair, batch.num_rows, with_groups), [], [], 0
            for r in range(batch.num_rows):
                text = batch.column("text")[r].as_py()
                for part in windows(" " + text, SLICE) if text else ():
                    if parts and size + len(part) > SLICE:
                        block.add(rows, parts)
                        rows, parts, size = [], [], 0
                    rows.append(r)
                    parts.append(part)
                    size += len(part)
            if parts:
                block.add(rows, parts)
            yield block.rows(task << 32 | k, batch.column("doc_id"))
    return run


def blocks_of(docs: DataFrame, a: str, b: str, with_groups: bool = False) -> DataFrame:
    """Stored blocks: rows of distinct pairs (number from 0) and of documents (number -1)."""
    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                  .mapInArrow(_blocks(a, b, with_groups), _BLOCK), "aligned")


def pair_counts(blocks: DataFrame, n_b: int) -> DataFrame:
    """pair, id_a, id_b, documents that hold it linked, and whether no other pair of its id_a is in more."""
    counts = blocks.where("number >= 0").groupBy("pair").agg(F.sum("docs").alias("documents")).withColumn("id_a", F.floor(F.col("pair") / n_b).cast("int"))
    best = counts.groupBy("id_a").agg(F.max("documents").alias("most"))  # at most one row for each id of the vocabulary
    return counts.join(F.broadcast(best), "id_a").select("pair", "id_a", F.pmod("pair", F.lit(n_b)).cast("int").alias("id_b"), "documents",
                                                         (F.col("documents") == F.col("most")).alias("best"))


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"


def _score(block: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's documents, and the corpus counts of its pairs."""
    number = answers.column("number").to_numpy()
    documents, best = (np.zeros(len(number), np.int64) for _ in range(2))
    documents[number], best[number] = answers.column("documents").to_numpy(), answers.column("best").to_numpy().astype(np.int64)
    out = []
    for r in block.to_pylist():
        n = len(r["doc_ids"])
        size = unpack(r["counts"], np.int64)
        total = int(size.sum())
        place, times = (decode_small(*unpack_strings(r[c]), total).astype(np.int64) for c in ("links", "times"))
        edge = np.concatenate(([0], np.cumsum(size)))
        scores = [pa.array(sums(value[place] * times, edge)) for value in (best, documents)]
        groups = [g.decode() for g in unpack_strings(r["groups"])] if r["groups"] is not None else [None] * n
        out.append(pa.table([pa.array(r["doc_ids"], pa.int64()), *map(pa.array, unpack(r["stats"], np.int64).reshape(4, n)), *scores,
                             pa.array([h.hex() for h in unpack_strings(r["hashes"])]), pa.array(groups, pa.string())],
                            names=[c.split()[0] for c in _RESULT.split(", ")]))
    return pa.concat_tables(out)


def align(docs: DataFrame, a: str, b: str, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 and, if wanted, the groups.
    ``a``: a byte-level BPE file, ``b``: a sentencepiece model."""
    n_b = len(Pieces(b).spelled)
    blocks = blocks_of(docs, a, b, with_groups)
    asked = blocks.where("number >= 0").select(F.col("block").alias("of"), "number", "pair")
    answers = asked.join(pair_counts(blocks, n_b).select("pair", "documents", "best"), "pair").select("of", "number", "documents", "best")
    heads = blocks.where("number < 0").select("block", "doc_ids", "stats", "hashes", "counts", "links", "times", "groups")
    found = heads.groupBy("block").cogroup(answers.groupBy("of")).applyInArrow(_score, _RESULT)  # a block is bounded
    return found if with_groups else found.drop("groups")
