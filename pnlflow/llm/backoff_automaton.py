"""LM scoring: a weighted backoff automaton.

The model.  Tokens are words and one end per text.  A state is a history of up to ``order`` - 1
tokens that was seen in training: the begin of a text, a known word, two words that
followed each other, or nothing (the root).  A state has an arc for each token that followed its
history in training, to the state of the longest known history that the token completes.  Every
other token takes the failure arc to the state of the history without its first token, at a cost, and
looks there.  The root has an arc for every token; an unknown word's ends in the root.  Weights are
log10 of

    P(w | h) = (1 - g(h)) c(h w) / c(h) + g(h) P(w | h')     arcs of h, h' being h without its first token
    g(h)                                                     failure arc of h
    P(w) = (c(w) - d) / N,  P(unknown) = d V / N             arcs of the root

with d by count of counts, d = n1 / (n1 + 2 n2), and g falling with the history's count,
g(h) = d T c(h)^-theta / sum of c^(1-theta) over the histories of its length: T is the number of distinct
n-grams one longer, so that on the whole as much is discounted as new successors were seen.  Over
the known tokens and one unknown, the weights of what can be read in any state sum to 1.

The work.  Texts are cut into blocks, stored in the shared checkpoint folder.  A block
sends each distinct n-gram of its own once, with its training count, to the hash
range that owns it; an owner adds up the blocks' counts and returns the totals in the
order they were asked in.  So no word is hot, the counts cover all training text, and a
block builds exactly the part of the automaton that its texts walk through.  Then each text is read from
left to right once: the state is carried from token to token, failure arcs are followed until there is an
arc, and the weights are added up.  Texts are read side by side; a long text is read in lanes, each
starting ``order`` - 1 tokens early, which is all that a state remembers.

N-grams are known by 64-bit hashes.  Defined results: null and empty texts are
the end alone.  Without training text every score is 0 (one unknown type has all the
mass).  A null id counts as crc32 0.  Rows that repeat count as often as they occur.  A text of any length is
one row of a block; memory grows with its tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pnlflow.llm.common import numbered, own_numbers, slices, stored, texts
from pnlflow.llm.packed import by_count, pack, pack_rising, unpack, unpack_rising

U = np.uint64
BLOCK_BYTES = 8 << 20
THETA = 0.15
#: Hashes of the marks around a text; a word's is made to differ.
BEGIN, END = U(1), U(2)


@dataclass(frozen=True)
class Model:
    """What all blocks share: a few numbers about the training text."""

    tokens: int  # N, ends included
    types: int  # V
    once: int
    twice: int
    texts: int
    grams: tuple[int, ...]  # distinct n-grams of 2, 3, ... tokens
    spread: tuple[float, ...]  # sum of c^(1-theta) over histories of 1, 2, ... tokens

    @property
    def d(self) -> float:
        return min(0.95, max(0.05, self.once / (self.once + 2 * self.twice))) if self.once else 0.5

    def root(self, c: np.ndarray) -> np.ndarray:
        """P(w), from w's count."""
        if not self.tokens:
            return np.ones(len(c))
        return np.where(c > 0, c - self.d, self.d * self.types) / self.tokens

    def failure(self, c: np.ndarray, length: int) -> np.ndarray:
        """g(h), from the count of a seen history of ``length`` tokens."""
        return np.clip(self.d * self.grams[length - 1] / self.spread[length - 1] * np.maximum(c, 1.0) ** -THETA, 0.01, 0.99)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


def pair_hash(u: np.ndarray, w: np.ndarray) -> np.ndarray:
    h = (u * U(0x9E3779B97F4A7C15)) ^ (w + (u >> U(31)))
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def starts(buckets: int) -> np.ndarray:
    """The first hash of each of the equal ranges."""
    return np.array([-(-(k << 64) // buckets) for k in range(buckets)], U)


# ---- blocks ----------------------------------------------------------------------------

@dataclass
class Block:
    """doc by doc: how many words, which (as numbers into ``hashes``), and whether it trains."""

    count: np.ndarray
    number: np.ndarray
    hashes: np.ndarray
    trains: np.ndarray

    def sequences(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Token hashes of all documents, ends included, each token's document and its place in it."""
        size = self.count + 1
        doc = np.repeat(np.arange(len(size)), size)
        end = np.cumsum(size)
        token = np.empty(len(doc), U)
        word = np.ones(len(doc), bool)
        word[end - 1] = False
        token[word] = self.hashes[self.number]
        token[end - 1] = END
        return token, doc, np.arange(len(doc)) - (end - size)[doc]

    def asked(self, order: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[np.ndarray], np.ndarray, np.ndarray]:
        """For each length the distinct n-grams, sorted, with their training counts; for each token which
        n-gram of each length it ends (-1: its text has too few before it); documents and places."""
        token, doc, place = self.sequences()
        learn = self.trains[doc].astype(np.int64)
        out, where, key = [], [], token
        for length in range(1, order + 1):
            if length > 1:  # the n-gram of the token before, and the token; a text's first token follows its begin
                before = np.concatenate((np.zeros(1, U), key[:-1]))
                key = pair_hash(np.where(place == 0, BEGIN, before), token)
            has = place >= length - 2
            known, inverse = np.unique(key[has], return_inverse=True)
            out.append((known, np.bincount(inverse, weights=learn[has], minlength=len(known)).astype(np.uint32)))
            ends = np.full(len(token), -1, np.int64)
            ends[has] = inverse
            where.append(ends)
        return out, where, doc, place


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task, digest = TaskContext.get().partitionId(), xxhash.xxh3_64_intdigest
    for k, batch in enumerate(slices(batches, most=BLOCK_BYTES)):
        known, parts = own_numbers(), []
        for b in slices([batch]):
            for t in texts(b.column("text")):
                w = t.lower().split()  # bytes: A-Z only, and exactly the separators 20 and 09-0D
                parts.append(numbered(w, known, len(w)).astype(np.int32))
        number, order = by_count(np.concatenate(parts), len(known))
        words = list(known)
        hashes = np.fromiter((digest(words[i]) for i in order.tolist()), U, len(words))
        hashes[hashes <= END] += U(16)
        yield pa.RecordBatch.from_arrays(
            [pa.array([task << 32 | k]), pa.array([batch.column("doc_id").to_pylist()], pa.list_(pa.int64())),
             *(pa.array([x], pa.binary()) for x in (pack(np.array([len(p) for p in parts], np.int64)), pack(number.astype(np.uint32)), pack(hashes),
                                                    pack(batch.column("trains").to_numpy(zero_copy_only=False).astype(np.uint8))))],
            names=["block", "doc_ids", "counts", "numbers", "hashes", "trains"])


BLOCK = "block long, doc_ids array<long>, counts binary, numbers binary, hashes binary, trains binary"


def _open(row: dict) -> Block:
    return Block(unpack(row["counts"], np.int64), unpack(row["numbers"], np.uint32), unpack(row["hashes"], np.uint64), unpack(row["trains"], np.uint8))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k].as_py() for c in batch.schema.names}


def _ask(buckets: int, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = starts(buckets)
        for row in _rows(batches):
            rows = []
            for kind, (known, count) in enumerate(_open(row).asked(order)[0]):
                edge = [*np.searchsorted(known, first).tolist(), len(known)]
                rows += [(row["block"], kind, b, pack_rising(known[x:y]), pack(count[x:y]))
                         for b, (x, y) in enumerate(zip(edge, edge[1:])) if x < y]
            for k in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 64]), (
                    pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()))], names=["block", "kind", "bucket", "keys", "counts"])
    return run


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Totals for one (kind, bucket) at a time, whose rows come together; a row without block has
    what the model needs to know about the bucket."""
    def solve(group: list[dict]) -> pa.RecordBatch:
        keys = [unpack_rising(r["keys"]) for r in group]
        known, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, weights=np.concatenate([unpack(r["counts"], np.uint32) for r in group])).astype(np.int64)
        edge = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
        kind, bucket, seen = group[0]["kind"], group[0]["bucket"], total[total > 0]
        rows = [(r["block"], kind, bucket, pack(narrow(total[inverse[a:b]])), None) for r, a, b in zip(group, edge, edge[1:])]
        ends = int(total[known == END].sum()) if kind == 0 else 0
        history = seen if kind or not ends else np.append(total[(total > 0) & (known != END)], ends)  # the begins count as the ends do
        rows.append((None, kind, bucket, None, [float(x) for x in (
            seen.sum(), len(seen), (seen == 1).sum(), (seen == 2).sum(), ends, (history.astype(float) ** (1 - THETA)).sum())]))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
            pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.float64())))], names=["block", "kind", "bucket", "totals", "about"])

    group: list[dict] = []
    for row in _rows(batches):
        if group and (row["kind"], row["bucket"]) != (group[0]["kind"], group[0]["bucket"]):
            yield solve(group)
            group = []
        group.append(row)
    if group:
        yield solve(group)


def narrow(a: np.ndarray) -> np.ndarray:
    return a.astype(np.uint32) if len(a) and a.max() < 1 << 32 else a


# ---- the automaton ---------------------------------------------------------------------

@dataclass
class Automaton:
    """State 0 is the root, state 1 the begin of a text.  Arcs are sorted by state * tokens + token."""

    tokens: int
    arc: np.ndarray
    weight: np.ndarray
    target: np.ndarray
    fail: np.ndarray  # of each state
    cost: np.ndarray

    def read(self, state: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next state of each of some readers, and the weight of the way there."""
        state, total, todo = state.copy(), np.zeros(len(state)), np.arange(len(state))
        while len(todo):
            want = state[todo] * self.tokens + token[todo]
            at = np.minimum(np.searchsorted(self.arc, want), len(self.arc) - 1)
            hit = self.arc[at] == want
            there, back = todo[hit], todo[~hit]
            total[there] += self.weight[at[hit]]
            state[there] = self.target[at[hit]]
            total[back] += self.cost[state[back]]
            state[back] = self.fail[state[back]]
            todo = back
        return state, total


def automaton(model: Model, counts: list[np.ndarray], where: list[np.ndarray], place: np.ndarray) -> Automaton:
    """The part that a block walks through.  counts: of each distinct n-gram of each length, in all training
    text; where, place: as ``Block.asked`` gives them."""
    order, n_tokens = len(counts), len(counts[0])
    # the states of the histories of each length: those n-grams that were seen
    first, state = 2, []
    for c in counts[:order - 1]:
        seen = c > 0
        state.append(np.where(seen, first + np.cumsum(seen) - 1, 0))
        first += int(seen.sum())
    fail, cost = np.zeros(first, np.int64), np.zeros(first)
    p = model.root(counts[0])  # of each n-gram: its last token after the rest of it
    target = state[0] if state else np.zeros(n_tokens, np.int64)
    arcs, weights, targets = [np.arange(n_tokens)], [np.log10(p)], [target]
    cost[1] = np.log10(model.failure(np.array([model.texts]), 1)[0]) if order > 1 and model.texts else 0.0
    for length in range(2, order + 1):
        c, ends = counts[length - 1], where[length - 1]
        at = np.full(len(c), -1, np.int64)
        found = np.flatnonzero(ends >= 0)
        at[ends[found]] = found  # a token that ends the n-gram
        token, lower = where[0][at], where[length - 2][at]
        begins = place[at] == 0  # after the begin of a text (two tokens: the begin and a word)
        history = np.where(begins, -1, where[length - 2][at - 1])
        from_state = np.where(begins, 1, state[length - 2][history])
        c_history = np.where(begins, model.texts, counts[length - 2][history])
        seen = c > 0
        g = model.failure(c_history[seen], length - 1)
        q = np.zeros(len(c))
        q[seen] = (1 - g) * c[seen] / c_history[seen] + g * p[lower[seen]]
        if length < order:  # the n-gram is a history itself
            own = state[length - 1][seen]
            fail[own], cost[own] = state[length - 2][lower[seen]], 0.0
        arcs.append(from_state[seen] * n_tokens + token[seen])
        weights.append(np.log10(q[seen]))
        targets.append((state[length - 1] if length < order else state[length - 2][lower])[seen])
        p = q
    for length, c in enumerate(counts[:order - 1], start=1):
        seen = c > 0
        cost[state[length - 1][seen]] = np.log10(model.failure(c[seen], length))
    arc, weight, target = (np.concatenate(x) for x in (arcs, weights, targets))
    by = np.argsort(arc, kind="stable")
    return Automaton(n_tokens, arc[by], weight[by], target[by], fail, cost)


#: Tokens that one lane of a traversal reads.
LANE = 512


def traverse(net: Automaton, token: np.ndarray, place: np.ndarray, order: int, lane: int = LANE) -> np.ndarray:
    """The weight of every token, read from left to right.  All texts are read side by side, long ones in
    lanes: a state depends on the ``order`` - 1 tokens before it only, so a lane begins as many early."""
    start = np.flatnonzero(place % lane == 0)
    stop = np.append(start[1:], len(token))
    begin = start - np.minimum(place[start], order - 1)
    state = np.where(place[begin] == 0, 1, 0)
    longest = np.argsort(begin - stop, kind="stable")
    begin, start, stop, state = begin[longest], start[longest], stop[longest], state[longest]
    length, out = stop - begin, np.zeros(len(token))
    for step in range(int(length[0]) if len(length) else 0):
        n = int(np.searchsorted(-length, -step, side="left"))  # lanes that are longer than this
        at = begin[:n] + step
        state[:n], weight = net.read(state[:n], token[at])
        own = at >= start[:n]
        out[at[own]] = weight[own]
    return out


def _walk(model: Model, order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            block = _open(row)
            _, where, doc, place = block.asked(order)
            answers = sorted(row["answers"] or [], key=lambda a: (a["kind"], a["bucket"]))
            counts = [np.concatenate([np.zeros(0, np.int64), *(unpack(a["totals"], np.uint32).astype(np.int64) for a in answers if a["kind"] == k)])
                      for k in range(order)]
            weight = traverse(automaton(model, counts, where, place), where[0], place, order)
            c, n = counts[0][where[0]], len(block.count)
            add = lambda x: np.bincount(doc, weights=x, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(block.trains == 0), pa.array(block.count + 1), pa.array(add(c > 0).astype(np.int64)),
                 pa.array(np.full(n, model.tokens, np.int64)), pa.array(add(model.base(c))), pa.array(add(weight))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def score(docs: DataFrame, learn: Column, order: int = 3) -> DataFrame:
    """Learn from the rows where ``learn`` holds and score all: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (smoothed unigrams) and score (the automaton), both log10.  ``order``: the
    longest n-gram, at least two tokens."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), learn.alias("trains"))
                    .mapInArrow(_blocks, BLOCK), "blocks")
    asked = blocks.mapInArrow(_ask(buckets, order), "block long, kind int, bucket int, keys binary, counts binary")
    answers = stored(asked.repartition(buckets, "bucket", "kind").sortWithinPartitions("bucket", "kind")
                     .mapInArrow(_answer, "block long, kind int, bucket int, totals binary, about array<double>"), "answers")
    sums = {r[0]: r[1:] for r in answers.where("block is null").groupBy("kind").agg(*(F.sum(F.col("about")[k]) for k in range(6))).collect()}
    (n, v, once, twice, ends, _), *longer = (sums.get(k, (0.0,) * 6) for k in range(order))
    model = Model(int(n), int(v), int(once), int(twice), int(ends), tuple(int(x[1]) for x in longer),
                  tuple(max(sums.get(k, (0.0,) * 6)[5], 1.0) for k in range(order - 1)))
    mine = answers.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", "totals")).alias("answers"))  # bounded by a block
    return blocks.join(mine, "block", "left").drop("block").mapInArrow(
        _walk(model, order), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
