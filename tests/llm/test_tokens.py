"""Packing, binary ids, BPE by words and the backoff automaton against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from tokenizers import Tokenizer

from pnlflow.llm import backoff_automaton, best_fit_packing, bpe_words, vbyte_ids
from pnlflow.llm.common import remainder_of_id, scratch_path, table, tokenizer_path
from pnlflow.llm.packed import pack, pack_rising, pack_strings, unpack, unpack_rising, unpack_strings
from pnlflow.llm.pieces import simple, spaceless_arrays, spaceless_words
from pnlflow.llm.word_codec import WordCodec, codec
from tests.llm.test_rows import WORD


def plain_ids(name, text):
    t = Tokenizer.from_file(tokenizer_path(name))  # as it is: added tokens in a text are found
    return t.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def odd_texts():
    rng = random.Random(4)
    alphabet = list("aB zé,.'s\n\t 1２$#!?") + [" ", " ", "  ", "\x1c", "\xa0", " ", "\x01", "́", "ﬁ", "Σ", "İ", "'ll", "<|endoftext|>", "好", "👍"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(400)]


@pytest.mark.parametrize("plain", [False, True])
@pytest.mark.parametrize("name,keeps", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_codec_equals_the_library(name, keeps, plain, odd_rows):
    texts = odd_texts() + [t or "" for _, t in odd_rows] + ["hi <|endoftext|> you", "<|startoftext|>A<|endoftext|>", "<|endoftext|" * 9, "İstanbul ŉ ƁƂ Ⱥ"]
    texts += [f"a{chr(k)}b {chr(k)}1{chr(k)} {chr(k)}{chr(k)} x" for k in [*range(0x3100), *range(0xA000, 0xB000), *range(0x1F000, 0x1F100)]]
    ids, count = codec(tokenizer_path(name), keeps, plain).encode([t.encode() for t in texts])
    edge = np.concatenate(([0], np.cumsum(count)))
    t = Tokenizer.from_file(tokenizer_path(name))
    if plain:
        t.encode_special_tokens = True
    for k, text in enumerate(texts):
        assert ids[edge[k]:edge[k + 1]].tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_words_cut_as_arrays(odd_rows):
    rng = random.Random(6)
    alphabet = [*"abdelmrstv  ''''.!09", "\n", "\t", "\x0b", "\x1c", "é", "ß", "Ș", "'s", "'re", "'ll", "''"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(5000)] + odd_texts() + [t or "" for _, t in odd_rows]
    texts = [t for t in texts if simple(t)]
    for some in ([], [""], ["'"], ["'r", "e"], ["", "a", "", "'s"], texts):
        words, count = spaceless_arrays([t.lower().encode() for t in some])
        expected = [spaceless_words(t) for t in some]
        assert count.tolist() == [len(e) for e in expected]
        assert words.cast("string").to_pylist() == [w for e in expected for w in e]


def test_simple_texts_are_looked_up_once_for_each_distinct_word():
    """Not once for each word: the budget of op6 allows no Python step for every word."""
    c, asked = WordCodec(tokenizer_path("word_bpe_49k.json"), False), []

    class Known(type(c.memory.known)):
        def __getitem__(self, key):
            asked.append(key)
            return super().__getitem__(key)

    c.memory.known = Known()
    texts = ["One two, one TWO. " * 200, "déjà vu " * 100, "", "好 one 好"]
    ids, count = c.encode([t.encode() for t in texts])
    expected = [plain_ids("word_bpe_49k.json", t) for t in texts]
    assert ids.tolist() == [i for e in expected for i in e] and count.tolist() == [len(e) for e in expected]
    assert len(asked) < 20


def test_packing(odd_docs, odd_rows):
    got = best_fit_packing.pack_documents(odd_docs, tokenizer_path("byte_bpe_50k.json"), with_ids=True).collect()
    by_doc = defaultdict(Counter)
    for r in got:
        by_doc[r.doc_id][(r.piece, r.start, r.length, r.ids_crc32)] += 1
        assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(r.ids) == 4 * r.length
    expected = defaultdict(Counter)
    for i, t in odd_rows:
        ids = [*plain_ids("byte_bpe_50k.json", t), 0]
        head = (len(ids) - 1) % 2048 + 1
        edges = [0, *range(head, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            expected[i][(k, a, b - a, crc(ids[a:b]))] += 1
    assert by_doc == expected
    check_places(got, 2048)


def check_places(rows, size):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for s in sequences.values():
        s.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and s[0][0] == 0 and sum(s[-1]) <= size
    return len(sequences)


def test_packing_is_tight_on_given_documents(spark):
    got = best_fit_packing.pack_documents(table(spark, "/root/testdata/sf0.01", "documents"), tokenizer_path("byte_bpe_50k.json")).collect()
    assert check_places(got, 2048) <= math.ceil(sum(r.length for r in got) / 2048 * 1.02)


def test_exact_complements():
    counts = np.zeros(101, np.int64)
    for length, n in {100: 3, 70: 5, 30: 5, 60: 2, 25: 4, 15: 4, 50: 7, 40: 1, 20: 3}.items():
        counts[length] = n
    plan = best_fit_packing.combinations(counts, 100)
    used = Counter()
    for lengths, times in plan:
        assert sum(lengths) <= 100
        used.update({x: k * times for x, k in Counter(lengths).items()})
    assert used == {i: int(c) for i, c in enumerate(counts) if c}
    assert sum(t for _, t in plan) == math.ceil(sum(i * c for i, c in enumerate(counts)) / 100)


def test_combinations_use_every_piece_once():
    rng = np.random.default_rng(0)
    for n in (0, 1, 5, 200, 5000):
        counts = np.bincount(np.minimum(rng.geometric(0.02, n), 256), minlength=257)
        plan = best_fit_packing.combinations(counts, 256)
        total = Counter()
        for lengths, times in plan:
            total.update({x: k * times for x, k in Counter(lengths).items()})
        assert total == {i: int(c) for i, c in enumerate(counts) if c} and len(plan) <= 4 * 256
        if n == 5000:
            assert sum(t for _, t in plan) <= 1.01 * math.ceil((counts * np.arange(257)).sum() / 256)


def test_vbyte_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 1001):
        v = (rng.integers(0, 1 << 32, n) >> rng.integers(0, 32, n)).astype(np.uint32)
        assert vbyte_ids.decode(*vbyte_ids.encode(v), n).tolist() == v.tolist()


@pytest.mark.parametrize("top", [0, 0xFF, 0x100, 0xFFFF, 0x10000, 0xFFFFFF, 0x1000000, 0xFFFFFFFF])
def test_vbyte_bytes(top):
    v = [0, top, 1, top, min(top, 300)]
    size = [max(1, -(-x.bit_length() // 8)) for x in v]
    control, data = vbyte_ids.encode(np.array(v, np.uint32))
    assert data == b"".join(x.to_bytes(n, "little") for x, n in zip(v, size))
    assert control == bytes(sum((n - 1) << 2 * j for j, n in enumerate(size[k:k + 4])) for k in (0, 4))
    assert vbyte_ids.decode(control, data, 5).tolist() == v


def test_packed_round_trips():
    rng = np.random.default_rng(1)
    a = np.sort(rng.integers(0, 1 << 63, 500).astype(np.uint64))
    assert unpack_rising(pack_rising(a)).tolist() == a.tolist() and unpack_rising(pack_rising(a[:0])).tolist() == []
    assert unpack(pack(a.astype(np.int64)), np.int64).tolist() == a.tolist() and len(unpack(None, np.uint32)) == 0
    words = [b"", b"a\nb", "é".encode(), b"x" * 1000]
    assert unpack_strings(pack_strings(words)) == words and unpack_strings(pack_strings([])) == []


def test_binary_ids(spark, odd_docs, odd_rows):
    path = scratch_path(spark, "test-ids")
    vbyte_ids.write(odd_docs, tokenizer_path("word_bpe_49k.json"), 1, path)
    got = vbyte_ids.read(spark, path, with_ids=True).collect()
    ids = {t: [*plain_ids("word_bpe_49k.json", t), 1] for _, t in odd_rows}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(ids[t]), crc(ids[t])) for i, t in odd_rows)
    got.sort(key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i))
    start = 0
    for r in got:
        assert r.start == start and np.frombuffer(r.ids, "<u4").size == r.n_tokens
        start += r.n_tokens
    order = np.frombuffer(spark.read.parquet(f"{path}/ranks").first()[0], "<u4")
    seen = Counter(x for _, t in odd_rows for x in ids[t])
    assert all(seen[a] >= seen[b] for a, b in zip(order.tolist(), order.tolist()[1:]))


def test_bpe_by_words(odd_docs, odd_rows, spark):
    path = tokenizer_path("byte_bpe_multi_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=bpe_words.PATTERN, mergeable_ranks=bpe_words.merges(path), special_tokens={})
    rows = odd_rows + [(1000 + i, t) for i, t in enumerate(odd_texts())]
    docs = odd_docs.select("doc_id", "text").union(spark.createDataFrame(rows[len(odd_rows):], "doc_id long, text string"))
    got = Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, tuple(r.ids)) for r in bpe_words.encode(docs, path, with_ids=True).collect())
    expected = Counter()
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        expected[(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest(), tuple(ids))] += 1
    assert got == expected


def plain_scores(rows, order=3):
    """The model's formula, token by token, and the mass that each state gives out."""
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = [(i, [*WORD.findall(low(t)), None]) for i, t in rows]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    seen, n_texts = [Counter() for _ in range(order)], 0  # n-grams of 1, 2, ... tokens
    for i, w in tokens:
        if not held(i):
            padded = ["<begin>", *w]
            seen[0].update(w)
            for k in range(2, order + 1):
                seen[k - 1].update(zip(*(padded[j:] for j in range(k))))
            n_texts += 1
    c = seen[0]
    n, v = sum(c.values()), len(c)
    n1, n2 = (sum(x == k for x in c.values()) for k in (1, 2))
    d = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 else 0.5
    histories = [{**{(k,): x for k, x in c.items() if k is not None}, ("<begin>",): n_texts}, *seen[1:]]
    theta = backoff_automaton.THETA
    total = [sum(x ** (1 - theta) for x in h.values()) or 1 for h in histories]

    def g(h):
        return min(0.99, max(0.01, d * len(seen[len(h)]) / total[len(h) - 1] * histories[len(h) - 1][h] ** -theta))

    def p(h, w):
        if not n:
            return 1.0
        if not h:
            return (c[w] - d) / n if w in c else d * v / n
        if not histories[len(h) - 1].get(h):
            return p(h[1:], w)
        return (1 - g(h)) * seen[len(h)][(*h, w)] / histories[len(h) - 1][h] + g(h) * p(h[1:], w)

    out = []
    for i, w in tokens:
        padded = ["<begin>", *w]
        score = sum(math.log10(p(tuple(padded[max(0, k - order + 1):k]), padded[k])) for k in range(1, len(padded)))
        out.append((i, held(i), len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), score))
    states = [(), *list(histories[0])[:20], ("<begin>",)] + [h for h in list(seen[1])[:20] if h[-1] is not None] * (order > 2)
    mass = [sum(p(h, w) for w in c) + p(h, "\0unknown") for h in states]
    return out, mass


@pytest.mark.parametrize("order", [2, 3])
def test_scores_equal_brute_force(odd_docs, odd_rows, order, monkeypatch):
    got = sorted((tuple(r) for r in backoff_automaton.score(odd_docs, remainder_of_id("doc_id", 5) != 1, order).collect()), key=str)
    expected, mass = plain_scores(odd_rows, order)
    expected.sort(key=str)
    assert [r[:5] for r in sorted(got, key=lambda r: (str(r[:5]), r[6]))] == [r[:5] for r in sorted(expected, key=lambda r: (str(r[:5]), r[6]))]
    assert np.allclose(sorted(r[5] for r in got), sorted(r[5] for r in expected), rtol=1e-9)
    assert np.allclose(sorted(r[6] for r in got), sorted(r[6] for r in expected), rtol=1e-9)
    assert np.allclose(mass, 1)


def test_the_automaton_by_hand():
    """States, arcs and failure arcs over two short texts, read token by token."""
    texts_ = ["a b a b", "a c"]
    words = sorted({w for t in texts_ for w in t.split()})
    block = backoff_automaton.Block(np.array([4, 2]), np.array([words.index(w) for t in texts_ for w in t.split()], np.uint32),
                                    np.array([100, 200, 300], np.uint64), np.array([1, 1], np.uint8))
    asked, where, doc, place = block.asked(3)
    assert [len(k) for k, _ in asked] == [4, 6, 6] and place.tolist() == [0, 1, 2, 3, 4, 0, 1, 2]
    counts = [c.astype(np.int64) for _, c in asked]
    model = backoff_automaton.Model(8, 4, 1, 2, 2, (6, 6), (4.0, 6.0))
    net = backoff_automaton.automaton(model, counts, where, place)
    # the root, the begin, four tokens, six pairs
    assert len(net.fail) == 2 + 4 + 6 and net.fail[:6].tolist() == [0] * 6 and set(net.fail[6:].tolist()) <= {2, 3, 4, 5}
    assert len(net.arc) == 4 + 6 + 6 and (np.diff(net.arc) > 0).all()
    token = where[0]
    for start in (0, 5):
        state = 1
        for k in range(start, start + (5 if start == 0 else 3)):
            (state,), _ = net.read(np.array([state]), token[k:k + 1])
            assert state >= 6 and net.fail[state] - 2 == token[k]  # every history of the texts is a state
    (state,), (weight,) = net.read(np.array([1]), token[4:5])  # an end never follows the begin: failure arc, then the root's
    assert state == 2 + token[4] and np.isclose(weight, net.cost[1] + np.log10(model.root(counts[0][token[4:5]])[0]))
    whole = backoff_automaton.traverse(net, token, place, 3)
    for lane in (1, 2, 3, 4):
        assert np.allclose(backoff_automaton.traverse(net, token, place, 3, lane), whole)


def test_scores_on_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in backoff_automaton.score(docs, remainder_of_id("doc_id", 5) != 1).collect()}
    expected, _ = plain_scores([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    for i, *x in expected:
        assert np.allclose(list(got[i])[1:], x, rtol=1e-9)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)
    shorter = [r.score for r in backoff_automaton.score(docs, remainder_of_id("doc_id", 5) != 1, order=2).collect() if r.held_out]
    assert sum(r.score for r in held) > sum(shorter)


def test_nothing_to_learn_from(spark, odd_docs):
    from pyspark.sql import functions as F

    got = backoff_automaton.score(odd_docs, F.lit(False)).collect()
    assert all(r.score == 0 and r.n_known == 0 and r.train_tokens == 0 for r in got)


def test_empty(spark, no_docs):
    assert best_fit_packing.pack_documents(no_docs, tokenizer_path("byte_bpe_50k.json")).collect() == []
    assert bpe_words.encode(no_docs, tokenizer_path("byte_bpe_multi_50k.tiktoken")).collect() == []
    assert backoff_automaton.score(no_docs, remainder_of_id("doc_id", 5) != 1).collect() == []
    path = scratch_path(spark, "test-none")
    vbyte_ids.write(no_docs, tokenizer_path("word_bpe_49k.json"), 1, path)
    assert vbyte_ids.read(spark, path).collect() == []
