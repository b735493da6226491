"""The queue of merges, token alignment and the filter audit against brute force."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from pnlflow.llm import bpe_queue, filter_audit, token_alignment
from pnlflow.llm.common import tokenizer_path
from pnlflow.llm.pieces import byte_level_words, windows
from tests.llm.test_rows import WORD
from tests.llm.test_tokens import odd_texts

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(A)


# ---- the queue of merges ---------------------------------------------------------------

def test_queue_equals_the_library(library, odd_rows):
    texts = odd_texts() + [t or "" for _, t in odd_rows] + ["<|endoftext|>", " <|endoftext|><|endoftext|> a", "<|endoftext|", "a" * 30_000, " " * 999, "ab" * 9000]
    texts += [f"a{chr(k)}b {chr(k)}1{chr(k)} {chr(k)}{chr(k)} x" for k in [*range(0x3100), *range(0xA000, 0xB000), *range(0x1F000, 0x1F100)]]
    for text, ids in zip(texts, bpe_queue.QueueCodec(A).encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_queue_of_one_word_skips_stale_entries(library):
    vocabulary = bpe_queue.Vocabulary(A)
    rng = random.Random(5)
    for _ in range(2000):
        word = "".join(rng.choice("aabnthsei") for _ in range(rng.randint(1, 40)))
        assert vocabulary.merge(word.encode()) == library.encode(word, add_special_tokens=False).ids
    assert vocabulary.merge(b"") == []


def test_decode_of_any_ids(library):
    spelled, rng = bpe_queue.spellings(A), random.Random(6)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 30))]
        assert bpe_queue.decode_ids(spelled, ids).decode("utf-8", "replace") == library.decode(ids, skip_special_tokens=False)


def test_windows_and_words_keep_every_character():
    for text in odd_texts():
        assert "".join(byte_level_words(text)) == text
        assert "".join(windows(text, 7)) == text


def test_long_texts_pass_in_windows(library, monkeypatch):
    monkeypatch.setattr(bpe_queue, "SLICE_BYTES", 50)
    monkeypatch.setattr(bpe_queue, "windows", lambda t: windows(t, 20))
    texts = odd_texts()[:100] + ["many short words <|endoftext|> in one long text " * 20]
    for text, ids in zip(texts, bpe_queue.QueueCodec(A).encode(texts)):
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_queue_rows(odd_docs, odd_rows, no_docs, library):
    coded = bpe_queue.decode(bpe_queue.encode(odd_docs, A), A)
    got = Counter((r.doc_id, bytes(r.ids), r.text) for r in coded.collect())
    assert got == Counter((i, np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes(), t or "") for i, t in odd_rows)
    assert bpe_queue.decode(bpe_queue.encode(no_docs, A), A).collect() == []


# ---- alignment -------------------------------------------------------------------------

def plain_groups(a, b):
    """Groups of two lists of ends, one token at a time."""
    cuts = sorted(set(a) & set(b))
    return [sum(c < x for c in cuts) for x in a], [sum(c < x for c in cuts) for x in b]


def ends(rng, total):
    return np.array(sorted({*(rng.randrange(1, total) for _ in range(rng.randint(0, total))), total} if total > 1 else {total}), np.int64)


@pytest.mark.parametrize("work", [1, 2, 3, 7, 64, 10_000])
def test_merge_path_pieces_are_stitched(work):
    rng = random.Random(work)
    for _ in range(60):
        total = rng.randint(1, 60)
        a, b = ends(rng, total), ends(rng, total)
        group_a, group_b, left, right = token_alignment.merge_path(a, b, work)
        assert (group_a.tolist(), group_b.tolist()) == plain_groups(a.tolist(), b.tolist())
        begin_a, begin_b = np.append(0, a), np.append(0, b)
        overlaps = [(i, j) for i in range(len(a)) for j in range(len(b)) if max(begin_a[i], begin_b[j]) < min(a[i], b[j])]
        assert sorted(zip(left.tolist(), right.tolist())) == overlaps
    assert all(not len(x) for x in token_alignment.merge_path(a[:0], b[:0], work))


def test_pieces_of_the_model_word_by_word(odd_rows):
    model, own = SentencePieceProcessor(model_file=B), token_alignment.Pieces(B)
    texts = [t for t in odd_texts() + [t for _, t in odd_rows if t] if t]
    texts += [f"a{chr(k)}b {chr(k)}1{chr(k)}  {chr(k)}{chr(k)} x " for k in range(1, 0x3100)] + [" ", "  ", "a  b   ", "<s> </s><unk>", "▁ x"]
    ids, count = own.encode([" " + t for t in texts])
    at = np.concatenate(([0], np.cumsum(count)))
    for k, text in enumerate(texts):
        got, expected = ids[at[k]:at[k + 1]].tolist(), model.encode(text)
        if own.UNSPELLED in got:
            assert b"".join(own.spelled[i] for i in expected) != (" " + text).encode()
        else:
            assert got == expected, text


def plain_alignment(rows):
    a, b, letters = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), {c: i for i, c in enumerate(bpe_queue.byte_letters())}
    a.encode_special_tokens = True
    spelled = {i: bytes(letters.get(c, 0) for c in t) for t, i in a.get_vocab().items()}
    docs, held = [], Counter()
    for doc_id, text in rows:
        groups = []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            of_a = [spelled[i] for i in ids_a]
            of_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
            if b"".join(of_a) == b"".join(of_b) == (" " + text).encode():
                end_a, end_b = np.cumsum(list(map(len, of_a))).tolist(), np.cumsum(list(map(len, of_b))).tolist()
                cuts = sorted(set(end_a) & set(end_b))
                by_a, by_b = defaultdict(list), defaultdict(list)
                for by, end, ids in ((by_a, end_a, ids_a), (by_b, end_b, ids_b)):
                    for e, i in zip(end, ids):
                        by[bisect_left(cuts, e)].append(i)
                groups = [(by_a[g], by_b[g]) for g in range(len(cuts))]
        links = Counter()
        for x, y in groups:
            for i, n in Counter(x).items():
                for j, m in Counter(y).items():
                    links[i, j] += n * m
        held.update(links.keys())
        docs.append((doc_id, groups, links))
    most = defaultdict(int)
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    out = Counter()
    for doc_id, groups, links in docs:
        line = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[doc_id, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
            sum(n for (i, j), n in links.items() if held[i, j] == most[i]), sum(n * held[p] for p, n in links.items()),
            hashlib.sha256(line.encode()).hexdigest() if groups else "", line] += 1
    return out


def test_alignment(spark, odd_rows, no_docs):
    from tests.llm.conftest import SCHEMA

    rows = odd_rows + [(900 + k, t) for k, t in enumerate([*odd_texts()[:60], "x ▁ y", "<s> <|endoftext|> </s>", "ﬁ" * 3000, "=" * 4001, "ab1" * 3000])]
    docs = spark.createDataFrame([(i, t, "en", "src", 0, *"kifshblska") for i, t in rows], SCHEMA).repartition(3)
    got = Counter(tuple(r) for r in token_alignment.align(docs, A, B, with_groups=True).collect())
    assert got == plain_alignment(rows)
    assert "groups" not in token_alignment.align(docs, A, B).columns
    assert token_alignment.align(no_docs, A, B).collect() == []
    nothing = docs.where("doc_id = 0 or text is null")
    assert {tuple(r)[1:] for r in token_alignment.align(nothing, A, B).collect()} == {(0, 0, 0, 0, 0, 0, "")}


def test_alignment_of_windows_and_large_groups(spark, monkeypatch):
    """Documents longer than a slice, pieces of eleven steps, groups that are reduced before they are paired."""
    pair = token_alignment.pair_of(A, B)
    text = "several words, and 1234 (more) of <them>. " * 40
    for slice_, work, listed in ((1 << 20, 256, 4096), (50, 11, 1)):
        monkeypatch.setattr(token_alignment, "LISTED", listed)
        monkeypatch.setattr(token_alignment, "merge_path", lambda a, b, f=token_alignment.merge_path, w=work: f(a, b, w))
        block = token_alignment._Block(pair, 2, True)
        for d in (0, 1):
            for part in windows(" " + text, slice_):
                block.add([d], [part])
        import pyarrow as pa

        made = block.rows(7, pa.array([1, 2], pa.int64()))
        found = (made.column("pair").to_pylist(), made.column("docs").to_pylist(), block.stats.tolist(), [h.hexdigest() for h in block.hashes],
                 made.column("links").to_pylist()[-1], made.column("times").to_pylist()[-1])
        if slice_ > 50:
            first = found
        monkeypatch.undo()
    assert found == first


# ---- filters ---------------------------------------------------------------------------

def test_galloping_merges():
    rng = random.Random(1)
    for _ in range(500):
        lists = [sorted(rng.sample(range(120), rng.randint(0, 60))) for _ in range(rng.randint(0, 5))]
        assert filter_audit.union(lists) == sorted(set().union(*lists))
        x, y = ([sorted(rng.sample(range(99), rng.randint(0, 50))) for _ in range(2)])
        assert filter_audit.difference(x, y) == sorted(set(x) - set(y))
        at, value = rng.randint(0, len(x)), rng.randint(0, 100)
        assert filter_audit.gallop(x, value, at) == next((k for k in range(at, len(x)) if x[k] >= value), len(x))


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_words_in_windows(most):
    for text in odd_texts():
        found = WORD.findall(text)
        assert filter_audit.words(text.encode(), most) == (len(found), len(set(found)))


def plain_audit(rows, marks):
    fails, parts = [], []
    for doc_id, part, text in rows:
        text = text or ""
        found = WORD.findall(text)
        failed = {"A": len(found) < 200, "B": 100 * len(set(found)) < 50 * len(found), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
                  "D": any(c in "#$%&*|" for c in text),
                  "E": doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, _, t in rows)}
        fails.append({f for f, x in failed.items() if x})
        parts.append(part or "")
    out = Counter()
    for part in set(parts):
        here = [(f, marks.get(rows[k][0], (0, 0))) for k, f in enumerate(fails) if parts[k] == part]
        orders, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = here
            for step, f in enumerate(order):
                gone, left = [x for x in left if f in x[0]], [x for x in left if f not in x[0]]
                failing = sum(f in x for x, _ in here)
                shapley[f] += len(gone)
                orders.append(("".join(order), step + 1, f, len(left), len(gone), failing - len(gone), sum(x == {f} for x, _ in here),
                               sum(m[0] for _, m in gone), sum(m[1] for _, m in gone)))
        for name, step, f, *figures in orders:
            out[part, name, step, *figures, shapley[f]] += 1
    return out


def test_audit(spark, odd_rows, no_docs):
    from tests.llm.conftest import SCHEMA

    rng = random.Random(8)
    rows = [(i, ("en", "xx", None)[k % 3], t) for k, (i, t) in enumerate(odd_rows)]
    rows += [(1000 + k, "en", rng.choice(["A" * 9, "many " * 250, "w$", "copy of a text", " ".join(map(str, range(300)))])) for k in range(60)]
    marks = {r[0]: (rng.randint(0, 1), rng.randint(0, 1)) for r in rows if r[0] is not None and rng.random() < 0.5}
    docs = spark.createDataFrame([(i, t, p, "src", 0, *"kifshblska") for i, p, t in rows], SCHEMA).repartition(3)
    said = [(i, q, x, "extra") for i, (q, x) in marks.items()]
    said += [(i, 0, None, "again") for i in list(marks)[:5]] + [(None, 1, 1, "no id"), (99_999, 1, 1, "no document")]
    labels = spark.createDataFrame(said, "doc_id long, quality int, toxic int, part string")
    expected = plain_audit(rows, marks)
    for run in (1 << 16, 4):
        assert Counter(tuple(r) for r in filter_audit.audit(docs, labels, run).collect()) == expected
    assert filter_audit.audit(no_docs, labels).collect() == []
    assert filter_audit.audit(docs, labels.limit(0)).groupBy().sum("good_lost", "toxic_lost").first()[:] == (0, 0)
