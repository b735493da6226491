"""SimHash tiles, components and suffix-array dedup against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from pnlflow.llm import bwt_dedup, simhash_tiles
from pnlflow.llm.common import table
from pnlflow.llm.components import components
from tests.llm.test_rows import WORD


def plain_fingerprint(text, k=3):
    words = [w for w in WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))]
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=2):
    """fingerprint -> smallest id reachable."""
    fps = sorted({plain_fingerprint(t) for _, t in rows})
    least = {f: min((i for i, t in rows if i is not None and plain_fingerprint(t) == f), default=None) for f in fps}
    group = {f: f for f in fps if least[f] is not None}
    find = lambda f: f if group[f] == f else find(group[f])
    for a in group:
        for b in group:
            if (a ^ b).bit_count() <= radius:
                group[find(a)] = find(b)
    return fps, {f: min(least[g] for g in group if find(g) == find(f)) for f in group}


@pytest.mark.parametrize("tile", [2048, 2])
def test_simhash_equals_brute_force(odd_docs, odd_rows, tile):
    got = Counter(tuple(r) for r in simhash_tiles.near_duplicates(odd_docs, tile=tile).collect())
    _, group = plain_groups(odd_rows)
    expected = Counter((i, f"{plain_fingerprint(t):016x}", group.get(plain_fingerprint(t))) for i, t in odd_rows)
    assert got == expected


def test_tiles_lose_no_link(spark):
    rng = random.Random(1)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        for _ in range(12):
            fps.add(f)
            f ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
    fps |= {rng.getrandbits(64) for _ in range(300)} | {0, (1 << 64) - 1, 3, 1}
    points = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in points]
    df = spark.createDataFrame([(s, i) for i, s in enumerate(signed)], "fp long, id long")
    got = {r.node: r.component for r in components(simhash_tiles.links(df, 2, tile=5)).collect()}
    label = np.arange(len(points))
    a, b = np.nonzero(np.bitwise_count(np.array(points, np.uint64)[:, None] ^ np.array(points, np.uint64)) <= 2)
    label = simhash_tiles.forest(a, b, len(points))
    assert [got.get(i, i) for i in range(len(points))] == label.tolist()


def test_one_of_each(odd_docs, odd_rows):
    kept = simhash_tiles.one_of_each(odd_docs)
    _, group = plain_groups(odd_rows)
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(group.values()))


def plain_text_groups(rows, radius=2):
    """fingerprint -> smallest fingerprint reachable, rows without id included."""
    fps = sorted({plain_fingerprint(t) for _, t in rows})
    a, b = np.nonzero(np.bitwise_count(np.array(fps, np.uint64)[:, None] ^ np.array(fps, np.uint64)) <= radius)
    return {f: fps[k] for f, k in zip(fps, simhash_tiles.forest(a, b, len(fps)).tolist())}


@pytest.mark.parametrize("tile", [2048, 2])
def test_one_of_each_group_loses_no_group(spark, odd_docs, odd_rows, tile):
    kept = simhash_tiles.one_of_each_group(odd_docs, tile=tile)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    rows, group = [(r.doc_id, r.text) for r in kept.collect()], plain_text_groups(odd_rows)
    assert sorted(group[plain_fingerprint(t)] for _, t in rows) == sorted(set(group.values()))  # each group once
    least = {}
    for i, t in odd_rows:
        g = group[plain_fingerprint(t)]
        least[g] = min(least.get(g, (True, 0)), (i is None, i or 0))
    assert all((i is None, i or 0) == least[group[plain_fingerprint(t)]] for i, t in rows)


def test_stage_keeps_documents_without_and_with_shared_ids(spark):
    rng = random.Random(17)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(80))
    copied, shared, early = text(), text(), text()
    alone = [text() for _ in range(20)]
    rows = [(None, t) for t in alone] + [(None, copied), (None, copied), (None, copied.upper())]  # a third without ids, and a group of them
    rows += [(1, early), (7, early), (7, shared), (7, text()), (9, shared), (9, None)]
    kept = corpus_pipeline.simhash_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    got = Counter((r.doc_id, r.text if r.doc_id is not None else (r.text or "").lower()) for r in kept)
    assert got == Counter([(None, t) for t in alone] + [(None, copied), (1, early), (7, shared), rows[-3], (9, None)])


def test_rows_that_share_an_id_link_nothing(spark):
    rng = random.Random(18)
    text = lambda: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(80))
    one, two = text(), text()
    docs = spark.createDataFrame([(3, one), (3, two), (5, two), (None, two), (2, one)], "doc_id long, text string")
    got = {(r.doc_id, r.fingerprint): r.component_id for r in simhash_tiles.near_duplicates(docs).collect()}
    a, b = (f"{plain_fingerprint(t):016x}" for t in (one, two))
    assert got == {(3, a): 2, (2, a): 2, (3, b): 3, (5, b): 3, (None, b): 3}


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{100 + i: 100 for i in range(1, 80)}, 300: 299}


def test_empty(no_docs):
    assert simhash_tiles.near_duplicates(no_docs).collect() == []
    assert simhash_tiles.one_of_each(no_docs).collect() == []
    assert bwt_dedup.remove_repeats(no_docs).collect() == []


def plain_repeats(texts, length=200):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    for b in data:
        cover = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                cover[i:i + length] = b"\1" * length
        rest = bytes(x for x, c in zip(b, cover) if not c)
        yield len(b), sum(cover), sum(1 for i, c in enumerate(cover) if c and not (i and cover[i - 1])), hashlib.sha256(rest).hexdigest()


@pytest.mark.parametrize("settings", [{}, {"crowd": 2}, {"block": 8, "chunk": 1000, "shards": 7, "run": 50}, {"block": 200, "shards": 1}])
def test_suffix_dedup_equals_brute_force(odd_docs, odd_rows, settings):
    got = bwt_dedup.remove_repeats(odd_docs, bwt_dedup.Settings(**settings)).collect()
    expected = Counter((i, *x) for (i, _), x in zip(odd_rows, plain_repeats([t for _, t in odd_rows])))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == expected
    assert sum(r.n_removed > 0 for r in got) >= 8


def test_suffix_dedup_on_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.select("doc_id", "text").collect()
    got = bwt_dedup.remove_repeats(docs).collect()
    expected = {(r.doc_id, *x) for r, x in zip(rows, plain_repeats([r.text for r in rows]))}
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == expected


def test_common_passage_under_the_length_is_split_and_kept(spark):
    rng = random.Random(9)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    common, long = letters(195), letters(203)
    texts = [letters(220) + common + letters(220) for _ in range(60)] + [letters(220) + long + letters(220) for _ in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(tuple(r)[:5] for r in bwt_dedup.remove_repeats(docs, bwt_dedup.Settings(crowd=5)).collect())
    assert got == [(i, *x) for i, x in enumerate(plain_repeats(texts))]
    assert sum(r[2] > 0 for r in got) == 30


def test_text_that_stays(spark):
    words = " ".join(f"wört{i}" for i in range(60))
    docs = spark.createDataFrame([(1, "a é " + words, 7), (2, words + " b", 8), (3, None, 9), (4, "short", 1)], "doc_id long, text string, extra long")
    got = {r.doc_id: r for r in bwt_dedup.remove_repeats(docs, keep=("doc_id", "extra"), with_text=True).collect()}
    assert (got[1].kept_text, got[2].kept_text, got[3].kept_text, got[4].kept_text) == ("a é ", " b", None, "short")
    assert got[1].extra == 7 and got[3].n_bytes == 0
    assert [(x.start, x.end) for x in got[2].removed] == [(0, len(words.encode()))]


def test_merge_equals_plain_sort():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1500:1800] = data[100:400]
    at = np.array([0, 700, 1400, 2200, 3000])
    s = bwt_dedup.Settings(length=24, block=8, gram=8, shards=3)
    hit = bwt_dedup.repeated_starts(data, at, np.array([1, 1, 1, 2]), s)
    texts = [data[a:b].tobytes() for a, b in zip(at, at[1:])]
    seen = Counter()
    for t, w in zip(texts, (1, 1, 1, 2)):
        seen.update({k: w * v for k, v in Counter(t[i:i + 24] for i in range(len(t) - 23)).items()})
    expected = [len(t) - i >= 24 and seen[t[i:i + 24]] > 1 for t in texts for i in range(len(t))]
    assert hit.tolist() == expected


def test_block_names_when_hashes_collide(monkeypatch):
    data = np.frombuffer(b"abcdefghijabcdefghijxyzxyzxyzxyz" * 2, np.uint8)
    real = bwt_dedup.block_names(data, 10)
    monkeypatch.setattr(bwt_dedup, "piece_hashes", lambda d, n: np.zeros(len(d) - n + 1, np.uint64))
    forced = bwt_dedup.block_names(data, 10)
    for names in (real, forced):
        assert all((names[i] == names[j]) == (data[i:i + 10].tobytes() == data[j:j + 10].tobytes()) for i in range(len(names)) for j in range(len(names)))
