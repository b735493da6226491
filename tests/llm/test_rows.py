"""Operators that judge row by row: compression bands and language ID."""

import gc
import random
import re
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pnlflow.llm import common, lang_cnn, quality_bands
from pnlflow.llm.common import numbered, own_numbers, remainder_of_id, remembered, slices, table, tokenizer_path
from pnlflow.llm.word_codec import codec
from tests.llm.conftest import prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(odd_docs, odd_rows):
    got = quality_bands.compression_bands(odd_docs).collect()
    assert len(got) == len(odd_rows)
    def found(r):
        return (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
    expected = Counter()
    for i, t in odd_rows:
        c = plain_counts(t)
        expected[(i, *c, c[0] < 10 or 100 * c[4] > 20 * c[0])] += 1
    assert Counter(map(found, got)) == expected
    assert not any(r.kept for r in got if r.base_failed)


def test_counts_on_given_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = {r.doc_id: r for r in quality_bands.compression_bands(docs).collect()}
    for r in docs.collect():
        g = got[r.doc_id]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == plain_counts(r.text)


def test_bands_reject_repetition_and_noise(odd_docs, odd_rows):
    got = {r.doc_id: r for r in quality_bands.compression_bands(odd_docs).collect()}
    number = {t: i for i, t in odd_rows}
    assert got[number["die " * 5000]].zstd_ratio < 0.05 and not got[number["die " * 5000]].kept
    noise = next(r for r in got.values() if r.n_bytes == 6150)
    assert noise.zstd_ratio > 0.75 and noise.n_high_chunks >= 3 and not noise.base_failed and not noise.kept
    assert got[14].kept


@pytest.mark.parametrize("key", [0, 1, 3])
def test_repeated_words_when_hashes_collide(monkeypatch, key):
    """Windows share a key: all of them, or ``key`` classes of windows."""
    ids, doc = np.array([1, 2, 3, 4, 5, 9, 1, 2, 3, 4, 5, 7, 7, 8, 8, 8, 8, 8]), np.array([0] * 13 + [1] * 5)
    assert quality_bands.repeated_words(ids, doc, 2).tolist() == [10, 0]
    monkeypatch.setattr(quality_bands, "window_keys", lambda ids, doc, window: np.arange(len(ids) - window + 1, dtype=np.uint64) % np.uint64(key + 1) * np.uint64(key > 0))
    assert quality_bands.repeated_words(ids, doc, 2).tolist() == [10, 0]


def test_good_documents_stay(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    got = quality_bands.compression_bands(docs).join(labels, "doc_id").where("quality = 1 and not base_failed")
    kept = got.agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert kept > 0.99


@pytest.mark.parametrize("f", [quality_bands.compression_bands, quality_bands.kept_rows, lambda d: lang_cnn.identify(d, None), lambda d: lang_cnn.spoken_rows(d, None)])
def test_empty_table(no_docs, f):
    assert f(no_docs).collect() == []


def test_kept_rows_keeps_columns(odd_docs):
    kept = quality_bands.kept_rows(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.count() == quality_bands.compression_bands(odd_docs).where("kept").count()


def test_language_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    net = lang_cnn.fit(docs, learn=remainder_of_id("doc_id", 4) != 2)
    got = lang_cnn.identify(docs, net).join(docs, "doc_id").where(remainder_of_id("doc_id", 4) == 2).collect()
    assert len(got) > 100 and np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    assert all(0 <= r.score <= 1 and r.lang_pred in net.langs for r in got)


def test_language_odd_rows(spark, odd_docs, odd_rows):
    import random

    rng = random.Random(5)
    rows = [(i, prose(rng, 60, ["the", "and", "with", "house"] if i % 2 else ["der", "und", "nicht", "straße"]), "en" if i % 2 else "de") for i in range(200)]
    rows += [(500, "no label", None), (501, None, "en")]
    net = lang_cnn.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert net.langs == ["de", "en"]
    got = lang_cnn.identify(odd_docs, net).collect()
    assert len(got) == len(odd_rows)
    by = Counter((r.doc_id, r.lang_pred == "und", r.score == 0) for r in got)
    letterless = {i for i, t in odd_rows if not any(c.isalpha() for c in t or "")}
    assert {i for (i, und, zero), _ in by.items() if und and zero} == letterless
    assert lang_cnn.fit(spark.createDataFrame([], "doc_id long, text string, lang string")) is None
    assert {r.lang_pred for r in lang_cnn.identify(odd_docs, None).collect()} == {"und"}


def test_windows_cover_whole_texts():
    shape = lang_cnn.Shape(window=16)
    data = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz" * 3, np.uint8)
    codes, owner = lang_cnn.windows(data, np.array([0, 0, 5, len(data)]), shape)
    assert owner.tolist()[0] == 1 and set(owner.tolist()) == {1, 2}
    seen = {tuple(c[k:k + 5]) for c in codes[owner == 2] for k in range(12)}
    body = lang_cnn.CLASSES[data[5:]]
    assert all(tuple(body[k:k + 5]) in seen for k in range(len(body) - 4))


def test_network_forward_pass_and_gradient():
    """Probabilities against a plain loop over windows, filters and positions; training lowers the loss."""
    rng = np.random.default_rng(0)
    shape = lang_cnn.Shape(window=24, dim=3, widths=(2, 3), filters=2, epochs=1, batch=4)
    codes = rng.integers(0, lang_cnn.N_CLASSES, (9, shape.window)).astype(np.uint8)
    answers = rng.integers(0, 2, 9)
    net = lang_cnn.train(codes, answers, ["a", "b"], shape)

    def plain(net, row):
        x, pooled = net.embed[row], []
        for f in range(net.conv.shape[1]):
            reach = max(shape.widths)
            pooled.append(max(float(x[t:t + reach].ravel() @ net.conv[:, f]) for t in range(shape.window - reach + 1)))
        hidden = np.maximum(np.array(pooled) + net.bias, 0)
        z = np.exp(hidden @ net.out + net.out_bias)
        return z / z.sum()

    assert np.allclose(net.probabilities(codes), [plain(net, row) for row in codes], atol=1e-5)
    for k, width in enumerate(shape.widths):  # a narrow filter sees no further than its width
        assert not net.conv[width * shape.dim:, k * shape.filters:(k + 1) * shape.filters].any()
    loss = lambda n: -np.log(n.probabilities(codes)[np.arange(9), answers]).mean()
    more = lang_cnn.train(codes, answers, ["a", "b"], lang_cnn.Shape(**{**shape.__dict__, "epochs": 60}))
    assert loss(more) < loss(net) and loss(more) < 0.3


@pytest.mark.parametrize("ids", ["null", "one"])
def test_training_sample_of_rows_without_ids(spark, ids, monkeypatch):
    """Labelled rows without ids, or with one shared id, are drawn like all others, and no more of them."""
    rng = random.Random(7)
    rows = [(None if ids == "null" else 7, prose(rng, 40, ["alpha", "beta", "gamma", "delta"] if k % 2 else ["uno", "dos", "tres", "cuatro"]), "xy"[k % 2]) for k in range(2000)]
    rows += [(None, rows[0][1], "x")] * 500  # copies of one text
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    seen, real = [], lang_cnn.train
    monkeypatch.setattr(lang_cnn, "train", lambda codes, answers, langs, shape: seen.append(np.bincount(answers)) or real(codes, answers, langs, shape))
    shape = lang_cnn.Shape(docs_per_lang=50, epochs=2)
    net = lang_cnn.fit(docs, shape)
    assert net is not None and len(seen[0]) == 2 and (seen[0] > 0).all() and (seen[0] <= 50 * shape.windows_per_doc).all()


def test_slices_of_pressed_values_go_by_what_they_open_to():
    import pyarrow as pa
    import zstandard

    from pnlflow.llm.common import slices

    raw = [b"one phrase " * 100_000, b"", None, b"x", b"one phrase " * 50_000, b"one phrase " * 50_000]
    batch = pa.RecordBatch.from_arrays([pa.array([None if b is None else zstandard.ZstdCompressor().compress(b) if b else b"" for b in raw], pa.binary())], names=["text"])
    assert [s.num_rows for s in slices([batch], most=1 << 20, pressed=True)] == [1, 4, 1]
    assert [s.num_rows for s in slices([batch], most=1 << 20)] == [6]


def test_numbers_need_no_collector():
    """A dict of a slice's words goes with the slice, not when the collector comes round."""
    gc.collect()
    gc.disable()
    try:
        words = [b"w%d" % k for k in range(100)]
        known = own_numbers()
        numbers, in_order = numbered(words + words, known).tolist(), list(known) == words
        with_dict = sys.getrefcount(words[0])
        del known
        without = sys.getrefcount(words[0])
        assert numbers == [*range(100)] * 2 and in_order and without == with_dict - 1
    finally:
        gc.enable()


def test_a_worker_forgets_what_another_task_does_not_use():
    """A pipeline's workers go from packing to stages that need the room."""
    batch = pa.RecordBatch.from_arrays([pa.array(["a b", None])], names=["text"])
    held = remembered()
    try:
        held["codec"] = object()
        assert list(slices([batch], remembers=True)) == [batch] and held
        assert list(slices([batch])) == [batch] and not held
    finally:
        common._remembered.pop()
    path = tokenizer_path("word_bpe_49k.json")
    first = codec(path, False)
    assert codec(path, False) is first
    list(slices([batch]))
    assert codec(path, False) is not first
