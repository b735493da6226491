"""The pipeline's stages, each on what its predecessor kept."""

from collections import Counter

import pytest

import corpus_pipeline
from pnlflow.llm import bwt_dedup, lang_cnn, quality_bands, queries, simhash_tiles
from pnlflow.llm.common import stored, table
from tests.llm.test_duplicates import plain_repeats

SF = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    found = queries.queries()
    assert [int(n[2:].split("_")[0]) for n in found] == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(found)


def test_stages(spark):
    docs = table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "simhash_dedup", "suffix_dedup", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stored(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        if name == "quality_rules":
            good = quality_bands.compression_bands(docs).where("kept").select("doc_id").collect()
            assert {r.doc_id for r in out.collect()} == {r.doc_id for r in good}
        if name == "simhash_dedup":
            groups = simhash_tiles.near_duplicates(docs).select("component_id").distinct().collect()
            assert {r.doc_id for r in out.collect()} == {r.component_id for r in groups}
        if name == "suffix_dedup":
            rows = docs.orderBy("doc_id").collect()
            left = {r.doc_id: r for r in out.collect()}
            for r, (n, gone, _, _) in zip(rows, plain_repeats([r.text for r in rows])):
                assert left[r.doc_id].n_chars == len(left[r.doc_id].text)
                assert n - gone - len(left[r.doc_id].text.encode()) in range(0, 4 * 30)
        docs, kept[name] = out, out.count()
    assert len(before) >= kept["language_id"] > kept["quality_rules"] > kept["simhash_dedup"] == kept["suffix_dedup"] > 100
    packed = corpus_pipeline.packing(spark, docs, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.collect()}


@pytest.mark.parametrize("k", range(5))
def test_stages_on_odd_rows_and_empty_tables(spark, odd_docs, no_docs, k):
    name, stage = corpus_pipeline.STAGES[k]
    for docs in (odd_docs, no_docs):
        out = stage(spark, docs, SF)
        assert k == 4 or out.columns == docs.columns
        assert (out.count() > 0) == (docs is odd_docs)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 100
    assert bwt_dedup and lang_cnn


@pytest.mark.parametrize("lang", [None, "en"])
def test_language_stage_without_a_network_keeps_text(spark, odd_rows, lang):
    """No label at all, or none on a text with a window of 16 letters."""
    rows = [(i, t, None) for i, t in odd_rows] + [(900, "short", lang)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert lang_cnn.fit(docs) is None
    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert kept.columns == docs.columns
    spoken = Counter((i, t) for i, t, _ in rows if any(c.isalpha() for c in t or ""))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == spoken
