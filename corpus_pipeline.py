"""The corpus pipeline: documents in, training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs.  All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pnlflow.llm import best_fit_packing, bwt_dedup, lang_cnn, quality_bands, simhash_tiles
from pnlflow.llm.common import stored, table, tokenizer_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are text in one of the learned languages: ``und`` goes, that is null text,
    text without letters, and what the network calls ``und`` if it was taught that label.  Where no
    label is given, every text with letters stays."""
    return lang_cnn.spoken_rows(docs, lang_cnn.fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents inside their compression bands."""
    return quality_bands.kept_rows(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that of smallest id.  Documents without
    an id, or with an id that another text has too, are judged by their texts like all others."""
    return simhash_tiles.one_of_each_group(docs)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes every 200-byte string that starts twice or more in what is left, all places of it.
    A code point that a cut divides is dropped; n_chars follows the new text."""
    rest = bwt_dedup.remove_repeats(docs, keep=tuple(docs.columns), with_text=True)
    changed = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return rest.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of 2048 ids: one row per piece of a document.  Workers remember fewer words than
    in a packing of its own: the stages before have filled the executor's heap."""
    return best_fit_packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), words=600_000)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("quality_rules", quality_rules),
    ("simhash_dedup", simhash_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

#: Model inference, compression and tokenization are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each stage's result is stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs
