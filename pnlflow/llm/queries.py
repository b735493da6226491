"""The thin registered queries: each applies one operator, with its production parameters, to
its whole table and derives the columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pnlflow.llm import backoff_automaton, best_fit_packing, bpe_queue, bpe_words, bwt_dedup, filter_audit, lang_cnn, merkle_fixity, multi_index, quality_bands, simhash_tiles, token_alignment, vbyte_ids
from pnlflow.llm.common import remainder_of_id, scratch_path, table, tokenizer_path


def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every 50th vector among all others."""
    return multi_index.neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", asks=F.col("vec_id") % 50 == 0, top=5)


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compression bands over all documents."""
    return quality_bands.compression_bands(table(spark, sf_dir, "documents"))


def op3_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive of all pages against a replica with rot: some records altered in place, some lost
    on either side."""
    pages = table(spark, sf_dir, "pages")
    whole = merkle_fixity.archive(pages)
    altered = F.when(F.col("page_id") % 101 == 7, F.translate("html", "ae", "ea")).otherwise(F.col("html"))
    rotten = merkle_fixity.archive(pages.withColumn("html", altered))
    return merkle_fixity.audit(whole.where("record_id % 307 <> 13"), rotten.where("record_id % 257 <> 11"))


_FIXITY_SQL = """
WITH replicas AS (
  SELECT 1 AS side, page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages
  UNION ALL
  SELECT 2, page_id, coalesce(url, ''), CASE WHEN page_id % 101 = 7 THEN translate(coalesce(html, ''), 'ae', 'ea') ELSE coalesce(html, '') END FROM pages),
records AS (
  SELECT side, page_id, page_id // 1024 AS volume,
         'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)
         || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html
         || chr(13) || chr(10) || chr(13) || chr(10) AS record FROM replicas),
placed AS (
  SELECT side, page_id, volume, sha256(record) AS sha256,
         CAST(sum(strlen(record)) OVER (PARTITION BY side, volume ORDER BY page_id ROWS UNBOUNDED PRECEDING) - strlen(record) AS BIGINT) AS "offset" FROM records),
one AS (SELECT * FROM placed WHERE side = 1 AND page_id % 307 <> 13),
two AS (SELECT * FROM placed WHERE side = 2 AND page_id % 257 <> 11)
SELECT coalesce(one.volume, two.volume) AS volume, coalesce(one."offset", two."offset") AS "offset",
       CASE WHEN two.page_id IS NULL THEN 'missing' WHEN one.page_id IS NULL THEN 'extra' ELSE 'damaged' END AS status,
       CASE WHEN one.page_id IS NOT NULL THEN CAST(1 AS BIGINT) END AS first_records, one.page_id AS first_id, one.sha256 AS first_sha256,
       CASE WHEN two.page_id IS NOT NULL THEN CAST(1 AS BIGINT) END AS second_records, two.page_id AS second_id, two.sha256 AS second_sha256
FROM one FULL JOIN two ON one.volume = two.volume AND one."offset" = two."offset"
WHERE one.sha256 IS DISTINCT FROM two.sha256
"""


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as sequences of 2048 byte-level BPE ids, each document ended by id 0."""
    return best_fit_packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), end=0, size=2048).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op5_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 200-byte strings of all documents."""
    return bwt_dedup.remove_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_vbyte_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as frequency-ranked ids and read back from the files."""
    path = scratch_path(spark, "token-ids")
    vbyte_ids.write(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end=1, path=path)
    return vbyte_ids.read(spark, path)


def op7_lang_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents; training sees three quarters of them only."""
    docs = table(spark, sf_dir, "documents")
    net = lang_cnn.fit(docs, learn=remainder_of_id("doc_id", 4) != 2)
    return lang_cnn.identify(docs, net).select("doc_id", (remainder_of_id("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op8_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash groups of all documents: three-word shingles, two bits."""
    return simhash_tiles.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, radius=2)


def op9_bpe_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded, each distinct pre-token once."""
    return bpe_words.encode(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"))


def op10_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; four fifths of them are learned from.  Histories of one word: with two
    the counts of distinct triples do not fit the disk and memory limits (README)."""
    return backoff_automaton.score(table(spark, sf_dir, "documents"), learn=remainder_of_id("doc_id", 5) != 1, order=2)


def op11_bpe_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by a queue of merges, and decoded from the ids."""
    path = tokenizer_path("byte_bpe_50k.json")
    coded = bpe_queue.decode(bpe_queue.encode(table(spark, sf_dir, "documents"), path), path)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE tokens of all documents against those of a sentencepiece model."""
    return token_alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of five filters over all documents of each language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_AUDIT_SQL = r"""
WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
split AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM texts),
judged AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS fails FROM split),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
classes AS (  -- documents of a part that fail the same filters
  SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM judged LEFT JOIN marks ON marks.doc_id = judged.doc_id GROUP BY part, fails),
letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, bit)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, s AS step, bits[s] AS bit, CAST(list_sum(bits[1:s]) AS BIGINT) - bits[s] AS before FROM orders, range(1, 6) r(s)),
figures AS (
  SELECT part, filter_order, step, bit, sum(CASE WHEN fails & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN fails & before <> 0 AND fails & bit <> 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN fails & before = 0 AND fails & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM classes, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM figures
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_multi_index, op2_compression_bands, op3_merkle_fixity, op4_best_fit_packing, op5_bwt_dedup, op6_vbyte_ids, op7_lang_cnn, op8_simhash_tiles,
                                   op9_bpe_words, op10_backoff_automaton, op11_bpe_queue, op12_token_alignment, op13_filter_audit)}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where SQL can express the result."""
    return {"op3_merkle_fixity": _FIXITY_SQL, "op13_filter_audit": _AUDIT_SQL}
