"""Registered queries of the operators and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from targetlens.llm.common import table
from targetlens.llm.decontamination import contamination
from targetlens.llm.html_extraction import extract_main_text
from targetlens.llm.line_dedup import dedup_lines, similar_characters
from targetlens.llm.license_scan import license_report
from targetlens.llm.pii import personal_data_report
from targetlens.llm.periodic_runs import run_digest
from targetlens.llm.phrases import collocations
from targetlens.llm.piece_codec import piece_report
from targetlens.llm.quality_rules import quality_report
from targetlens.llm.simhash_dedup import simhash_near_duplicates
from targetlens.llm.substring_dedup import passage_report
from targetlens.llm.token_counts import count_tokens
from targetlens.llm.warc import archived_pages


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, similar=similar_characters, segments=True).select(
        "doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_kept").alias("n_kept"),
        F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary).withColumnRenamed("_id", "doc_id")


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_main_text(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs, items).select(
        F.col("_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passage_report(docs).withColumnRenamed("_id", "doc_id")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(table(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_report(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
    )


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents")).select(
        F.col("_id").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels",
        "labels", "score",
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(table(spark, sf_dir, "documents"))


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_html_extraction": op3_html_extraction,
    "op4_decontamination": op4_decontamination,
    "op5_quality_rules": op5_quality_rules,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_pii": op7_pii,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_warc": op11_warc,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_phrase_collocations": op13_phrase_collocations,
}
_WORDS = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)
#: The contract in SQL, by comparing every run of words; the other queries are tested against
#: libraries and brute force instead.
ORACLES = {
    "op4_decontamination": f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents), b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS run FROM
      (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
    lens AS (SELECT DISTINCT n FROM win),
    hit AS (SELECT DISTINCT doc_id, item_id, i, n FROM
      (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS run FROM
        (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN lens ON len(w) >= n)) JOIN win USING (run, n)),
    places AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hit) GROUP BY 1),
    items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM
      (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
      coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit > 0, false) AS contaminated
    FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_warc": """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
    t AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS top FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
      array_to_string(list_transform(range(0, 4), lambda i: array_to_string(list_transform(range(7, -1, -1), lambda j:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, 1 + 10 * i, 10) AS BIGINT) >> (5 * j)) & 31), 1)), '')), '') AS payload_digest,
      CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to
    FROM t""",
    "op13_phrase_collocations": """
    WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
    w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
    g AS (SELECT lang, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM
      (SELECT lang, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS t(n) WHERE len(w) >= n)),
    f AS (SELECT lang, n, phrase, count(*) AS a FROM g GROUP BY ALL),
    totals AS (SELECT lang, sum(a) AS total FROM f WHERE n = 1 GROUP BY 1),
    c AS (SELECT lang, n, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE n > 1 AND a >= 30),
    cuts AS (SELECT lang, n, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:n], ' ') AS tail FROM
      (SELECT *, unnest(range(1, n)) AS k FROM c)),
    scored AS (SELECT cuts.lang, cuts.n, cuts.phrase, cuts.a, k, h.a AS l, t.a AS r,
        CAST(2000000 AS HUGEINT) * cuts.a // (h.a + t.a) AS score
      FROM cuts JOIN f AS h ON h.lang = cuts.lang AND h.phrase = head JOIN f AS t ON t.lang = cuts.lang AND t.phrase = tail),
    best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    covers AS (SELECT lang, phrase, max(a) AS cover FROM
      (SELECT lang, a, array_to_string(w[i:i + size - 1], ' ') AS phrase FROM
        (SELECT *, unnest(range(1, n - size + 2)) AS i FROM (SELECT *, unnest(range(2, n)) AS size FROM c))) GROUP BY 1, 2),
    ranked AS (SELECT best.*, row_number() OVER (PARTITION BY best.lang ORDER BY score DESC, a DESC, best.phrase) AS rank
      FROM best LEFT JOIN covers USING (lang, phrase) WHERE cover IS NULL OR 100 * cover < 80 * a)
    SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, CAST(total AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
