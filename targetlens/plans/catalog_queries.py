"""Registered queries: catalog search and relevance."""

from __future__ import annotations

from pyspark.sql import functions as F

from targetlens.functions import columns as fc
from targetlens.operators import catalog as ct
from targetlens.plans import bindings as b
from targetlens.plans.bindings import sql
from targetlens.plans.registry import Family, rounded, rsql

family = Family()
register = family.register
QUERIES, ORACLES = family.queries, family.oracles

# Search topics over the generated prose: words stand in for diseases and directions.
DISEASES = {"with": ["haben", "avec"], "zzz": ["nicht"], "qqq": []}
DIRECTIONS = {"from": ["oder", "dans"], "www": ["para"]}
TOPICS = [ct.Topic(d, r, DISEASES, DIRECTIONS) for d in DISEASES for r in DIRECTIONS]
TEXT = "lower(concat_ws(' ', accession, title, summary))"


def _any(words) -> str:
    return "(" + " OR ".join(f"contains(txt, '{w}')" for w in words) + ")"


@register("catalog_filter", sql(f"""SELECT accession, organism, samples, platform, date FROM (SELECT *, {TEXT} AS txt,
    make_date(CAST(split_part(date, '-', 1) AS BIGINT), CAST(split_part(date, '-', 2) AS BIGINT),
    CAST(split_part(date, '-', 3) AS BIGINT)) AS dt FROM catalog) WHERE contains(lower(organism), 'en')
    AND contains(txt, 'with') AND CAST(samples AS BIGINT) BETWEEN 100 AND 50000 AND dt >= DATE '2005-01-01'
    AND dt <= DATE '2020-06-15' AND contains(lower(platform), 'src1') AND contains(lower(type), 'expression')""", "catalog"))
def catalog_filter(spark, folder):
    rows = b.catalog(spark, folder).withColumn("data_type", F.lit("bulk"))
    return ct.catalog_filter(
        rows, organism="EN", keyword="With", data_type="bulk", min_samples=100, max_samples=50000,
        start_date="2005", end_date="2020/6/15", platform="SRC1", dataset_type="Expression",
    ).select("accession", "organism", "samples", "platform", "date")


@register("classify_text_type", """SELECT doc_id AS id, CASE WHEN contains(t, 'single cell') OR contains(t, 'scrna')
    OR contains(t, 'single-cell') OR contains(t, '10x genomics') OR contains(t, 'cell ranger') OR contains(t, 'smart-seq')
    THEN 'single-cell' WHEN contains(t, 'bulk') OR contains(t, 'rna-seq') OR contains(t, 'rnaseq') THEN 'bulk' ELSE 'other' END AS data_type
    FROM (SELECT doc_id, lower(CASE doc_id % 3 WHEN 0 THEN 'Single-Cell atlas' WHEN 1 THEN 'RNAseq of' ELSE '' END || chr(10) || text) AS t
    FROM documents)""")
def classify_text_type(spark, folder):
    title = F.when(F.col("doc_id") % 3 == 0, "Single-Cell atlas").when(F.col("doc_id") % 3 == 1, "RNAseq of").otherwise("")
    return b.table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), ct.classify_text_type(title, F.col("text")).alias("data_type"))


@register("extract_accession", """SELECT page_id, 'GSE' || CAST(page_id * 37 AS VARCHAR) AS accession,
    CASE WHEN page_id * 37 < 1000 THEN 'GSE' || CAST(page_id * 37 AS VARCHAR)
    ELSE 'GSE' || CAST(page_id * 37 // 1000 AS VARCHAR) || 'nnn' END AS prefix,
    'https://www.ncbi.nlm.nih.gov/geo/query/acc.cgi?acc=GSE' || CAST(page_id * 37 AS VARCHAR) AS url FROM pages""")
def extract_accession(spark, folder):
    text = F.concat("url", F.lit(" see GSE"), (F.col("page_id") * 37).cast("string"), F.lit(";"))
    rows = b.table(spark, folder, "pages").select(
        "page_id", ct.valid_accession(F.lower(ct.extract_accession(text))).alias("accession"))
    return rows.select(
        "page_id", "accession", ct.series_prefix(F.col("accession")).alias("prefix"),
        ct.accession_url(F.col("accession")).alias("url"))


@register("lenient_date", """SELECT doc_id AS id, CAST(CASE doc_id % 4
    WHEN 0 THEN make_date(2000 + doc_id % 25, 1 + doc_id % 12, 1 + doc_id % 28)
    WHEN 1 THEN make_date(1990 + doc_id % 30, 1, 1) WHEN 2 THEN make_date(2010, 1 + doc_id % 12, 3) END AS DATE) AS date FROM documents""")
def lenient_date(spark, folder):
    d = F.col("doc_id")
    text = (
        F.when(d % 4 == 0, F.concat_ws("-", (2000 + d % 25).cast("string"), (1 + d % 12).cast("string"), (1 + d % 28).cast("string")))
        .when(d % 4 == 1, F.concat(F.lit("in "), (1990 + d % 30).cast("string")))
        .when(d % 4 == 2, F.concat(F.lit("on 2010/"), (1 + d % 12).cast("string"), F.lit("/3!"))).otherwise("unknown")
    )
    return b.table(spark, folder, "documents").select(d.alias("id"), fc.lenient_date(text).alias("date"))


@register("query_expansion", sql(f"""SELECT accession, platform FROM (SELECT *, {TEXT} AS txt FROM catalog)
    WHERE {_any(['with', 'haben', 'avec'])} AND {_any(['from', 'oder', 'dans'])}""", "catalog"))
def query_expansion(spark, folder):
    return ct.query_expansion(b.catalog(spark, folder), TOPICS[0]).select("accession", "platform")


_LEX = ("sqrt((contains(txt, 'with')::INT + contains(txt, 'haben')::INT + contains(txt, 'avec')::INT) / 3.0"
        " * (contains(txt, 'from')::INT + contains(txt, 'oder')::INT + contains(txt, 'dans')::INT) / 3.0)")


@register("lexical_score", sql(f"SELECT accession, {rsql(_LEX + ' AS score')} FROM (SELECT *, {TEXT} AS txt FROM catalog)", "catalog"))
def lexical_score(spark, folder):
    return rounded(ct.lexical_score(b.catalog(spark, folder), TOPICS[0], "score").select("accession", "score"))


@register("rerank", sql(f"""SELECT accession, {rsql('0.6 * coalesce(quality, 0) + 0.4 * ' + _LEX + ' AS relevance_score')}
    FROM (SELECT *, {TEXT} AS txt, CAST(accession[4:] AS BIGINT) AS doc_id FROM catalog) LEFT JOIN labels USING (doc_id)""", "catalog"))
def rerank(spark, folder):
    labels = b.table(spark, folder, "labels").select(
        F.concat(F.lit("GSE"), F.col("doc_id").cast("string")).alias("accession"), F.col("quality").alias("ml"))
    rows = b.catalog(spark, folder).join(labels, "accession", "left").fillna(0, ["ml"])
    return rounded(ct.rerank(rows, TOPICS[0], "ml").select("accession", "relevance_score"))


_TOPIC_ROWS = " UNION ALL ".join(
    f"SELECT accession, '{t.disease}' AS disease, '{t.direction}' AS research_direction, {i} AS topic,"
    f" {_any(t.terms()[0])} AS d, {_any(t.terms()[1])} AS r,"
    f" contains(txt, '{t.disease}') AND contains(txt, '{t.direction}') AS w FROM texts"
    for i, t in enumerate(TOPICS)
)
TOPIC_SQL = f"texts AS (SELECT accession, {TEXT} AS txt FROM catalog), asked AS ({_TOPIC_ROWS})"


@register("is_relevant", sql(f"""SELECT accession, {_any(TOPICS[0].terms()[0])} AND {_any(TOPICS[0].terms()[1])} AS relevant
    FROM (SELECT *, {TEXT} AS txt FROM catalog)""", "catalog"))
def is_relevant(spark, folder):
    return ct.is_relevant(b.catalog(spark, folder), TOPICS[0]).select("accession", "relevant")


@register("labeled_samples", sql(TOPIC_SQL + """ SELECT disease, research_direction, accession,
    CASE WHEN d AND r THEN 1 ELSE 0 END AS label FROM asked""", "catalog"))
def labeled_samples(spark, folder):
    return ct.labeled_samples(b.catalog(spark, folder), TOPICS).select(
        "disease", "research_direction", "accession", "label")


FALLBACK_SQL = TOPIC_SQL + """,
tiers AS (SELECT *, 0 AS tier FROM asked WHERE w UNION ALL SELECT *, 1 FROM asked WHERE d
  UNION ALL SELECT *, 2 FROM asked WHERE r UNION ALL SELECT *, 3 FROM asked WHERE d AND r),
per AS (SELECT topic, min(tier) FILTER (d AND r) AS tier, count(*) FILTER (tier = 0) AS c0,
  count(*) FILTER (tier = 0 AND d AND r) AS r0 FROM tiers GROUP BY 1),
firsts AS (SELECT t.topic, min(accession) AS a FROM tiers t JOIN per p ON t.topic = p.topic AND t.tier = p.tier
  WHERE d AND r GROUP BY 1),
rounds AS (SELECT DISTINCT disease, research_direction, coalesce(c0, 0) AS combined_results, coalesce(r0, 0) AS relevant_combined,
  CAST(tier AS INTEGER) AS tier, coalesce(tier > 0, false) AS expanded, tier IS NOT NULL AS found, coalesce(a, '') AS first_accession
  FROM asked LEFT JOIN per USING (topic) LEFT JOIN firsts USING (topic))
"""


@register("search_fallback", sql(FALLBACK_SQL + "SELECT * FROM rounds", "catalog"))
def search_fallback(spark, folder):
    return ct.search_fallback(b.catalog(spark, folder), TOPICS)


@register("search_hit_rate", sql(FALLBACK_SQL + """SELECT count(*) AS rounds, count(*) FILTER (found) AS found,
    round(avg(CASE WHEN found THEN 1.0 ELSE 0.0 END), 4) AS found_rate, count(*) FILTER (expanded) AS expanded_rounds,
    CAST(sum(combined_results) AS BIGINT) AS total_results, round(avg(combined_results), 2) AS avg_results FROM rounds""", "catalog"))
def search_hit_rate(spark, folder):
    return ct.search_hit_rate(ct.search_fallback(b.catalog(spark, folder), TOPICS))
