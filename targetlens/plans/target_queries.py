"""Registered queries: scoring dimensions, ranked targets, feedback, screening results."""

from __future__ import annotations

from pyspark.sql import functions as F

from targetlens.functions import columns as fc
from targetlens.functions import ordering as od
from targetlens.operators import expression as ex
from targetlens.operators import qc
from targetlens.operators import screening as sc
from targetlens.operators import targets as tg
from targetlens.plans import bindings as b
from targetlens.plans.bindings import sql
from targetlens.plans.registry import Family, rounded, rsql
from targetlens.plans.statistics_queries import COEX_SQL
from targetlens.plans.network_queries import GRAPH_SQL

family = Family()
register = family.register
QUERIES, ORACLES = family.queries, family.oracles


def _lines(spark, folder, *extra):
    lines, parts = b.table(spark, folder, "lineitem"), b.table(spark, folder, "part")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))


def dependency(spark, folder):
    return _lines(spark, folder).select(
        F.col("p_name").alias("gene"), (F.col("l_tax") - F.col("l_discount")).alias("gene_effect"),
        F.concat(F.lit("liver "), F.col("l_returnflag")).alias("lineage"))


def prognosis(spark, folder):
    return b.table(spark, folder, "part").groupBy(F.col("p_name").alias("gene")).agg(
        (F.avg("p_size") / 25.0).alias("hr"))


def evidence(spark, folder):
    return b.table(spark, folder, "part").select(
        F.col("p_name").alias("gene"), F.col("p_size").alias("known_ligands"),
        F.col("p_retailprice").alias("pdb_structures"), F.col("p_type").alias("chembl_bioactivities"),
        (F.col("p_partkey") % 7).alias("off_target_paralogs"),
        F.when(F.col("p_brand") == "Brand#1", "yes").when(F.col("p_brand") == "Brand#2", "no")
        .otherwise("0").alias("safety_concern"))


SIDES_SQL = """
dep AS (SELECT p_name AS gene, avg(l_tax - l_discount) AS depmap_effect FROM lineitem
  JOIN part ON l_partkey = p_partkey WHERE lower('liver ' || l_returnflag) LIKE '%liver a%' GROUP BY 1),
hrs AS (SELECT p_name AS gene, avg(p_size) / 25.0 AS prognosis_hr FROM part GROUP BY 1),
drug AS (SELECT p_name AS gene, max(ln(1 + greatest(0, p_size + p_retailprice))) AS druggable_hits
  FROM part GROUP BY 1),
off_t AS (SELECT p_name AS gene, CAST(max(p_partkey % 7) AS DOUBLE) AS off_target_paralogs,
  CAST(max(CASE WHEN p_brand = 'Brand#1' THEN 1 ELSE 0 END) AS DOUBLE) AS safety_concern FROM part GROUP BY 1),
mat AS (SELECT gene, sample, log2(value + 1) AS v FROM expression),
lfc AS (SELECT gene, sum(CASE WHEN condition = 'EUROPE' THEN v ELSE 0 END)
    / (SELECT count(*) FROM samples WHERE condition = 'EUROPE') AS case_mean,
  sum(CASE WHEN condition = 'ASIA' THEN v ELSE 0 END)
    / (SELECT count(*) FROM samples WHERE condition = 'ASIA') AS normal_mean FROM mat JOIN samples USING (sample) GROUP BY 1)
"""


def prank(value: str) -> str:
    return (f"(rank() OVER (ORDER BY {value}) + (count(*) OVER (PARTITION BY {value}) - 1) / 2.0)"
            " / count(*) OVER ()")


@register("dependency_effect", sql(SIDES_SQL + "SELECT gene, " + rsql("depmap_effect") + ", (SELECT count(*) FROM dep) AS n_models FROM dep",
    "counts", "cells", "expression", "samples"))
def dependency_effect(spark, folder):
    return rounded(tg.dependency_effect(dependency(spark, folder), "liver a"))


@register("druggability", sql(SIDES_SQL + "SELECT gene, " + rsql("druggable_hits", prank("druggable_hits")
    + " AS druggability_score") + " FROM drug", "counts", "cells", "expression", "samples"))
def druggability(spark, folder):
    hits = tg.druggability(evidence(spark, folder))
    return rounded(od.pct_rank(hits, "druggable_hits", "druggability_score"))


@register("off_target", sql(SIDES_SQL + "SELECT gene, off_target_paralogs, safety_concern FROM off_t",
    "counts", "cells", "expression", "samples"))
def off_target(spark, folder):
    return tg.off_target(evidence(spark, folder))


@register("truthy", """SELECT p_partkey AS id, CASE WHEN p_brand = 'Brand#1' THEN 1.0 WHEN p_brand = 'Brand#2' THEN 0.0
    WHEN p_brand = 'Brand#3' THEN CAST(p_size AS DOUBLE) ELSE 0.0 END + 0.0::DOUBLE AS flag FROM part""")
def truthy(spark, folder):
    raw = (F.when(F.col("p_brand") == "Brand#1", " YES ").when(F.col("p_brand") == "Brand#2", "n")
           .when(F.col("p_brand") == "Brand#3", F.col("p_size").cast("string")))
    return b.table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), fc.truthy(raw).alias("flag"))


@register("prognosis", sql(SIDES_SQL + "SELECT gene, " + rsql("prognosis_hr",
    "sign(case_mean - normal_mean) * ln(prognosis_hr) AS prognosis_effect")
    + " FROM lfc JOIN hrs USING (gene)", "counts", "cells", "expression", "samples"))
def prognosis_query(spark, folder):
    lfc = ex.group_means_lfc(b.expression(spark, folder), roles(spark, folder))
    return rounded(tg.prognosis(lfc, prognosis(spark, folder)))


def roles(spark, folder):
    groups = b.samples(spark, folder).select("sample", F.col("condition").alias("group"))
    return tg.assign_case_normal(groups, b.CASE, b.NORMAL)


@register("assign_case_normal", sql("""SELECT sample, CASE condition WHEN 'AFRICA' THEN 'normal' ELSE 'case' END AS role
    FROM samples WHERE condition IN ('AFRICA', 'AMERICA')""", "samples"))
def assign_case_normal(spark, folder):
    people = b.cells(spark, folder).select("sample", F.col("condition").alias("group")).distinct()
    return tg.assign_case_normal(people)


@register("attach_by_gene", sql(SIDES_SQL + """SELECT DISTINCT p_name AS gene, coalesce(n, 0) AS n FROM part
    LEFT JOIN (SELECT p_name AS g, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1) ON g = p_name""",
    "counts", "cells", "expression", "samples"))
def attach_by_gene(spark, folder):
    genes = b.table(spark, folder, "part").select(F.col("p_name").alias("gene")).distinct()
    side = _lines(spark, folder).groupBy(
        F.col("p_name").alias("gene")).agg(F.count(F.lit(1)).alias("n"))
    return tg.attach_by_gene(genes, side, {"n": 0})


SIGNATURE = tuple(f"blue {n}" for n in ("anvil", "bolt", "gear", "gizmo"))
PATHWAYS = {"one": ["blue bolt", "cold gear"], "two": ["hot plate", "old widget", "cold gear"]}


def gene_links(spark, folder):
    """(protein1, protein2): names of parts on consecutive lines of an order in progress."""
    orders = b.table(spark, folder, "orders").where("o_orderstatus = 'P'").select("o_orderkey")
    lines = _lines(spark, folder).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", F.col("p_name").alias("protein1")).distinct()
    following = lines.select("l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), F.col("protein1").alias("protein2"))
    return lines.join(following, ["l_orderkey", "l_linenumber"]).select("protein1", "protein2")


def _ranked(spark, folder):
    options = tg.ScoringOptions(
        signature=SIGNATURE, disease_up=SIGNATURE, pathways=PATHWAYS, corr_cutoff=0.4, lineage="liver a")
    extra = evidence(spark, folder)
    return tg.rank_targets(
        b.expression(spark, folder), roles(spark, folder),
        b.samples(spark, folder).select("sample", "cell_type"), dependency(spark, folder),
        prognosis(spark, folder), extra, extra, gene_links(spark, folder), options=options)


_S = ("expression_score", "proliferation_score", "hub_score", "depmap_score", "reversal_score",
      "pathway_score", "specificity_score", "prognosis_score", "druggability_score", "knockout_score",
      "target_score", "ppi_degree", "ppi_clustering", "ppi_hub_score")
RANK_SQL = SIDES_SQL.replace("\nmat AS", "\n" + COEX_SQL.strip().replace("mat AS", "mat AS", 1).split(",\npairs")[0].replace("mat AS", "unused AS", 1) + ",\nmat AS", 1) + f""",
pairs AS (SELECT a.gene, b.gene AS other, abs(corr(a.v, b.v)) AS r FROM mat a JOIN mat b
  ON a.sample = b.sample AND a.gene <> b.gene GROUP BY 1, 2),
hub AS (SELECT gene, count(*) FILTER (r >= 0.4) AS hub_degree FROM pairs GROUP BY 1),
sig AS (SELECT sample, avg(v) AS y FROM mat WHERE gene IN {SIGNATURE} GROUP BY 1),
prolif AS (SELECT gene, coalesce(corr(v, y), 0) AS prolif FROM mat JOIN sig USING (sample) GROUP BY 1),
mods AS (SELECT g.gene, u.sample, avg(u.v) AS y FROM (SELECT DISTINCT gene FROM mat) g
  JOIN mat u ON u.gene <> g.gene AND u.gene IN {SIGNATURE} GROUP BY 1, 2),
rev AS (SELECT gene, coalesce(corr(v, y), 0) AS rc FROM mat JOIN mods USING (gene, sample) GROUP BY 1),
pw AS (SELECT gene, avg(r) AS pathway_control FROM (SELECT a.gene, b.gene AS pg, coalesce(abs(corr(a.v, b.v)), 0) AS r
  FROM mat a JOIN mat b ON a.sample = b.sample AND b.gene IN ('blue bolt', 'cold gear', 'hot plate', 'old widget')
  GROUP BY 1, 2) GROUP BY 1),
tm AS (SELECT gene, cell_type, sum(v) / max(n) AS mean FROM mat JOIN samples USING (sample)
  JOIN (SELECT cell_type, count(*) AS n FROM samples GROUP BY 1) USING (cell_type) GROUP BY 1, 2),
spec AS (SELECT gene, greatest(0, least(1, 1 + sum(p * log2(p)) / log2(4))) AS specificity
  FROM (SELECT gene, greatest(1e-12, mean / sum(mean) OVER (PARTITION BY gene)) AS p FROM tm) GROUP BY 1),
named AS (SELECT DISTINCT l_orderkey, l_linenumber, upper(p_name) AS name FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'P'),
edges AS (SELECT DISTINCT least(a.name, b.name) AS src, greatest(a.name, b.name) AS dst FROM named a JOIN named b
  ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber WHERE a.name <> b.name),
{GRAPH_SQL.strip()},
ppi AS (SELECT *, {prank('ppi_degree')} AS ppi_hub_score FROM (SELECT g.gene, CAST(coalesce(ppi_degree, 0) AS DOUBLE) AS ppi_degree,
  coalesce(ppi_clustering, 0) AS ppi_clustering FROM (SELECT DISTINCT gene FROM mat) g LEFT JOIN clus ON clus.gene = upper(g.gene))),
alls AS (SELECT *, case_mean - normal_mean AS log2fc, log2fc * rc AS rs,
  sign(log2fc) * ln(prognosis_hr) AS pe FROM lfc JOIN hub USING (gene) JOIN prolif USING (gene) JOIN rev USING (gene)
  JOIN pw USING (gene) JOIN spec USING (gene) JOIN dep USING (gene) JOIN hrs USING (gene) JOIN drug USING (gene)
  JOIN off_t USING (gene) JOIN ppi USING (gene)),
sc AS (SELECT *, {prank('log2fc')} AS expression_score, {prank('prolif')} AS proliferation_score,
  {prank('hub_degree')} AS hub_score, {prank('-depmap_effect')} AS depmap_score, {prank('rs')} AS reversal_score,
  {prank('pathway_control')} AS pathway_score, {prank('specificity')} AS specificity_score,
  {prank('pe')} AS prognosis_score, {prank('druggable_hits')} AS druggability_score FROM alls),
ko AS (SELECT *, 0.35 * expression_score + 0.25 * proliferation_score + 0.2 * hub_score + 0.2 * depmap_score
  AS knockout_score FROM sc),
ts AS (SELECT *, greatest(0, least(1, (0.35 * knockout_score + 0.2 * reversal_score + 0.15 * pathway_score
  + 0.1 * specificity_score + 0.1 * prognosis_score + 0.1 * druggability_score + 0.1 * ppi_hub_score) - 0.05 * safety_concern))
  AS target_score FROM ko),
ranked AS (SELECT *, row_number() OVER (ORDER BY round(target_score, 9) DESC, gene) AS rank,
  CASE WHEN knockout_score >= 0.75 AND (depmap_score >= 0.6 OR reversal_score >= 0.6) THEN 'core_driver'
  WHEN knockout_score >= 0.75 THEN 'high_priority' WHEN pathway_score >= 0.6 OR (hub_score >= 0.6
  AND specificity_score >= 0.6) THEN 'microenvironment_regulator' WHEN expression_score >= 0.6 THEN 'biomarker'
  ELSE 'low_priority' END AS target_class FROM ts)
"""
RANK_SQL = RANK_SQL.replace(
    RANK_SQL[RANK_SQL.index("unused AS"):RANK_SQL.index("\nmat AS")], "").replace("\n\nmat AS", "\nmat AS")
# The weights of the dimensions at hand sum to 1.1 and are rescaled.
RANK_SQL = RANK_SQL.replace(
    "(0.35 * knockout_score + 0.2 * reversal_score", "1 / 1.1 * (0.35 * knockout_score + 0.2 * reversal_score")
_RANK_BINDINGS = ("counts", "cells", "expression", "samples")


@register("rank_targets", sql(
    RANK_SQL + "SELECT rank, gene, target_class, " + rsql("log2fc", *_S, digits=9)
    + """, off_target_paralogs, safety_concern, CASE WHEN target_score >= 0.75 THEN 'high'
    WHEN target_score >= 0.5 THEN 'medium' ELSE 'low' END AS target_priority FROM ranked""", *_RANK_BINDINGS))
def rank_targets(spark, folder):
    return rounded(
        _ranked(spark, folder).select(
            "rank", "gene", "target_class", "log2fc", *_S, "off_target_paralogs", "safety_concern",
            "target_priority"), digits=9)


@register("weighted_score", """SELECT p_partkey AS gene, """ + rsql(
    "(0.35 * p_size + 0.2 * (p_retailprice / 1000)) / 0.55 AS score") + " FROM part")
def weighted_score(spark, folder):
    parts = b.table(spark, folder, "part").withColumn("p_retailprice", F.col("p_retailprice") / 1000)
    score = tg.weighted_score({"expression": "p_size", "network": "p_retailprice"}, tg.BASE_WEIGHTS)
    return rounded(parts.select(F.col("p_partkey").alias("gene"), score.alias("score")))


@register("target_score", """WITH s AS (SELECT p_partkey AS gene, greatest(0, least(1, p_size / 45.0
    - 0.05 * (p_partkey % 3))) AS score FROM part) SELECT gene, """ + rsql("score") + """,
    CASE WHEN score >= 0.75 THEN 'high' WHEN score >= 0.5 THEN 'medium' ELSE 'low' END AS priority FROM s""")
def target_score(spark, folder):
    score = tg.target_score(F.col("p_size") / 45.0, (F.col("p_partkey") % 3).cast("double"))
    parts = b.table(spark, folder, "part").select(F.col("p_partkey").alias("gene"), score.alias("score"))
    return rounded(parts.withColumn("priority", tg.priority(F.col("score"))))


@register("priority", """SELECT l_orderkey AS id, l_partkey AS gene, CASE WHEN l_quantity / 50 >= 0.75 THEN 'high'
    WHEN l_quantity / 50 >= 0.5 THEN 'medium' ELSE 'low' END AS priority FROM lineitem""")
def priority(spark, folder):
    return b.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("gene"),
        tg.priority(F.col("l_quantity") / 50).alias("priority"))


@register("target_class", """SELECT l_partkey AS gene, l_orderkey AS id, CASE
    WHEN l_quantity / 50 >= 0.75 AND l_discount * 10 >= 0.6 THEN 'core_driver'
    WHEN l_quantity / 50 >= 0.75 THEN 'high_priority' WHEN l_tax * 10 >= 0.6 THEN 'microenvironment_regulator'
    WHEN l_quantity / 50 >= 0.6 THEN 'biomarker' ELSE 'low_priority' END AS target_class FROM lineitem""")
def target_class(spark, folder):
    lines = b.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("gene"), F.col("l_orderkey").alias("id"),
        (F.col("l_quantity") / 50).alias("knockout_score"), (F.col("l_discount") * 10).alias("depmap_score"),
        (F.col("l_tax") * 10).alias("pathway_score"), (F.col("l_quantity") / 50).alias("expression_score"))
    return lines.select("gene", "id", tg.target_class(lines.columns).alias("target_class"))


@register("class_counts", """SELECT p_type AS target_class, count(*) AS n FROM part JOIN lineitem
    ON l_partkey = p_partkey GROUP BY 1""")
def class_counts(spark, folder):
    return qc.class_counts(_lines(spark, folder).withColumnRenamed("p_type", "target_class"), "target_class")


@register("expand_phases", "WITH top AS (SELECT p_partkey + 1 AS rank, p_name AS gene FROM part ORDER BY 1, 2 LIMIT 10)"
    """ SELECT rank, gene, CAST(i AS INTEGER) AS phase_no, ['phase_1_cell_line', 'phase_2_organoid',
    'phase_3_drug_response', 'phase_4_animal', 'phase_5_pdx'][i + 1] AS phase FROM top, range(0, 5) r(i)""")
def expand_phases(spark, folder):
    parts = b.table(spark, folder, "part").select(
        (F.col("p_partkey") + 1).alias("rank"), F.col("p_name").alias("gene"))
    return tg.expand_phases(parts)


@register("gene_blacklist", """SELECT gene FROM (SELECT CASE p_size % 4 WHEN 0 THEN 'RPL' WHEN 1 THEN 'mt-' WHEN 2 THEN 'AC'
    ELSE 'TP' END || CAST(p_partkey AS VARCHAR) AS gene FROM part) WHERE NOT regexp_matches(gene, '^(?:RPL|mt-|AC[0-9])')""")
def gene_blacklist(spark, folder):
    head = F.element_at(F.array(*[F.lit(x) for x in ("RPL", "mt-", "AC", "TP")]), F.col("p_size") % 4 + 1)
    genes = b.table(spark, folder, "part").select(
        F.concat(head, F.col("p_partkey").cast("string")).alias("gene"))
    return tg.gene_blacklist(genes)


KEY_SQL = """
k AS (SELECT p_name || ' ' || p_brand AS gene, avg(l_discount) AS padj, avg(l_tax) * 100 - 4 AS lfc,
  max(l_quantity) >= 40 AS sig FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
r AS (SELECT *, row_number() OVER (ORDER BY round(padj, 6), abs(round(lfc, 6)) DESC, gene) AS deg_rank FROM k WHERE sig),
f AS (SELECT *, row_number() OVER (ORDER BY deg_rank) AS rank FROM r WHERE gene NOT LIKE 'red %')
"""


@register("key_genes", "WITH " + KEY_SQL.strip() + """ SELECT rank, gene, CASE WHEN round(lfc, 6) > 0 THEN 'Up' ELSE 'Down' END AS direction,
    """ + rsql("lfc AS avg_log2fc", "padj AS p_val_adj") + """, CAST(NULL AS DOUBLE) AS pct_1, CAST(NULL AS DOUBLE) AS pct_2,
    deg_rank, CAST(0 AS DOUBLE) AS ml_importance, 'DEG' AS source FROM f WHERE rank <= 50""")
def key_genes(spark, folder):
    deg = _lines(spark, folder).groupBy(F.concat_ws(" ", "p_name", "p_brand").alias("gene")).agg(
        F.avg("l_discount").alias("padj"), (F.avg("l_tax") * 100 - 4).alias("log2FoldChange"),
        F.when(F.max("l_quantity") >= 40, "TRUE").otherwise("no").alias("significant"))
    deg = rounded(deg).withColumn(
        "direction", F.when(F.col("log2FoldChange") > 0, "Up").otherwise("Down"))
    return tg.key_genes(deg, deg, blacklist=["^red "])


FEEDBACK_SQL = """
ko AS (SELECT p_name AS gene, max(p_size / 60.0) AS ts, max(p_retailprice / 2000) AS ks,
  arg_min(p_type, (p_partkey, p_type)) AS cls FROM part WHERE p_name NOT LIKE 'hot %' GROUP BY 1),
dock0 AS (SELECT p_name AS gene, max(l_linenumber) AS hits FROM lineitem JOIN part ON l_partkey = p_partkey
  WHERE p_name NOT LIKE 'cold %' GROUP BY 1),
m AS (SELECT gene, concat_ws('|', CASE WHEN ts IS NOT NULL THEN 'knockout' END, CASE WHEN hits IS NOT NULL THEN 'docking' END)
  AS source, coalesce(cls, '') AS target_class, coalesce(ts, 0.5) AS target_score, coalesce(ks, 0.5) AS knockout_score,
  CASE WHEN hits IS NULL THEN '' ELSE 'ok' END AS docking_status, CAST(coalesce(hits, 0) AS BIGINT) AS docking_hits,
  CASE WHEN hits IS NULL THEN '' ELSE '-8.5' END AS best_affinity,
  CASE WHEN hits IS NULL THEN '' ELSE '1ABC' END AS pdb_id,
  greatest(0, least(1, coalesce(ts, 0.5) + CASE WHEN hits > 0 THEN least(0.2, hits * 0.04) ELSE 0 END)) AS feedback_score
  FROM ko FULL JOIN dock0 USING (gene))
"""


@register("feedback_merge", "WITH " + FEEDBACK_SQL.strip() + " SELECT CAST(row_number() OVER (ORDER BY " + (
    "round(feedback_score, 9) DESC, docking_hits DESC, target_score DESC, knockout_score DESC, gene) AS BIGINT) AS feedback_rank,"
    " gene, source, target_class, ") + rsql("target_score", "knockout_score", "feedback_score")
    + """, docking_status, docking_hits, best_affinity, pdb_id, CAST(0 AS BIGINT) AS key_rank, CAST(0 AS DOUBLE) AS avg_log2fc
    FROM m ORDER BY 1 LIMIT 12""")
def feedback_merge(spark, folder):
    ko = b.table(spark, folder, "part").where("p_name NOT LIKE 'hot %'").select(
        F.col("p_name").alias("gene"), (F.col("p_size") / 60.0).alias("target_score"),
        (F.col("p_retailprice") / 2000).alias("knockout_score"), F.col("p_partkey").alias("rank"),
        F.col("p_type").alias("target_class"))
    dock = _lines(spark, folder).where("p_name NOT LIKE 'cold %'").select(
        F.col("p_name").alias("gene"), F.lit("ok").alias("status"), F.col("l_linenumber").alias("hits"),
        F.lit("-8.5").alias("best_affinity"), F.lit("1ABC").alias("pdb_id"))
    return rounded(tg.feedback_merge(ko, dock))


@register("evidence_upsert", """SELECT DISTINCT p_name AS gene, '' AS entrez, '' AS uniprot, '' AS ensembl,
    '' AS chembl_target_id, CAST(coalesce(n, 0) AS BIGINT) AS known_ligands, 0 AS chembl_bioactivities,
    CAST(coalesce(s, 0) AS BIGINT) AS pdb_structures, '' AS pdb_ids, 0 AS off_target_paralogs, 0 AS safety_concern,
    0 AS string_partners, '' AS string_partner_ids, 0 AS reactome_pathways, '' AS reactome_pathway_ids,
    0 AS pharmgkb_annotations, '' AS pharmgkb_ids, 0 AS alphafold_structures, '' AS alphafold_ids, 0 AS opentargets_hits,
    '' AS opentargets_target_ids, 0 AS kegg_pathways, '' AS kegg_pathway_ids, '' AS database_sources
    FROM part LEFT JOIN (SELECT coalesce(f.g, c.g) AS g, coalesce(f.n, c.n) AS n, coalesce(f.s, c.s) AS s FROM
      (SELECT p_name AS g, count(*) AS n, max(p_size) AS s FROM part WHERE p_name NOT LIKE 'hot %' GROUP BY 1) c
      FULL JOIN (SELECT p_name AS g, count(*) + 1000 AS n, max(p_size) AS s FROM part WHERE p_name LIKE 'red %' GROUP BY 1) f
      ON f.g = c.g) ON g = p_name""")
def evidence_upsert(spark, folder):
    parts = b.table(spark, folder, "part").withColumnRenamed("p_name", "gene")
    cache = parts.where("gene NOT LIKE 'hot %'").groupBy("gene").agg(
        F.count(F.lit(1)).alias("known_ligands"), F.max("p_size").alias("pdb_structures"))
    fresh = parts.where("gene LIKE 'red %'").groupBy("gene").agg(
        (F.count(F.lit(1)) + 1000).alias("known_ligands"), F.max("p_size").alias("pdb_structures"))
    return tg.evidence_upsert(parts, cache, fresh)


@register("target_shortlist", """WITH key AS (SELECT s_suppkey + 1 AS rank, s_name AS gene FROM supplier ORDER BY 1 LIMIT 5)
    SELECT rank, gene, CASE WHEN s % 3 = 0 THEN '' ELSE 'U' || CAST(s AS VARCHAR) END AS uniprot,
    CASE WHEN s % 3 = 1 THEN '1ABC,2XYZ' ELSE '' END AS pdb_ids,
    CASE WHEN s % 3 = 1 THEN 'ok' ELSE 'skipped' END AS status,
    CASE s % 3 WHEN 0 THEN 'no evidence row' WHEN 1 THEN '' ELSE 'no PDB structure' END AS error
    FROM (SELECT *, rank - 1 AS s FROM key)""")
def target_shortlist(spark, folder):
    suppliers = b.table(spark, folder, "supplier")
    s = F.col("s_suppkey")
    key = suppliers.select((s + 1).alias("rank"), F.col("s_name").alias("gene"))
    found = suppliers.where(s % 3 != 0).select(
        F.col("s_name").alias("gene"), F.concat(F.lit("U"), s.cast("string")).alias("uniprot"),
        F.when(s % 3 == 1, "1abc; bad|2xyz").otherwise("none").alias("pdb_ids"))
    return tg.target_shortlist(key, found, 5)


@register("candidate_library", """WITH f AS (SELECT p_brand || p_type AS smiles, min((p_partkey, p_name)) AS k FROM part GROUP BY 1),
    r AS (SELECT CAST(row_number() OVER (ORDER BY k, smiles) AS BIGINT) AS pos, smiles, k FROM f)
    SELECT pos, replace(k[2], ' ', '_') AS id, smiles FROM r WHERE pos <= 50"""
    .replace("min((p_partkey, p_name)) AS k", "min(p_partkey) AS k, arg_min(p_name, p_partkey) AS nm")
    .replace("SELECT CAST(row_number() OVER (ORDER BY k, smiles) AS BIGINT) AS pos, smiles, k FROM f",
             "SELECT CAST(row_number() OVER (ORDER BY k, smiles) AS BIGINT) AS pos, smiles, nm FROM f")
    .replace("replace(k[2], ' ', '_')", "replace(nm, ' ', '_')"))
def candidate_library(spark, folder):
    ligands = b.table(spark, folder, "part").select(
        F.concat(F.lit(" "), "p_brand", "p_type").alias("SMILES"), F.col("p_name").alias("ligand_id"), "p_partkey")
    return tg.candidate_library(ligands, [F.col("p_partkey")])


@register("hit_filter", sql("""SELECT id, """ + rsql("affinity") + """, status, CAST(row_number() OVER
    (ORDER BY affinity, id) AS BIGINT) AS rank FROM screening WHERE status = 'ok' AND affinity <= -7
    ORDER BY affinity, id LIMIT 100""", "screening"))
def hit_filter(spark, folder):
    return rounded(sc.hit_filter(b.screening(spark, folder)))


@register("screen_summary", sql("""SELECT count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status = 'failed') AS failed,
    count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'ok' AND affinity <= -7) AS hits,
    """ + rsql("min(affinity) FILTER (status = 'ok') AS best_affinity",
               "median(affinity) FILTER (status = 'ok') AS median_affinity") + " FROM screening", "screening"))
def screen_summary(spark, folder):
    return rounded(sc.screen_summary(b.screening(spark, folder)))


@register("redock_compare", """SELECT o_orderkey AS id, """ + rsql("o_totalprice AS affinity_initial", "t AS affinity_redock",
    "t - o_totalprice AS delta") + """ FROM orders JOIN (SELECT l_orderkey, sum(l_extendedprice) AS t FROM lineitem GROUP BY 1)
    ON l_orderkey = o_orderkey""")
def redock_compare(spark, folder):
    initial = b.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("affinity"))
    again = b.table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(
        F.sum("l_extendedprice").alias("affinity"), F.lit("ok").alias("status"))
    return rounded(sc.redock_compare(initial, again))


@register("pending_work", """SELECT o_orderkey AS id FROM orders WHERE NOT EXISTS (SELECT * FROM lineitem
    WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def pending_work(spark, folder):
    items = b.table(spark, folder, "orders").select(F.col("o_orderkey").alias("id"))
    done = b.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("id"), F.when(F.col("l_returnflag") == "R", "ok").otherwise("failed").alias("status"))
    return sc.pending_work(items, done)


@register("combined_rank", """WITH r AS (SELECT o_orderkey AS id, o_totalprice AS affinity, o_custkey AS ml_score,
    rank() OVER (ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY o_totalprice) - 1) / 2.0 AS ra,
    count(*) OVER () + 1 - (rank() OVER (ORDER BY o_custkey) + (count(*) OVER (PARTITION BY o_custkey) - 1) / 2.0) AS rm FROM orders)
    SELECT id, affinity, CAST(ml_score AS DOUBLE) AS ml_score, CAST(floor(rm) AS INTEGER) AS ml_rank,
    CAST((floor(ra) + floor(rm)) / 2.0 AS DOUBLE) AS combined_rank FROM r""")
def combined_rank(spark, folder):
    return sc.combined_rank(b.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("affinity"),
        F.col("o_custkey").cast("double").alias("ml_score")))


@register("size_filter", """SELECT p_partkey AS id, p_size + 20 AS heavy_atoms, CAST(p_partkey % 20 AS INTEGER) AS rotatable_bonds,
    CASE WHEN p_size + 20 > 60 THEN CAST(p_size + 20 AS VARCHAR) || ' heavy atoms > 60' WHEN p_partkey % 20 > 15
    THEN CAST(p_partkey % 20 AS VARCHAR) || ' rotatable bonds > 15' ELSE '' END AS error,
    CASE WHEN p_size + 20 > 60 OR p_partkey % 20 > 15 THEN 'filtered' ELSE 'ok' END AS status FROM part""")
def size_filter(spark, folder):
    return sc.size_filter(b.table(spark, folder, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_size") + 20).alias("heavy_atoms"),
        (F.col("p_partkey") % 20).cast("int").alias("rotatable_bonds")))


@register("unique_ids", """WITH r AS (SELECT p_partkey AS pos, replace(p_name, ' ', '_') AS s,
    row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS k FROM part)
    SELECT pos, CASE WHEN k = 1 THEN s ELSE s || '_' || CAST(k AS VARCHAR) END AS unique_id FROM r""")
def unique_ids(spark, folder):
    parts = b.table(spark, folder, "part").select("p_name", F.col("p_partkey").alias("pos"))
    return sc.unique_ids(parts, "p_name", "pos").select("pos", "unique_id")


@register("split_ids", """SELECT c_custkey AS id, [upper(c_mktsegment[1:0] || CAST(c_custkey % 10 AS VARCHAR) || c_mktsegment[1:3])] AS ids
    FROM customer""")
def split_ids(spark, folder):
    one = F.concat((F.col("c_custkey") % 10).cast("string"), F.lower(F.substring("c_mktsegment", 1, 3)))
    text = F.concat_ws("; ", one, F.col("c_mktsegment"), F.lit("toolong1"))
    return b.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), fc.split_ids(text).alias("ids"))


@register("maxmin_diverse")
def maxmin_diverse(spark, folder):
    bits = F.filter(
        F.transform(F.col("embedding"), lambda x, i: F.when(x > 0, i)), lambda i: i.isNotNull())
    hits = b.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), bits.alias("bits"), F.col("label"))
    return rounded(sc.maxmin_diverse(hits, 8, [F.col("label")]))


@register("similarity_join", r"""WITH w AS (SELECT doc_id AS id, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS bits FROM documents),
    c AS (SELECT bits, min(id) AS id, count(*) AS copies FROM w WHERE len(bits) > 0 GROUP BY 1),
    p AS (SELECT a.id AS id_1, b.id AS id_2, a.copies AS copies_1, b.copies AS copies_2,
      len(list_intersect(a.bits, b.bits)) AS s, len(a.bits) + len(b.bits) AS t FROM c a JOIN c b ON a.id < b.id
      AND least(len(a.bits), len(b.bits)) >= 0.7 * greatest(len(a.bits), len(b.bits)))
    SELECT id_1, id_2, copies_1, copies_2, round(s / (t - s), 6) AS similarity FROM p WHERE s / (t - s) >= 0.7""")
def similarity_join(spark, folder):
    sets = b.table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("bits"))
    return rounded(sc.similarity_join(sets, 0.7))


@register("similarity_members", r"""WITH w AS (SELECT doc_id AS id, list_sort(list_distinct(regexp_extract_all(lower(text), '[a-z]+'))) AS bits FROM documents)
    SELECT id, min(id) OVER (PARTITION BY bits) AS class_id, count(*) OVER (PARTITION BY bits) AS copies FROM w WHERE len(bits) > 0""")
def similarity_members(spark, folder):
    sets = b.table(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0)).alias("bits"))
    return sc.similarity_members(sets)
