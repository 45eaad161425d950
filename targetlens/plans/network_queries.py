"""Registered queries: signals, overlap, interaction network, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from targetlens.operators import network as net
from targetlens.operators import signals as sig
from targetlens.plans import bindings as b
from targetlens.plans.bindings import sql
from targetlens.plans.registry import Family, rounded, rsql

family = Family()
register = family.register
QUERIES, ORACLES = family.queries, family.oracles

SIGNALS_SQL = """
pairs AS (SELECT trim(drug) AS drug, trim(event) AS event, sum(count) AS a FROM reports GROUP BY 1, 2),
cells2 AS (SELECT drug, event, a, sum(a) OVER (PARTITION BY drug) - a AS b,
  sum(a) OVER (PARTITION BY event) - a AS c,
  sum(a) OVER () - sum(a) OVER (PARTITION BY drug) - sum(a) OVER (PARTITION BY event) + a AS d,
  sum(a) OVER () AS n FROM pairs),
m AS (SELECT *, a*d/(b*c) AS ror, sqrt(1/a+1/b+1/c+1/d) AS rse, (a/(a+b))/(c/(c+d)) AS prr,
  sqrt(1/a-1/(a+b)+1/c-1/(c+d)) AS pse, n*power(a*d-b*c,2)/((a+b)*(c+d)*(a+c)*(b+d)) AS chi_square,
  (a+b)*(a+c)/n AS e FROM cells2),
k AS (SELECT *, exp(ln(ror)-1.96*rse) AS ror_lower, exp(ln(ror)+1.96*rse) AS ror_upper,
  exp(ln(prr)-1.96*pse) AS prr_lower, exp(ln(prr)+1.96*pse) AS prr_upper,
  log2((a+0.5)/(e+0.5)) AS ic, a/e AS ebgm FROM m),
f AS (SELECT *, ic - 3.3/sqrt(a) AS ic_lower, exp(ln(ebgm+1e-9)-1.96*sqrt(1/a+1/e)) AS ebgm05 FROM k),
signals AS (SELECT *, a>=3 AND ror_lower>1 AS signal_ror, a>=3 AND prr>=2 AND chi_square>=4 AS signal_prr,
  a>=3 AND ic_lower>0 AS signal_bcpnn, a>=3 AND ebgm05>1 AS signal_ebgm FROM f)
"""
_R = "round({0}, 6) + 0.0 AS {0}"


@register("pair_contingency", sql(SIGNALS_SQL + "SELECT drug, event, a, b, c, d, n FROM cells2", "reports"))
def pair_contingency(spark, folder):
    return sig.pair_contingency(b.reports(spark, folder))


@register(
    "disproportionality",
    sql(
        SIGNALS_SQL + "SELECT drug, event, a, b, c, d, "
        + ", ".join(_R.format(x) for x in (
            "ror", "ror_lower", "ror_upper", "prr", "prr_lower", "prr_upper", "chi_square", "ic",
            "ic_lower", "ebgm", "ebgm05"))
        + ", signal_ror, signal_prr, signal_bcpnn, signal_ebgm,"
        " signal_ror AND signal_prr AND (signal_bcpnn OR signal_ebgm) AS signal FROM signals",
        "reports",
    ),
)
def disproportionality(spark, folder):
    return rounded(sig.disproportionality(sig.pair_contingency(b.reports(spark, folder))))


@register(
    "top_signal_drugs",
    sql(
        SIGNALS_SQL + """SELECT drug, sum(a) AS reports FROM signals
        WHERE ebgm05 > 0.9 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""",
        "reports",
    ),
)
def top_signal_drugs(spark, folder):
    # The generated reports hold no full signal, so the flag is loosened to one of its parts.
    signals = sig.disproportionality(sig.pair_contingency(b.reports(spark, folder)))
    return sig.top_signal_drugs(signals.withColumn("signal", F.col("ebgm05") > 0.9))


@register("normalize_keys", """SELECT DISTINCT upper(trim(p_name)) AS gene FROM part
    WHERE trim(p_name) <> ''""")
def normalize_keys(spark, folder):
    return net.normalize_keys(b.table(spark, folder, "part"), "p_name")


OVERLAP_SQL = """
overlap AS (SELECT gene, count(DISTINCT source) AS n_sources,
  string_agg(DISTINCT source, ';' ORDER BY source) AS sources FROM target_sources
  WHERE gene IN (SELECT gene FROM disease_genes) GROUP BY 1)
"""


@register("overlap_sources", sql(
    OVERLAP_SQL + "SELECT gene, n_sources, sources, true AS in_compound, true AS in_disease FROM overlap",
    "target_sources", "disease_genes"))
def overlap_sources(spark, folder):
    return net.overlap_sources(b.target_sources(spark, folder), b.disease_genes(spark, folder))


GRAPH_SQL = """
both_ways AS (SELECT src AS u, dst AS v FROM edges UNION ALL SELECT dst, src FROM edges),
deg AS (SELECT u AS gene, count(*) AS ppi_degree FROM both_ways GROUP BY 1),
tri AS (SELECT a.u AS gene, count(*) / 2 AS t FROM both_ways a JOIN both_ways b ON a.v = b.u
  JOIN both_ways c ON b.v = c.u AND c.v = a.u GROUP BY 1),
clus AS (SELECT gene, ppi_degree, CASE WHEN ppi_degree > 1
  THEN 2.0 * coalesce(t, 0) / (ppi_degree * (ppi_degree - 1.0)) ELSE 0 END AS ppi_clustering
  FROM deg LEFT JOIN tri USING (gene))
"""
#: Nodes, in hash order, from which the betweenness that ``hub_scores`` shows is estimated.
SOURCES = 32
DEPTH = 8


def _flow_sql(sources: int | None = None) -> str:
    """Shortest-path counts level by level from all nodes, or some, and the dependencies back (DEPTH levels at most)."""
    some = "" if sources is None else f" ORDER BY md5(gene), gene LIMIT {sources}"
    parts = [f""",
starts AS (SELECT gene FROM deg{some}),
l0 AS (SELECT gene AS s, gene AS v, CAST(1 AS DOUBLE) AS paths FROM starts)"""]
    for i in range(1, DEPTH + 1):
        seen = " ".join(f"AND NOT EXISTS (SELECT 1 FROM l{k} x WHERE x.s = a.s AND x.v = e.v)" for k in range(max(0, i - 2), i))
        parts.append(f"l{i} AS MATERIALIZED (SELECT a.s, e.v, sum(paths) AS paths FROM l{i - 1} a JOIN both_ways e ON a.v = e.u WHERE true {seen} GROUP BY 1, 2)")
    parts.append(f"d{DEPTH} AS (SELECT s, v, paths, CAST(0 AS DOUBLE) AS delta FROM l{DEPTH})")
    for i in range(DEPTH - 1, 0, -1):
        parts.append(f"""d{i} AS MATERIALIZED (SELECT a.s, a.v, any_value(a.paths) AS paths,
  coalesce(any_value(a.paths) * sum((1 + w.delta) / w.paths), 0) AS delta
  FROM l{i} a LEFT JOIN (SELECT d.s, e.v, d.delta, d.paths FROM d{i + 1} d JOIN both_ways e ON d.v = e.u) w ON w.s = a.s AND w.v = a.v GROUP BY 1, 2)""")
    union = " UNION ALL ".join(f"SELECT v, delta FROM d{i}" for i in range(1, DEPTH + 1))
    parts.append(f"""flow AS (SELECT deg.gene, coalesce(f, 0) * (SELECT count(*) FROM deg)
  / ((SELECT count(*) FROM starts) * ((SELECT count(*) FROM deg) - 1.0) * ((SELECT count(*) FROM deg) - 2.0)) AS ppi_betweenness
  FROM deg LEFT JOIN (SELECT v, sum(delta) AS f FROM ({union}) GROUP BY 1) t ON t.v = deg.gene)
""")
    return ",\n".join(parts)


FLOW_SQL = _flow_sql(SOURCES)
HUB_SQL = GRAPH_SQL + """,
filled AS (SELECT gene, coalesce(ppi_degree, 0) AS ppi_degree, coalesce(ppi_clustering, 0) AS ppi_clustering
  FROM disease_genes LEFT JOIN clus USING (gene)),
hubs AS (SELECT *, (rank() OVER (ORDER BY ppi_degree)
  + (count(*) OVER (PARTITION BY ppi_degree) - 1) / 2.0) / count(*) OVER () AS ppi_hub_score FROM filled)
"""


@register("edge_clean", sql("SELECT src, dst FROM edges", "interactions", "edges"))
def edge_clean(spark, folder):
    return net.edge_clean(b.interactions(spark, folder))


@register("degree", sql(GRAPH_SQL + "SELECT gene, ppi_degree FROM deg", "interactions", "edges"))
def degree(spark, folder):
    return net.degree(net.edge_clean(b.interactions(spark, folder)))


@register("edges_within", sql("""SELECT src, dst FROM edges WHERE src IN (SELECT gene FROM disease_genes)
    AND dst IN (SELECT gene FROM disease_genes)""", "interactions", "edges", "disease_genes"))
def edges_within(spark, folder):
    clean = net.edge_clean(b.interactions(spark, folder))
    return net.edges_within(clean, b.disease_genes(spark, folder))


@register("clustering_coef", sql(
    GRAPH_SQL + "SELECT gene, ppi_degree, round(ppi_clustering, 6) AS ppi_clustering FROM clus",
    "interactions", "edges"))
def clustering_coef(spark, folder):
    return rounded(net.clustering_coef(net.edge_clean(b.interactions(spark, folder))))


@register("hub_scores", sql(
    HUB_SQL.strip() + FLOW_SQL + """SELECT gene, CAST(ppi_degree AS BIGINT) AS ppi_degree,
    round(ppi_clustering, 6) AS ppi_clustering, round(coalesce(ppi_betweenness, 0), 8) AS ppi_betweenness,
    round(ppi_hub_score, 6) AS ppi_hub_score FROM hubs LEFT JOIN flow USING (gene)""",
    "interactions", "edges", "disease_genes"))
def hub_scores(spark, folder):
    hubs = net.hub_scores(b.interactions(spark, folder), b.disease_genes(spark, folder), True, SOURCES)
    return rounded(rounded(hubs, "ppi_betweenness", digits=8), "ppi_clustering", "ppi_hub_score")


@register("overlap_with_hubs", sql(
    OVERLAP_SQL + "," + HUB_SQL + """SELECT gene, n_sources, sources, true AS in_compound,
    true AS in_disease, CAST(ppi_degree AS BIGINT) AS ppi_degree,
    round(ppi_clustering, 6) AS ppi_clustering, round(ppi_hub_score, 6) AS ppi_hub_score
    FROM overlap LEFT JOIN hubs USING (gene)""",
    "target_sources", "interactions", "edges", "disease_genes"))
def overlap_with_hubs(spark, folder):
    disease = b.disease_genes(spark, folder)
    overlap = net.overlap_sources(b.target_sources(spark, folder), disease)
    return rounded(net.overlap_with_hubs(overlap, net.hub_scores(b.interactions(spark, folder), disease)))


@register("venn_regions", """
    WITH m AS (SELECT DISTINCT l_partkey AS gene, l_returnflag || l_linestatus AS set_name FROM lineitem)
    SELECT region, count(*) AS n FROM (SELECT gene, string_agg(set_name, '&' ORDER BY set_name) AS region
      FROM m GROUP BY 1) GROUP BY 1""")
def venn_regions(spark, folder):
    return net.venn_regions(b.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("gene"), F.concat("l_returnflag", "l_linestatus").alias("set_name")))


CTPD = ("target_sources", "interactions", "edges", "disease_genes")


@register("ctpd_nodes", sql(OVERLAP_SQL + """SELECT 'compound' AS node_id, 'Compound' AS label,
    'compound' AS node_type UNION ALL SELECT 'disease', 'Disease', 'disease'
    UNION ALL SELECT gene, gene, 'target' FROM overlap""", "target_sources", "disease_genes"))
def ctpd_nodes(spark, folder):
    overlap = net.overlap_sources(b.target_sources(spark, folder), b.disease_genes(spark, folder))
    return net.ctpd_network(overlap, b.interactions(spark, folder))[0]


@register("ctpd_network", sql(OVERLAP_SQL + """SELECT 'compound' AS source, gene AS target,
    'compound_target' AS edge_type, sources FROM overlap
    UNION ALL SELECT gene, 'disease', 'disease_target', 'disease' FROM overlap
    UNION ALL SELECT src, dst, 'ppi', 'STRING' FROM edges WHERE src IN (SELECT gene FROM overlap)
    AND dst IN (SELECT gene FROM overlap)""", *CTPD))
def ctpd_network(spark, folder):
    overlap = net.overlap_sources(b.target_sources(spark, folder), b.disease_genes(spark, folder))
    return net.ctpd_network(overlap, b.interactions(spark, folder))[1]


@register("betweenness", sql(
    GRAPH_SQL + _flow_sql() + "SELECT gene, " + rsql("ppi_betweenness", digits=8) + " FROM flow", "interactions", "edges"))
def betweenness(spark, folder):
    return rounded(net.betweenness(net.edge_clean(b.interactions(spark, folder))), digits=8)


@register("union_tables", """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance,
    c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""")
def union_tables(spark, folder):
    customers = b.table(spark, folder, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment")
    suppliers = b.table(spark, folder, "supplier").selectExpr(
        "s_suppkey AS key", "s_name AS name", "s_acctbal AS balance")
    return net.union_tables([customers, suppliers])


@register("intersect_keys", """SELECT l_partkey AS key FROM lineitem WHERE l_returnflag = 'R'
    INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'""")
def intersect_keys(spark, folder):
    lines = b.table(spark, folder, "lineitem").withColumnRenamed("l_partkey", "key")
    return net.intersect_keys(
        lines.where("l_returnflag = 'R'"), lines.where("l_returnflag = 'A'"), "key")


@register("except_keys", """SELECT c_custkey AS key FROM customer
    EXCEPT SELECT user_id FROM events""")
def except_keys(spark, folder):
    return net.except_keys(
        b.table(spark, folder, "customer").withColumnRenamed("c_custkey", "key"),
        b.table(spark, folder, "events").withColumnRenamed("user_id", "key"), "key")
