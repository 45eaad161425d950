"""Registered queries: tests, differential expression, enrichment, correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from targetlens.functions import ordering as od
from targetlens.operators import expression as ex
from targetlens.operators import qc
from targetlens.operators import statistics as st
from targetlens.plans import bindings as b
from targetlens.plans.bindings import CASE, NORMAL, erfc_sql, sql
from targetlens.plans.expression_queries import METRICS_SQL, MODULE_SQL
from targetlens.plans.registry import Family, rounded, rsql
from targetlens.session import cut_lineage

family = Family()
register = family.register
QUERIES, ORACLES = family.queries, family.oracles


def bh_sql(source: str, p: str = "p_value", out: str = "p_adjust") -> str:
    """CTE body adding the BH column to every row of ``source``."""
    return f"""SELECT *, least(1, min({p} * m / r) OVER (ORDER BY {p} DESC)) AS {out}
        FROM (SELECT *, row_number() OVER (ORDER BY {p}) AS r, count(*) OVER () AS m FROM {source})"""


def normal_p(z: str) -> str:
    return f"least(1, {erfc_sql(f'abs({z}) / sqrt(2)')})"


@register("pct_rank", """SELECT c_custkey AS cell, c_acctbal AS value, """ + rsql(
    "(rank() OVER (ORDER BY c_acctbal) + (count(*) OVER (PARTITION BY c_acctbal) - 1) / 2.0)"
    " / count(*) OVER () AS score") + " FROM customer")
def pct_rank(spark, folder):
    customers = b.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("cell"), F.col("c_acctbal").alias("value"))
    return rounded(od.pct_rank(customers, "value", "score"))


@register("rank_by", sql("""SELECT id, affinity, row_number() OVER (ORDER BY affinity, id) AS rank
    FROM (SELECT id, """ + rsql("affinity") + " FROM screening WHERE status = 'ok')", "screening"))
def rank_by(spark, folder):
    ok = rounded(b.screening(spark, folder).where("status = 'ok'")).select("id", "affinity")
    return od.row_numbers(ok, [F.col("affinity").asc_nulls_last(), F.col("id")], "rank")


@register("top_k", sql("SELECT id, " + rsql("affinity")
    + " FROM screening ORDER BY affinity, id LIMIT 100", "screening"))
def top_k(spark, folder):
    order = [F.col("affinity"), F.col("id")]
    return rounded(od.top_rows(b.screening(spark, folder).select("id", "affinity"), order, 100))


@register("bh_adjust", "WITH t AS (SELECT s_suppkey AS id, (s_acctbal + 1000) / 11000.0 AS p FROM supplier), a AS ("
    + bh_sql("t", "p") + ") SELECT id, " + rsql("p", "p_adjust") + " FROM a")
def bh_adjust(spark, folder):
    tests = b.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), ((F.col("s_acctbal") + 1000) / 11000.0).alias("p"))
    return rounded(od.bh_adjust(tests, "p"))


CHI_TERMS = " + ".join(
    f"power(abs({x} - {e}) - 0.5, 2) / ({e})" for x, e in (
        ("a", "(a+b)*(a+c)/n"), ("b", "(a+b)*(b+d)/n"), ("c", "(c+d)*(a+c)/n"), ("d", "(c+d)*(b+d)/n"))
)


@register("chi2_2x2", f"""WITH k AS (SELECT p_name AS gene, CAST(count(*) FILTER (l_returnflag = 'R') AS DOUBLE) AS a,
    CAST(count(*) FILTER (l_returnflag <> 'R') AS DOUBLE) AS b FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY 1), t AS (SELECT gene, a, b, sum(a) OVER () - a AS c, sum(b) OVER () - b AS d FROM k),
    f AS (SELECT gene, {CHI_TERMS} AS chi2 FROM (SELECT *, a + b + c + d AS n FROM t))
    SELECT gene, {rsql('chi2', 'least(1, ' + erfc_sql('sqrt(chi2 / 2)') + ') AS p_value')} FROM f""")
def chi2_2x2(spark, folder):
    lines, parts = b.table(spark, folder, "lineitem"), b.table(spark, folder, "part")
    kept = F.col("l_returnflag") == "R"
    table = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy(
        F.col("p_name").alias("gene")
    ).agg(F.count_if(kept).cast("double").alias("a"), F.count_if(~kept).cast("double").alias("b"))
    sums = table.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b"))).scalar()
    a, c = F.col("a"), F.col("b")
    chi, p = st.chi2_2x2(a, c, F.col("_s.a") - a, F.col("_s.b") - c)
    return rounded(table.withColumn("_s", sums).select("gene", chi.alias("chi2"), p.alias("p_value")))


PAIR_SQL = """
top2 AS (SELECT list_sort(list(condition)) AS pair FROM (SELECT condition FROM cells GROUP BY 1
  ORDER BY count(*) DESC, condition LIMIT 2)),
abund AS (SELECT celltype, count(*) FILTER (condition = pair[1]) AS a0, count(*) FILTER (condition = pair[2]) AS b0,
  any_value(pair) AS pair FROM cells, top2 GROUP BY 1),
tab AS (SELECT *, CAST(a0 AS DOUBLE) AS a, CAST(sum(a0) OVER () - a0 AS DOUBLE) AS b, CAST(b0 AS DOUBLE) AS c,
  CAST(sum(b0) OVER () - b0 AS DOUBLE) AS d, CAST(sum(a0 + b0) OVER () AS DOUBLE) AS n FROM abund)
"""


@register("two_group_normalize", sql("""SELECT cell, sample, condition, celltype FROM cells WHERE condition IN
    (SELECT condition FROM cells GROUP BY 1 ORDER BY count(*) DESC, condition LIMIT 2)""", "cells"))
def two_group_normalize(spark, folder):
    return st.two_group_normalize(b.cells(spark, folder))


@register("differential_abundance", sql(PAIR_SQL + f""",
    f AS (SELECT *, {CHI_TERMS} AS chi2 FROM tab WHERE a0 + b0 >= 5),
    g AS (SELECT *, least(1, {erfc_sql('sqrt(chi2 / 2)')}) AS p_value FROM f),
    h AS ({bh_sql('g')})
    SELECT celltype, a0 AS cells_1, b0 AS cells_2, {rsql('a / (a + b) AS fraction_1', 'c / (c + d) AS fraction_2')},
    a0 + b0 AS n_cells, {rsql('chi2', 'p_value', 'p_adjust')},
    'enriched_in_' || CASE WHEN a / (a + b) > c / (c + d) THEN pair[1] ELSE pair[2] END AS direction,
    p_adjust < 0.05 AS significant FROM h""", "cells"))
def differential_abundance(spark, folder):
    return rounded(st.differential_abundance(b.cells(spark, folder)))


@register("fisher_2x2", sql(PAIR_SQL + f""",
    lp AS (SELECT *, list_transform(range(CAST(greatest(0, a + b + a + c - n) AS BIGINT), CAST(least(a + b, a + c) AS BIGINT) + 1),
      lambda x: lgamma(a + b + 1) - lgamma(x + 1) - lgamma(a + b - x + 1) + lgamma(c + d + 1)
      - lgamma(a + c - x + 1) - lgamma(d - a + x + 1) - lgamma(n + 1) + lgamma(a + c + 1) + lgamma(b + d + 1)) AS l
      FROM tab),
    f AS (SELECT *, least(1, list_sum(list_transform(l, lambda v: CASE WHEN v <=
      l[CAST(a - greatest(0, a + b + a + c - n) + 1 AS BIGINT)] + 1e-7 THEN exp(v) ELSE 0 END))) AS p_value FROM lp),
    h AS ({bh_sql('f')})
    SELECT celltype, a0 AS count_1, b0 AS count_2, {rsql('p_value', 'p_adjust', 'a * d / (b * c) AS odds_ratio',
      'log2(a * d / (b * c)) AS log2_odds')} FROM h""", "cells"))
def fisher_2x2(spark, folder):
    return rounded(st.fisher_2x2(b.cells(spark, folder)))


def rank_sum_sql(w: str, n1: str, n2: str, ties: str) -> tuple[str, str]:
    u = f"({w} - {n1} * ({n1} + 1.0) / 2)"
    sd = (f"sqrt(CAST({n1} AS DOUBLE) * {n2} / 12.0 * (({n1} + {n2} + 1.0)"
          f" - {ties} / (CAST({n1} + {n2} AS DOUBLE) * ({n1} + {n2} - 1.0))))")
    shift = f"({u} - CAST({n1} AS DOUBLE) * {n2} / 2.0)"
    return u, normal_p(f"(({shift} - sign({shift}) * 0.5) / {sd})")


_U, _P = rank_sum_sql("w", "n1", "n2", "ties")


@register("rank_sum", f"""WITH m AS (SELECT event_type, value, user_id % 2 = 0 AS one,
      rank() OVER (PARTITION BY event_type ORDER BY value)
      + (count(*) OVER (PARTITION BY event_type, value) - 1) / 2.0 AS rk,
      count(*) OVER (PARTITION BY event_type, value) AS t FROM events),
    s AS (SELECT event_type, count(*) FILTER (one) AS n1, count(*) FILTER (NOT one) AS n2,
      CAST(sum(rk) FILTER (one) AS DOUBLE) AS w, CAST(sum(t * t - 1) AS DOUBLE) AS ties FROM m GROUP BY 1)
    SELECT event_type, n1, n2, {rsql(_U + ' AS statistic', _P + ' AS p_value')} FROM s""")
def rank_sum(spark, folder):
    events = b.table(spark, folder, "events")
    return rounded(st.rank_sum(events, "value", F.col("user_id") % 2 == 0, ["event_type"]))


@register("qc_pvalue_table", sql(METRICS_SQL + f""",
    long AS (SELECT condition, metric, x FROM (SELECT condition, CAST(n_count AS DOUBLE) AS n_count,
      CAST(n_feature AS DOUBLE) AS n_feature, percent_mito, percent_ribo FROM metrics JOIN cells USING (cell))
      UNPIVOT (x FOR metric IN (n_count, n_feature, percent_mito, percent_ribo))),
    pairs AS (SELECT a.condition AS group1, b.condition AS group2 FROM (SELECT DISTINCT condition FROM cells) a
      JOIN (SELECT DISTINCT condition FROM cells) b ON a.condition < b.condition),
    m AS (SELECT metric, group1, group2, x, condition = group1 AS one,
      rank() OVER (PARTITION BY metric, group1, group2 ORDER BY x)
      + (count(*) OVER (PARTITION BY metric, group1, group2, x) - 1) / 2.0 AS rk,
      count(*) OVER (PARTITION BY metric, group1, group2, x) AS t
      FROM long JOIN pairs ON condition IN (group1, group2)),
    s AS (SELECT metric, group1, group2, count(*) FILTER (one) AS n1, count(*) FILTER (NOT one) AS n2,
      median(x) FILTER (one) AS median1, median(x) FILTER (NOT one) AS median2,
      CAST(sum(rk) FILTER (one) AS DOUBLE) AS w, CAST(sum(t * t - 1) AS DOUBLE) AS ties FROM m GROUP BY 1, 2, 3),
    p AS (SELECT *, {_U} AS statistic, {_P} AS p_value FROM s),
    h AS ({bh_sql('p', out='padj')})
    SELECT 'raw' AS stage, metric, group1, group2, n1, n2, {rsql('median1', 'median2',
      'median2 - median1 AS median_diff', 'statistic', 'p_value', 'padj', '-log10(p_value) AS neg_log10_p')},
    CASE WHEN median1 = median2 THEN 'no difference' WHEN median2 > median1 THEN group2 || ' higher'
      ELSE group1 || ' higher' END AS direction FROM h""", "counts", "cells"))
def qc_pvalue_table(spark, folder):
    metrics = qc.cell_qc_metrics(b.counts(spark, folder), b.MITO, b.RIBO).join(
        b.cells(spark, folder).select("cell", "condition"), "cell")
    names = ["n_count", "n_feature", "percent_mito", "percent_ribo"]
    return rounded(st.qc_pvalue_table(metrics, names))


def _set_scores(spark, folder):
    people = b.cells(spark, folder)
    scores = ex.module_score(b.normalised(spark, folder), b.word_sets(spark, folder), people, controls=5, bins=6)
    return rounded(scores, "score", digits=9).join(people, "cell")


SETS_SQL = MODULE_SQL + """,
scored AS (SELECT set_name, cell, condition, celltype, round(score, 9) + 0.0 AS score FROM module JOIN cells USING (cell))
"""


@register("one_vs_rest_rank_sum", sql(SETS_SQL + f""",
    m AS (SELECT *, rank() OVER (PARTITION BY set_name ORDER BY score) + (count(*) OVER (PARTITION BY set_name, score) - 1) / 2.0 AS rk,
      count(*) OVER (PARTITION BY set_name, score) AS t FROM scored),
    a AS (SELECT set_name, count(*) AS n, CAST(sum(t * t - 1) AS DOUBLE) AS ties, sum(score) AS total FROM m GROUP BY 1),
    s AS (SELECT set_name, celltype, count(*) AS n1, any_value(a.n) - count(*) AS n2, CAST(sum(rk) AS DOUBLE) AS w, any_value(a.ties) AS ties,
      avg(score) AS module_mean, (any_value(a.total) - sum(score)) / (any_value(a.n) - count(*)) AS other_module_mean
      FROM m JOIN a USING (set_name) GROUP BY 1, 2),
    p AS (SELECT *, {_U} AS statistic, {_P} AS p_value FROM s),
    h AS (SELECT *, least(1, min(p_value * k / r) OVER (PARTITION BY set_name ORDER BY p_value DESC)) AS p_adjust
      FROM (SELECT *, row_number() OVER (PARTITION BY set_name ORDER BY p_value) AS r, count(*) OVER (PARTITION BY set_name) AS k FROM p))
    SELECT set_name, celltype, n1 AS n_cells, {rsql('module_mean', 'other_module_mean',
      'module_mean - other_module_mean AS module_diff', 'statistic', 'p_value', 'p_adjust')} FROM h""",
    "counts", "norm", "cells", "word_sets"))
def one_vs_rest_rank_sum(spark, folder):
    return rounded(st.one_vs_rest_rank_sum(_set_scores(spark, folder), "celltype", "score", ["set_name"]))


@register("celltype_summary", sql(SETS_SQL + "SELECT set_name, celltype, count(*) AS n_cells, "
    + rsql("avg(score) AS module_mean", "median(score) AS module_median") + " FROM scored GROUP BY 1, 2",
    "counts", "norm", "cells", "word_sets"))
def celltype_summary(spark, folder):
    return rounded(st.group_score_summary(_set_scores(spark, folder), ["set_name", "celltype"], "score"))


@register("condition_summary", sql(SETS_SQL + "SELECT set_name, condition, celltype, count(*) AS n_cells, "
    + rsql("avg(score) AS module_mean", "median(score) AS module_median") + " FROM scored GROUP BY 1, 2, 3",
    "counts", "norm", "cells", "word_sets"))
def condition_summary(spark, folder):
    return rounded(st.group_score_summary(_set_scores(spark, folder), ["set_name", "condition", "celltype"], "score"))


# The test on a dense gene x cell grid; the operator never writes the zeros.
DE_SQL = f"""
grid AS (SELECT g.gene, c.cell, c.condition = 'EUROPE' AS one, coalesce(norm.value, 0) AS value
  FROM (SELECT DISTINCT gene FROM norm) g CROSS JOIN (SELECT * FROM cells WHERE condition IN ('EUROPE', 'ASIA')) c
  LEFT JOIN norm ON norm.gene = g.gene AND norm.cell = c.cell),
rk AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY value)
  + (count(*) OVER (PARTITION BY gene, value) - 1) / 2.0 AS rk, count(*) OVER (PARTITION BY gene, value) AS t FROM grid),
s AS (SELECT gene, count(*) FILTER (one) AS n1, count(*) FILTER (NOT one) AS n2,
  CAST(sum(rk) FILTER (one) AS DOUBLE) AS w, CAST(sum(t * t - 1) AS DOUBLE) AS ties,
  log2(avg(exp(value) - 1) FILTER (one) + 1) - log2(avg(exp(value) - 1) FILTER (NOT one) + 1) AS avg_log2fc,
  avg(CASE WHEN value > 0 THEN 1.0 ELSE 0.0 END) FILTER (one) AS pct_1,
  avg(CASE WHEN value > 0 THEN 1.0 ELSE 0.0 END) FILTER (NOT one) AS pct_2 FROM rk GROUP BY 1),
tested AS (SELECT gene, {_U} AS statistic, {_P} AS p_val, avg_log2fc, pct_1, pct_2,
  least(1, {_P} * count(*) OVER ()) AS p_val_adj FROM s),
passing AS (SELECT * FROM tested WHERE greatest(pct_1, pct_2) >= 0.1 AND abs(avg_log2fc) >= 0.25),
deg AS (SELECT * FROM passing UNION ALL SELECT * FROM tested WHERE NOT EXISTS (SELECT * FROM passing))
"""
DE_COLUMNS = rsql("statistic", "p_val", "avg_log2fc", "pct_1", "pct_2", "p_val_adj")


def _deg(spark, folder, **limits):
    return st.de_wilcoxon(
        b.normalised(spark, folder), b.cells(spark, folder), (CASE, NORMAL), **limits)


@register("de_wilcoxon", sql(DE_SQL + f"SELECT gene, {DE_COLUMNS} FROM deg", "counts", "norm", "cells"))
def de_wilcoxon(spark, folder):
    return rounded(_deg(spark, folder))


FLAGS_SQL = DE_SQL.replace("abs(avg_log2fc) >= 0.25", "true") + """,
flags AS (SELECT *, p_val < 0.2 AS significant FROM deg)
"""


@register("de_flags", sql(DE_SQL.replace("abs(avg_log2fc) >= 0.25", "true") + f"""
    SELECT gene, {DE_COLUMNS}, p_val_adj < 0.99 AND abs(avg_log2fc) > 0.1 AS significant,
    CASE WHEN p_val_adj < 0.99 AND abs(avg_log2fc) > 0.1 THEN CASE WHEN avg_log2fc > 0 THEN 'Up' ELSE 'Down' END
      ELSE 'NS' END AS direction, {rsql('-log10(greatest(p_val_adj, 1e-300)) AS neg_log10_padj')} FROM deg""",
    "counts", "norm", "cells"))
def de_flags(spark, folder):
    return rounded(st.de_flags(_deg(spark, folder, min_lfc=0.0), alpha=0.99, min_lfc=0.1))


@register("top_deg_table", sql(FLAGS_SQL + f""",
    mm AS (SELECT gene, sum(value) / (SELECT count(*) FROM cells) AS mean_expr FROM norm GROUP BY 1)
    SELECT gene, {DE_COLUMNS}, {rsql('mean_expr')}, significant,
    CASE WHEN p_val_adj < 0.001 THEN printf('%.1e', greatest(p_val_adj, 1e-300)) ELSE printf('%.3f', p_val_adj) END
    AS p_label FROM flags LEFT JOIN mm USING (gene) WHERE significant
    ORDER BY p_val_adj, abs(avg_log2fc) DESC, gene LIMIT 12""", "counts", "norm", "cells"))
def top_deg_table(spark, folder):
    norm, people = b.normalised(spark, folder), b.cells(spark, folder)
    deg = _deg(spark, folder, min_lfc=0.0).withColumn("significant", F.col("p_val") < 0.2)
    means = ex.gene_moments(norm, people.agg(F.count(F.lit(1))).scalar())
    return rounded(st.top_deg_table(deg, means))


@register("cluster_markers", sql(f"""
    grid AS (SELECT g.gene, c.cell, c.celltype, coalesce(norm.value, 0) AS value
      FROM (SELECT DISTINCT gene FROM norm) g CROSS JOIN cells c
      LEFT JOIN norm ON norm.gene = g.gene AND norm.cell = c.cell),
    rk AS (SELECT *, rank() OVER (PARTITION BY gene ORDER BY value)
      + (count(*) OVER (PARTITION BY gene, value) - 1) / 2.0 AS rk,
      count(*) OVER (PARTITION BY gene, value) AS t FROM grid),
    g AS (SELECT gene, count(*) AS n, CAST(sum(t * t - 1) AS DOUBLE) AS ties, sum(exp(value) - 1) AS e,
      count(*) FILTER (value > 0) AS pos FROM rk GROUP BY 1),
    s AS (SELECT celltype, gene, count(*) AS n1, max(n) - count(*) AS n2, CAST(sum(rk) AS DOUBLE) AS w,
      max(ties) AS ties, log2(avg(exp(value) - 1) + 1)
      - log2((max(e) - sum(exp(value) - 1)) / (max(n) - count(*)) + 1) AS avg_log2fc,
      1.0 * count(*) FILTER (value > 0) / count(*) AS pct_1,
      1.0 * (max(pos) - count(*) FILTER (value > 0)) / (max(n) - count(*)) AS pct_2
      FROM rk JOIN g USING (gene) GROUP BY 1, 2)
    SELECT celltype, gene, {rsql(_U + ' AS statistic', _P + ' AS p_val', 'avg_log2fc', 'pct_1', 'pct_2')},
    {rsql('least(1, ' + _P + ' * (SELECT count(DISTINCT gene) FROM norm)) AS p_val_adj')}
    FROM s WHERE greatest(pct_1, pct_2) >= 0.25 AND avg_log2fc >= 0.05""", "counts", "norm", "cells"))
def cluster_markers(spark, folder):
    return rounded(st.cluster_markers(
        b.normalised(spark, folder), b.cells(spark, folder), "celltype", min_lfc=0.05))


@register("size_factors", sql("""
    bulk AS (SELECT gene, sample, sum(value) AS value FROM counts JOIN cells USING (cell) GROUP BY 1, 2),
    g AS (SELECT gene, avg(ln(value)) AS g FROM bulk WHERE value > 0 GROUP BY 1
      HAVING count(*) = (SELECT count(DISTINCT sample) FROM bulk))
    SELECT sample, """ + rsql("exp(median(ln(value) - g)) AS size_factor")
    + " FROM bulk JOIN g USING (gene) GROUP BY 1", "counts", "cells"))
def size_factors(spark, folder):
    bulk = ex.pseudobulk_sum(b.counts(spark, folder), b.cells(spark, folder))
    return rounded(st.size_factors(bulk))


@register("de_pseudobulk", sql(f"""
    bulk AS (SELECT gene, sample, condition = 'EUROPE' AS one, sum(value) AS value FROM counts JOIN cells
      USING (cell) WHERE condition IN ('EUROPE', 'ASIA') GROUP BY 1, 2, 3),
    g AS (SELECT gene, avg(ln(value)) AS g FROM bulk WHERE value > 0 GROUP BY 1
      HAVING count(*) = (SELECT count(DISTINCT sample) FROM bulk)),
    sf AS (SELECT sample, exp(median(ln(value) - g)) AS f FROM bulk JOIN g USING (gene) GROUP BY 1),
    q AS (SELECT gene, one, value / f AS q FROM bulk JOIN sf USING (sample)),
    n AS (SELECT count(DISTINCT sample) FILTER (one) AS n1, count(DISTINCT sample) FILTER (NOT one) AS n2 FROM bulk),
    s AS (SELECT gene, coalesce(sum(q) FILTER (one), 0) AS sa, coalesce(sum(q) FILTER (NOT one), 0) AS sb,
      coalesce(sum(q * q) FILTER (one), 0) AS qa, coalesce(sum(q * q) FILTER (NOT one), 0) AS qb FROM q GROUP BY 1),
    m AS (SELECT gene, n1, n2, sa / n1 AS m1, sb / n2 AS m2, (sa + sb) / (n1 + n2) AS base_mean,
      (qa - sa * sa / n1 + qb - sb * sb / n2) / (n1 + n2 - 2) AS v FROM s, n),
    t AS (SELECT *, greatest(0, (v - base_mean) / (base_mean * base_mean)) AS dispersion FROM m),
    p AS (SELECT *, ln(m1 / m2) / ln(2) AS avg_log2fc, {normal_p(
        '(ln(m1 / m2) / sqrt((1 / m1 + dispersion) / n1 + (1 / m2 + dispersion) / n2))')} AS p_val FROM t),
    h AS ({bh_sql('p', 'p_val', 'p_val_adj')})
    SELECT gene, {rsql('base_mean', 'dispersion', 'avg_log2fc', 'p_val', 'p_val_adj')} FROM h""",
    "counts", "cells"))
def de_pseudobulk(spark, folder):
    people = b.cells(spark, folder)
    bulk = ex.pseudobulk_sum(b.counts(spark, folder), people).select("gene", "sample", "value")
    conditions = people.select("sample", "condition").distinct()
    return rounded(st.de_pseudobulk(bulk, conditions, (CASE, NORMAL)))


ORA_SQL = """
pick AS (SELECT DISTINCT gene FROM deg WHERE avg_log2fc > 0),
k AS (SELECT set_name, count(*) AS set_size, count(*) FILTER (gene IN (SELECT gene FROM pick)) AS overlap,
  (SELECT count(*) FROM pick) AS n_selected, (SELECT count(*) FROM word_sets) AS n_universe
  FROM word_sets GROUP BY 1),
t AS (SELECT *, least(1, list_sum(list_transform(range(overlap, least(set_size, n_selected) + 1), lambda x: exp(
  lgamma(set_size + 1) - lgamma(x + 1) - lgamma(set_size - x + 1) + lgamma(n_universe - set_size + 1)
  - lgamma(n_selected - x + 1) - lgamma(n_universe - set_size - n_selected + x + 1)
  - lgamma(n_universe + 1) + lgamma(n_selected + 1) + lgamma(n_universe - n_selected + 1))))) AS p_value
  FROM k WHERE overlap > 0)
"""


def _ora(spark, folder):
    deg = _deg(spark, folder, min_lfc=0.0)
    sets = b.word_sets(spark, folder)
    return st.ora(deg.where("avg_log2fc > 0"), deg, sets, p_cutoff=2.0)


@register("ora", sql(DE_SQL.replace("abs(avg_log2fc) >= 0.25", "true") + "," + ORA_SQL
    + f", h AS ({bh_sql('t')}) SELECT set_name, set_size, overlap, n_selected, n_universe, "
    + rsql("p_value", "p_adjust") + " FROM h", "counts", "norm", "cells", "word_sets"))
def ora(spark, folder):
    return rounded(_ora(spark, folder))


@register("top_enrichment", sql(DE_SQL.replace("abs(avg_log2fc) >= 0.25", "true") + "," + ORA_SQL
    + f", h AS ({bh_sql('t')}) SELECT set_name, overlap, " + rsql("p_adjust")
    + " FROM h WHERE p_adjust <= 0.999 ORDER BY round(p_adjust, 6), set_name LIMIT 5",
    "counts", "norm", "cells", "word_sets"))
def top_enrichment(spark, folder):
    terms = rounded(_ora(spark, folder)).select("set_name", "overlap", "p_adjust")
    return st.top_enrichment(terms, cutoff=0.999)


@register("deg_selection", sql(FLAGS_SQL + """,
    strict AS (SELECT gene FROM flags WHERE significant AND avg_log2fc > 0)
    SELECT gene FROM flags WHERE CASE WHEN (SELECT count(*) FROM strict) < 10
    THEN p_val_adj < 0.1 AND avg_log2fc > 0.1 ELSE significant AND avg_log2fc > 0 END""",
    "counts", "norm", "cells"))
def deg_selection(spark, folder):
    deg = _deg(spark, folder, min_lfc=0.0).withColumn("significant", F.col("p_val") < 0.2)
    return st.deg_selection(deg, up=True).select("gene")


@register("gsea")
def gsea(spark, folder):
    deg = _deg(spark, folder, min_lfc=0.0, min_pct=0.0)
    return rounded(st.gsea(deg, b.word_sets(spark, folder), smallest=5))


LOG_SQL = """
mat AS (SELECT gene, sample, log2(value + 1) AS v FROM expression)
"""


def _matrix(spark, folder):
    return cut_lineage(ex.log2_transform(b.expression(spark, folder)))


@register("signature_corr", sql(LOG_SQL + """,
    sig AS (SELECT sample, avg(v) AS y FROM mat WHERE gene LIKE 'blue %' GROUP BY 1)
    SELECT gene, """ + rsql("corr(v, y) AS proliferation_correlation") + " FROM mat JOIN sig USING (sample) GROUP BY 1",
    "counts", "cells", "expression"))
def signature_corr(spark, folder):
    nouns = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod", "widget")
    return rounded(st.signature_corr(_matrix(spark, folder), [f"blue {n}" for n in nouns]))


@register("reversal_corr", sql(LOG_SQL + """,
    lfc AS (SELECT gene, avg(v) FILTER (condition = 'EUROPE') - avg(v) FILTER (condition = 'ASIA') AS log2fc
      FROM mat JOIN samples USING (sample) GROUP BY 1),
    up AS (SELECT * FROM mat WHERE gene IN ('blue anvil', 'hot gear', 'red rod')),
    dn AS (SELECT sample, avg(v) AS d FROM mat WHERE gene IN ('cold bolt', 'new ring') GROUP BY 1),
    mods AS (SELECT g.gene, up.sample, avg(up.v) - max(d) AS y FROM (SELECT DISTINCT gene FROM mat) g
      JOIN up ON up.gene <> g.gene JOIN dn ON dn.sample = up.sample GROUP BY 1, 2),
    r AS (SELECT gene, coalesce(corr(v, y), 0) AS r FROM mat JOIN mods USING (gene, sample) GROUP BY 1)
    SELECT gene, """ + rsql("r AS reversal_correlation", "log2fc * r AS reversal_signal")
    + " FROM r JOIN lfc USING (gene)", "counts", "cells", "expression", "samples"))
def reversal_corr(spark, folder):
    role = F.when(F.col("condition") == CASE, "case").when(F.col("condition") == NORMAL, "normal")
    roles = b.samples(spark, folder).select("sample", role.alias("role")).where("role IS NOT NULL")
    lfc = ex.group_means_lfc(b.expression(spark, folder), roles)
    return rounded(st.reversal_corr(
        _matrix(spark, folder), lfc, ["blue anvil", "hot gear", "red rod"], ["cold bolt", "new ring"]))


PATHWAY = ["blue bolt", "cold gear", "hot plate", "old widget"]


@register("pathway_corr", sql(LOG_SQL + """,
    r AS (SELECT a.gene, b.gene AS pg, coalesce(abs(corr(a.v, b.v)), 0) AS r FROM mat a JOIN mat b
      ON a.sample = b.sample AND b.gene IN ('blue bolt', 'cold gear', 'hot plate', 'old widget') GROUP BY 1, 2)
    SELECT gene, """ + rsql("avg(r) AS pathway_control") + " FROM r GROUP BY 1", "counts", "cells", "expression"))
def pathway_corr(spark, folder):
    return rounded(st.pathway_corr(_matrix(spark, folder), PATHWAY))


COEX_SQL = LOG_SQL + """,
pairs AS (SELECT a.gene, b.gene AS other, abs(corr(a.v, b.v)) AS r FROM mat a JOIN mat b
  ON a.sample = b.sample AND a.gene <> b.gene GROUP BY 1, 2)
"""


@register("coexpression_degree", sql(COEX_SQL + """SELECT gene,
    CAST(count(*) FILTER (r >= 0.4) AS DOUBLE) AS hub_degree FROM pairs GROUP BY 1""",
    "counts", "cells", "expression"))
def coexpression_degree(spark, folder):
    return st.coexpression_degree(_matrix(spark, folder), cutoff=0.4)


COX_SQL = """
surv AS (SELECT o_custkey AS sample, CAST(date_diff('day', min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE))) AS DOUBLE) AS months,
  max(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS status FROM orders GROUP BY 1),
j AS (SELECT gene, months, status, value FROM counts JOIN surv ON cell = sample WHERE months > 0),
arm AS (SELECT j.gene, months, status, value > med AS high FROM j JOIN (SELECT gene, median(value) AS med FROM j GROUP BY 1) m ON m.gene = j.gene),
t AS (SELECT gene, months, count(*) FILTER (high) AS r1, count(*) FILTER (NOT high) AS r0,
  count(*) FILTER (status > 0 AND high) AS d1, count(*) FILTER (status > 0) AS d FROM arm GROUP BY 1, 2),
risk AS (SELECT gene, d1, d, CAST(sum(r1) OVER w AS DOUBLE) AS n1, CAST(sum(r0) OVER w AS DOUBLE) AS n0 FROM t
  WINDOW w AS (PARTITION BY gene ORDER BY months DESC)),
terms AS (SELECT * FROM risk WHERE d > 0),
newton AS (SELECT gene, 0 AS i, CAST(0 AS DOUBLE) AS beta FROM terms GROUP BY gene
  UNION ALL
  SELECT gene, any_value(i) + 1, greatest(-3.0, least(3.0, any_value(beta) + greatest(-1.0, least(1.0,
    coalesce(sum(d1 - d * share) / nullif(sum(d * share * (1 - share)), 0), 0)))))
  FROM (SELECT n.gene, i, beta, d1, d, n1 * exp(beta) / (n1 * exp(beta) + n0) AS share FROM newton n JOIN terms ON terms.gene = n.gene WHERE i < 25)
  GROUP BY gene),
sizes AS (SELECT gene, count(*) AS n, count(*) FILTER (status > 0) AS events FROM arm GROUP BY 1)
"""


@register("cox_median_split", sql(COX_SQL + "SELECT sizes.gene, " + rsql("CASE WHEN n >= 20 AND events >= 5 THEN exp(coalesce(beta, 0)) ELSE 1.0 END AS hr", digits=5)
    + " FROM sizes LEFT JOIN newton ON newton.gene = sizes.gene AND i = 25", "counts").replace("WITH ", "WITH RECURSIVE ", 1))
def cox_median_split(spark, folder):
    orders = b.table(spark, folder, "orders")
    survival = orders.groupBy(F.col("o_custkey").alias("sample")).agg(
        F.date_diff(F.max("o_orderdate"), F.min("o_orderdate")).cast("double").alias("months"),
        F.max((F.col("o_orderstatus") == "F").cast("int")).alias("status"))
    return rounded(st.cox_median_split(b.counts(spark, folder).withColumnRenamed("cell", "sample"), survival), digits=5)
