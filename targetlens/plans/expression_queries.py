"""Registered queries: quality control and expression operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from targetlens.operators import expression as ex
from targetlens.operators import qc
from targetlens.plans import bindings as b
from targetlens.plans.bindings import sql
from targetlens.plans.registry import Family, rounded, rsql

family = Family()
register = family.register
QUERIES, ORACLES = family.queries, family.oracles

METRICS_SQL = """
metrics AS (SELECT cell, sum(value) AS n_count, count(*) FILTER (value > 0) AS n_feature,
  100.0 * sum(CASE WHEN gene LIKE 'small %' THEN value ELSE 0 END) / sum(value) AS percent_mito,
  100.0 * sum(CASE WHEN gene LIKE 'large %' THEN value ELSE 0 END) / sum(value) AS percent_ribo
  FROM counts GROUP BY 1)
"""
BOUNDS_SQL = """,
q AS (SELECT greatest(1.0, quantile_cont(n_feature, 0.01)) AS lo_feature,
  least(20000.0, quantile_cont(n_feature, 0.99)) AS hi_feature,
  greatest(1.0, quantile_cont(n_count, 0.01)) AS lo_count,
  least(500000.0, quantile_cont(n_count, 0.99)) AS hi_count,
  least(30.0, quantile_cont(percent_mito, 0.99)) AS hi_mito FROM metrics)
"""
CELL_COUNT = "(SELECT count(*) FROM cells)"
TYPE_MEANS_SQL = """
sizes AS (SELECT celltype, count(*) AS n FROM cells GROUP BY 1),
means AS (SELECT gene, celltype, sum(value) / max(n) AS mean, 1.0 * count(*) FILTER (value > 0) / max(n)
  AS share FROM norm JOIN cells USING (cell) JOIN sizes USING (celltype) GROUP BY 1, 2)
"""
SPEC_SQL = TYPE_MEANS_SQL + """,
spec AS (SELECT gene, greatest(0, least(1, 1 + sum(p * log2(p)) / log2(5))) AS specificity
  FROM (SELECT gene, greatest(1e-12, mean / sum(mean) OVER (PARTITION BY gene)) AS p FROM means)
  GROUP BY 1)
"""
MOMENTS_SQL = f"""
moments AS (SELECT gene, sum(value) / {CELL_COUNT} AS mean,
  (sum(value * value) - sum(value) * sum(value) / {CELL_COUNT}) / ({CELL_COUNT} - 1.0) AS variance
  FROM norm GROUP BY 1)
"""


def _metrics(spark, folder):
    return qc.cell_qc_metrics(b.counts(spark, folder), b.MITO, b.RIBO)


def _cell_count(spark, folder):
    return b.cells(spark, folder).agg(F.count(F.lit(1))).scalar()


@register("wide_to_long", """SELECT c_name AS gene, sample, CAST(value AS DOUBLE) AS value FROM
    (SELECT c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal, CAST(c_nationkey AS DOUBLE) AS c_nationkey,
      CAST(0 AS DOUBLE) AS c_mktsegment FROM customer)
    UNPIVOT (value FOR sample IN (c_acctbal, c_nationkey, c_mktsegment))""")
def wide_to_long(spark, folder):
    wide = b.table(spark, folder, "customer").select(
        "c_name", "c_acctbal", "c_nationkey", "c_mktsegment")
    return ex.wide_to_long(wide)


@register("long_to_matrix", f"""SELECT p_name AS gene, l_shipmode AS sample, {rsql('avg(l_quantity) AS value')}
    FROM (SELECT *, l_returnflag || l_linestatus AS l_shipmode FROM lineitem)
    JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""")
def long_to_matrix(spark, folder):
    lines, parts = b.table(spark, folder, "lineitem"), b.table(spark, folder, "part")
    long = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_name").alias("gene"), F.concat("l_returnflag", "l_linestatus").alias("sample"),
        F.col("l_quantity").alias("value"))
    return rounded(ex.long_to_matrix(long))


@register("long_metadata", """SELECT DISTINCT c_mktsegment AS sample, c_nationkey AS condition
    FROM customer JOIN orders ON c_custkey = o_custkey""")
def long_metadata(spark, folder):
    customers, orders = b.table(spark, folder, "customer"), b.table(spark, folder, "orders")
    return ex.long_metadata(
        orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
            F.col("c_mktsegment").alias("sample"), F.col("c_nationkey").alias("condition")))


@register("cell_qc_metrics", sql(
    METRICS_SQL + "SELECT cell, n_count, n_feature, " + rsql("percent_mito", "percent_ribo")
    + " FROM metrics", "counts"))
def cell_qc_metrics(spark, folder):
    return rounded(_metrics(spark, folder))


@register("quantile_qc_filter", sql(
    METRICS_SQL + BOUNDS_SQL + "SELECT cell, n_count, n_feature, " + rsql("percent_mito", "percent_ribo")
    + """ FROM metrics, q WHERE n_feature BETWEEN lo_feature AND hi_feature
    AND n_count BETWEEN lo_count AND hi_count AND percent_mito <= hi_mito""", "counts"))
def quantile_qc_filter(spark, folder):
    metrics = _metrics(spark, folder)
    bounds = qc.qc_bounds(metrics, feature_floor=1.0, count_floor=1.0)
    return rounded(qc.quantile_qc_filter(metrics, bounds))


@register("retention", sql(
    METRICS_SQL + BOUNDS_SQL + """SELECT (SELECT count(*) FROM metrics) AS n_before, count(*) AS n_after,
    """ + rsql("100.0 * count(*) / (SELECT count(*) FROM metrics) AS percent_kept") + """
    FROM metrics, q WHERE n_feature BETWEEN lo_feature AND hi_feature
    AND n_count BETWEEN lo_count AND hi_count AND percent_mito <= hi_mito""", "counts"))
def retention(spark, folder):
    metrics = _metrics(spark, folder)
    bounds = qc.qc_bounds(metrics, feature_floor=1.0, count_floor=1.0)
    return rounded(qc.retention(metrics, qc.quantile_qc_filter(metrics, bounds)))


@register("doublet_rate", "SELECT event_type AS sample, count(*) AS n_cells,"
    " count(*) FILTER (value > 100) AS n_doublets, "
    + rsql("1.0 * count(*) FILTER (value > 100) / count(*) AS doublet_rate")
    + " FROM events GROUP BY 1")
def doublet_rate(spark, folder):
    calls = b.table(spark, folder, "events").select(
        F.col("event_type").alias("sample"),
        F.when(F.col("value") > 100, "doublet").otherwise("singlet").alias("doublet_call"))
    return rounded(qc.doublet_rate(calls))


@register("crosstab", sql("SELECT celltype, condition, count(*) AS n, "
    + rsql("1.0 * count(*) / sum(count(*)) OVER (PARTITION BY celltype) AS share")
    + " FROM cells GROUP BY 1, 2", "cells"))
def crosstab(spark, folder):
    return rounded(qc.crosstab(b.cells(spark, folder), "celltype", "condition"))


@register("crosstab_by_sample", sql("SELECT sample, condition, celltype, count(*) AS n, "
    + rsql("1.0 * count(*) / sum(count(*)) OVER (PARTITION BY sample, condition) AS share")
    + " FROM cells GROUP BY 1, 2, 3", "cells"))
def crosstab_by_sample(spark, folder):
    return rounded(qc.crosstab(b.cells(spark, folder), ["sample", "condition"], "celltype"))


@register("log_normalize", sql("SELECT gene, cell, " + rsql("value") + " FROM norm", "counts", "norm"))
def log_normalize(spark, folder):
    return rounded(b.normalised(spark, folder))


@register("log2_transform", sql("SELECT gene, sample, " + rsql("log2(value + 1) AS value")
    + " FROM expression", "counts", "cells", "expression"))
def log2_transform(spark, folder):
    return rounded(ex.log2_transform(b.expression(spark, folder)))


def _roles(spark, folder):
    role = F.when(F.col("condition") == b.CASE, "case").when(F.col("condition") == b.NORMAL, "normal")
    return b.samples(spark, folder).select("sample", role.alias("role")).where("role IS NOT NULL")


@register("group_means_lfc", sql("""
    r AS (SELECT gene, sum(CASE WHEN condition = 'EUROPE' THEN log2(value + 1) ELSE 0 END)
        / (SELECT count(*) FROM samples WHERE condition = 'EUROPE') AS case_mean,
      sum(CASE WHEN condition = 'ASIA' THEN log2(value + 1) ELSE 0 END)
        / (SELECT count(*) FROM samples WHERE condition = 'ASIA') AS normal_mean
      FROM expression JOIN samples USING (sample) GROUP BY 1)
    SELECT gene, """ + rsql("case_mean", "normal_mean", "case_mean - normal_mean AS log2fc") + " FROM r",
    "counts", "cells", "expression", "samples"))
def group_means_lfc(spark, folder):
    return rounded(ex.group_means_lfc(b.expression(spark, folder), _roles(spark, folder)))


@register("pseudobulk_sum", sql("""SELECT gene, sample, condition, sum(value) AS value
    FROM counts JOIN cells USING (cell) GROUP BY 1, 2, 3""", "counts", "cells"))
def pseudobulk_sum(spark, folder):
    return ex.pseudobulk_sum(b.counts(spark, folder), b.cells(spark, folder))


@register("pseudobulk_usable", sql("""SELECT CAST(sum(n) AS BIGINT) AS n_samples, min(n) AS fewest,
    sum(n) >= 4 AND min(n) >= 2 AS usable
    FROM (SELECT condition, count(DISTINCT sample) AS n FROM cells GROUP BY 1)""", "cells"))
def pseudobulk_usable(spark, folder):
    return ex.pseudobulk_usable(b.cells(spark, folder))


@register("pseudobulk_mean", sql("SELECT gene, sample, condition, " + rsql("sum(value) / max(n) AS value")
    + """ FROM counts JOIN cells USING (cell) JOIN (SELECT sample, count(*) AS n FROM cells GROUP BY 1)
    USING (sample) GROUP BY 1, 2, 3""", "counts", "cells"))
def pseudobulk_mean(spark, folder):
    return rounded(ex.pseudobulk_mean(b.counts(spark, folder), b.cells(spark, folder)))


@register("group_profile", sql("""SELECT sample, condition, CAST(sum(n) AS BIGINT) AS n_cells,
    arg_min(celltype, (-n, celltype)) AS cell_type
    FROM (SELECT sample, condition, celltype, count(*) AS n FROM cells GROUP BY 1, 2, 3)
    GROUP BY 1, 2""", "cells"))
def group_profile(spark, folder):
    return ex.group_profile(b.cells(spark, folder))


@register("majority_label", sql("""SELECT sample, celltype AS majority FROM (SELECT sample, celltype,
    row_number() OVER (PARTITION BY sample ORDER BY count(*) DESC, celltype) AS r
    FROM cells GROUP BY 1, 2) WHERE r = 1""", "cells"))
def majority_label(spark, folder):
    return ex.majority_label(b.cells(spark, folder), "sample", "celltype")


@register("expr_dot_summary", sql(TYPE_MEANS_SQL + "SELECT gene, celltype, "
    + rsql("mean", "100.0 * share AS percent") + " FROM means", "counts", "norm", "cells"))
def expr_dot_summary(spark, folder):
    return rounded(ex.expr_dot_summary(b.normalised(spark, folder), b.cells(spark, folder)))


@register("expression_specificity", sql(SPEC_SQL + "SELECT gene, " + rsql("specificity") + " FROM spec",
    "counts", "norm", "cells"))
def expression_specificity(spark, folder):
    means = ex.type_means(b.normalised(spark, folder), b.cells(spark, folder))
    return rounded(ex.expression_specificity(means))


@register("detection_and_top_type", sql(SPEC_SQL + f""",
    manifest AS (SELECT DISTINCT p_name AS gene, (ascii(p_name) % 10) / 10.0 AS feedback_score FROM part),
    det AS (SELECT gene, 1.0 * count(*) FILTER (value > 0) / {CELL_COUNT} AS detection_rate
      FROM norm GROUP BY 1),
    top AS (SELECT gene, celltype AS top_type, row_number() OVER (PARTITION BY gene ORDER BY mean DESC,
      celltype) AS r FROM means)
    SELECT gene, """ + rsql("feedback_score", "detection_rate", "specificity",
        "least(1, 0.7 * feedback_score + 0.3 * specificity) AS cell_support")
    + ", top_type FROM manifest JOIN det USING (gene) JOIN spec USING (gene) JOIN top USING (gene) WHERE r = 1",
    "counts", "norm", "cells"))
def detection_and_top_type(spark, folder):
    manifest = b.table(spark, folder, "part").select(
        F.col("p_name").alias("gene"), ((F.ascii("p_name") % 10) / 10.0).alias("feedback_score")
    ).distinct()
    return rounded(
        ex.detection_and_top_type(b.normalised(spark, folder), b.cells(spark, folder), manifest))


@register("gene_moments", sql(MOMENTS_SQL + "SELECT gene, " + rsql("mean", "variance") + " FROM moments",
    "counts", "norm", "cells"))
def gene_moments(spark, folder):
    return rounded(ex.gene_moments(b.normalised(spark, folder), _cell_count(spark, folder)))


@register("top_variance", sql(MOMENTS_SQL + "SELECT gene, " + rsql("mean", "variance")
    + " FROM moments ORDER BY variance DESC, gene LIMIT 20", "counts", "norm", "cells"))
def top_variance(spark, folder):
    return rounded(ex.top_variance(b.normalised(spark, folder), _cell_count(spark, folder), 20))


@register("variable_genes", sql(MOMENTS_SQL + """,
    binned AS (SELECT *, CAST(floor((rank() OVER (ORDER BY mean) - 1) * 8 / count(*) OVER ()) AS INTEGER)
      AS bin, ln(variance) AS lv FROM moments)
    SELECT gene, """ + rsql("mean", "variance") + """, bin, """ + rsql(
        """coalesce((lv - avg(lv) OVER (PARTITION BY bin)) / stddev_samp(lv) OVER (PARTITION BY bin), 0)
        AS standardized""") + " FROM binned ORDER BY standardized DESC, gene LIMIT 30",
    "counts", "norm", "cells"))
def variable_genes(spark, folder):
    return rounded(
        ex.variable_genes(b.normalised(spark, folder), _cell_count(spark, folder), k=30, bins=8))


@register("scale_genes", sql(MOMENTS_SQL + "SELECT gene, cell, "
    + rsql("(value - mean) / sqrt(variance) AS z", "(-mean) / sqrt(variance) AS z_zero")
    + " FROM norm JOIN moments USING (gene)", "counts", "norm", "cells"))
def scale_genes(spark, folder):
    return rounded(ex.scale_genes(b.normalised(spark, folder), _cell_count(spark, folder)))


MARKER_SQL = """
scored AS (SELECT cell, set_name, set_pos, sum(value) / max(size) AS score FROM norm
  JOIN word_sets USING (gene) JOIN (SELECT set_name, count(*) AS size FROM word_sets GROUP BY 1)
  USING (set_name) GROUP BY 1, 2, 3),
labels1 AS (SELECT cell, set_name AS label, score FROM (SELECT *, row_number() OVER (PARTITION BY cell
  ORDER BY score DESC, set_pos) AS r FROM scored) WHERE r = 1)
"""


@register("marker_annotation", sql(MARKER_SQL + """SELECT cell, coalesce(label, 'blue') AS label,
    """ + rsql("coalesce(score, 0) AS score") + " FROM cells LEFT JOIN labels1 USING (cell)",
    "counts", "norm", "cells", "word_sets"))
def marker_annotation(spark, folder):
    return rounded(ex.marker_annotation(
        b.normalised(spark, folder), b.word_sets(spark, folder), b.cells(spark, folder)))


MODULE_SQL = f"""
gm AS (SELECT gene, sum(value) / {CELL_COUNT} AS mean FROM norm GROUP BY 1),
gb AS (SELECT gene, floor((rank() OVER (ORDER BY mean) - 1) * 6 / count(*) OVER ()) AS bin FROM gm),
pool AS (SELECT gene, bin FROM (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5(gene), gene)
  AS r FROM gb) WHERE r <= 5),
roles AS (SELECT set_name, gene, 1 AS in_set FROM word_sets UNION ALL
  SELECT DISTINCT w.set_name, p.gene, 0 FROM word_sets w JOIN gb USING (gene) JOIN pool p ON gb.bin = p.bin),
rs AS (SELECT set_name, sum(in_set) AS n_in, sum(1 - in_set) AS n_out FROM roles GROUP BY 1),
module AS (SELECT c.cell, rs.set_name, coalesce(s.a, 0) / n_in - coalesce(s.o, 0) / n_out AS score
  FROM cells c CROSS JOIN rs LEFT JOIN (SELECT cell, set_name, sum(CASE WHEN in_set = 1 THEN value END) AS a,
    sum(CASE WHEN in_set = 0 THEN value END) AS o FROM norm JOIN roles USING (gene) GROUP BY 1, 2) s
  ON c.cell = s.cell AND rs.set_name = s.set_name)
"""


@register("module_score", sql(MODULE_SQL + "SELECT cell, set_name, " + rsql("score") + " FROM module",
    "counts", "norm", "cells", "word_sets"))
def module_score(spark, folder):
    return rounded(ex.module_score(
        b.normalised(spark, folder), b.word_sets(spark, folder), b.cells(spark, folder),
        controls=5, bins=6))


@register("cell_cycle_phase", sql(MODULE_SQL.replace("* 6 /", "* 24 /").replace("r <= 5", "r <= 50") + """,
    w AS (SELECT cell, max(score) FILTER (set_name = 'S') AS s_score,
      max(score) FILTER (set_name = 'G2M') AS g2m_score FROM module GROUP BY 1)
    SELECT cell, """ + rsql("s_score", "g2m_score") + """, CASE WHEN s_score <= 0 AND g2m_score <= 0
    THEN 'G1' WHEN s_score >= g2m_score THEN 'S' ELSE 'G2M' END AS phase FROM w""",
    "counts", "norm", "cells").replace("gm AS (", """word_sets AS (SELECT DISTINCT
    CASE WHEN p_name LIKE 'hot %' THEN 'S' ELSE 'G2M' END AS set_name, p_name AS gene FROM part
    WHERE p_name LIKE 'hot %' OR p_name LIKE 'cold %'), gm AS (""", 1))
def cell_cycle_phase(spark, folder):
    sets = b.word_sets(spark, folder)
    return rounded(ex.cell_cycle_phase(
        b.normalised(spark, folder), sets.where("set_name = 'hot'"), sets.where("set_name = 'cold'"),
        b.cells(spark, folder)))


@register("regress_out", sql(f"""
    cov AS (SELECT c_custkey AS cell, CAST(c_acctbal AS DOUBLE) / 1000 AS x1,
      CAST(c_nationkey AS DOUBLE) AS x2 FROM customer),
    full_grid AS (SELECT g.gene, cov.*, coalesce(norm.value, 0) AS v
      FROM (SELECT DISTINCT gene FROM norm) g CROSS JOIN cov LEFT JOIN norm
      ON norm.gene = g.gene AND norm.cell = cov.cell),
    s AS (SELECT gene, covar_pop(x1, v) AS c1, covar_pop(x2, v) AS c2, var_pop(x1) AS v1, var_pop(x2) AS v2,
      covar_pop(x1, x2) AS c12, avg(v) AS mv, avg(x1) AS m1, avg(x2) AS m2 FROM full_grid GROUP BY 1),
    f AS (SELECT gene, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1,
      (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2, mv, m1, m2 FROM s)
    SELECT gene, cell, """ + rsql("value - (mv - b1 * m1 - b2 * m2) - b1 * x1 - b2 * x2 AS residual",
        "mv - b1 * m1 - b2 * m2 AS b0", "b1", "b2")
    + " FROM norm JOIN cov USING (cell) JOIN f USING (gene)", "counts", "norm"))
def regress_out(spark, folder):
    covariates = b.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("cell"), (F.col("c_acctbal") / 1000).alias("x1"),
        F.col("c_nationkey").cast("double").alias("x2"))
    return rounded(ex.regress_out(
        b.normalised(spark, folder), covariates, _cell_count(spark, folder), "x1", "x2"))


WINDOW_SQL = MOMENTS_SQL + """,
z AS (SELECT gene, cell, (value - mean) / sqrt(variance) AS z FROM norm JOIN moments USING (gene)),
pos AS (SELECT gene, row_number() OVER (ORDER BY gene) AS pos FROM moments),
grid AS (SELECT c.cell, p.pos, coalesce(z.z, -mean / sqrt(variance)) AS z FROM cells c
  CROSS JOIN pos p JOIN moments m ON m.gene = p.gene LEFT JOIN z ON z.gene = p.gene AND z.cell = c.cell),
win AS (SELECT cell, CAST(w AS INTEGER) AS window_id, avg(z) AS score FROM grid
  JOIN range(0, 12) r(w) ON pos > w * 4 AND pos <= w * 4 + 16 GROUP BY 1, 2)
"""


def _windows(spark, folder):
    norm, people = b.normalised(spark, folder), b.cells(spark, folder)
    z = ex.scale_genes(norm, _cell_count(spark, folder))
    positions = ex.genome_positions(norm.select("gene").distinct())
    return ex.sliding_windows(z, positions, people, width=16, step=4)


@register("sliding_windows", sql(WINDOW_SQL.replace("range(0, 12)", "range(0, 15)") + "SELECT cell, window_id, " + rsql("score")
    + " FROM win WHERE window_id * 4 <= 64 - 8", "counts", "norm", "cells"))
def sliding_windows(spark, folder):
    return rounded(_windows(spark, folder).withColumnRenamed("window", "window_id"))


@register("inferred_cnv", sql(WINDOW_SQL.replace("range(0, 12)", "range(0, 15)") + "SELECT cell, window_id, "
    + rsql("score - median(score) OVER (PARTITION BY window_id) AS score")
    + " FROM win", "counts", "norm", "cells"))
def inferred_cnv(spark, folder):
    return rounded(ex.inferred_cnv(_windows(spark, folder)).withColumnRenamed("window", "window_id"))


@register("stratified_cap", sql("""SELECT cell, sample, condition, celltype FROM (SELECT *, row_number() OVER (
    PARTITION BY condition ORDER BY md5('42:' || CAST(cell AS VARCHAR)), cell) AS r FROM cells) WHERE r <= 100""", "cells"))
def stratified_cap(spark, folder):
    return ex.stratified_cap(b.cells(spark, folder), "condition", 100)


@register("stride_sample", """WITH o AS (SELECT c_custkey AS cell, row_number() OVER (ORDER BY c_custkey) - 1 AS i,
    count(*) OVER () AS n FROM customer)
    SELECT cell FROM o WHERE i % greatest(1, n // 400) = 0 AND i // greatest(1, n // 400) < 400""")
def stride_sample(spark, folder):
    return ex.stride_sample(b.cells(spark, folder), [F.col("cell")], 400).select("cell")


@register("top_k_per_group", """SELECT gene, sample, value FROM (SELECT p_brand AS gene, p_type AS sample,
    count(*) AS value, rank() OVER (PARTITION BY p_type ORDER BY count(*) DESC) AS r
    FROM part JOIN lineitem ON l_partkey = p_partkey GROUP BY 1, 2) WHERE r <= 3""")
def top_k_per_group(spark, folder):
    parts, lines = b.table(spark, folder, "part"), b.table(spark, folder, "lineitem")
    sold = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).groupBy(
        F.col("p_brand").alias("gene"), F.col("p_type").alias("sample")
    ).agg(F.count(F.lit(1)).alias("value"))
    return ex.top_k_per_group(sold, "sample", F.col("value").desc(), 3)


@register("cell_communication", sql(TYPE_MEANS_SQL + """,
    pairs AS (SELECT DISTINCT split_part(a.p_name, ' ', 1) AS set_name, a.p_name AS ligand,
      'small ' || split_part(a.p_name, ' ', 2) AS receptor FROM part a)
    SELECT set_name, l.celltype AS sender, r.celltype AS receiver, count(*) AS n_pairs,
    """ + rsql("sum(l.mean * r.mean / (0.5 + l.mean * r.mean)) AS weight") + """ FROM pairs
    JOIN means l ON l.gene = ligand JOIN means r ON r.gene = receptor GROUP BY 1, 2, 3""",
    "counts", "norm", "cells"))
def cell_communication(spark, folder):
    people = b.cells(spark, folder)
    means = ex.type_means(b.normalised(spark, folder), people)
    sizes = people.groupBy("celltype").agg(F.count(F.lit(1)).alias("n"))
    pairs = b.word_sets(spark, folder).select(
        "set_name", F.col("gene").alias("ligand"),
        F.concat(F.lit("small "), F.split_part("gene", F.lit(" "), F.lit(2))).alias("receptor"))
    return rounded(ex.cell_communication(means, pairs, sizes, by=["set_name"]))


@register("validate_inputs", sql("""
    f AS (SELECT (SELECT count(*) FROM expression) AS n, (SELECT count(value) FROM expression) AS m,
      (SELECT count(*) FROM cells WHERE sample IS NULL) AS missing,
      (SELECT max(c) FROM (SELECT count(*) AS c FROM cells GROUP BY sample)) AS rep,
      (SELECT count(DISTINCT condition) FROM cells) AS conds)
    SELECT 'expression_not_empty' AS "check", n > 0 AS ok FROM f UNION ALL
    SELECT 'expression_numeric', m > 0 FROM f UNION ALL SELECT 'samples_present', missing = 0 FROM f
    UNION ALL SELECT 'samples_unique', rep = 1 FROM f UNION ALL SELECT 'two_conditions', conds >= 2 FROM f""",
    "counts", "cells", "expression"))
def validate_inputs(spark, folder):
    return qc.validate_inputs(b.expression(spark, folder), b.cells(spark, folder))


@register("qc_gate", sql(METRICS_SQL + """,
    m AS (SELECT CAST(count(*) AS DOUBLE) AS n_cells, (SELECT CAST(count(DISTINCT gene) AS DOUBLE) FROM counts)
      AS n_genes, max(percent_mito) / 100 AS rate FROM metrics)
    SELECT 'min_cells_after_qc' AS name, n_cells AS value, CAST(100.0 AS DOUBLE) AS threshold,
      CASE WHEN n_cells >= 100 THEN 'pass' ELSE 'fail' END AS level, n_cells >= 100 AS ok FROM m
    UNION ALL SELECT 'min_genes', n_genes, 1000.0, CASE WHEN n_genes >= 1000 THEN 'pass' ELSE 'fail' END,
      n_genes >= 1000 FROM m
    UNION ALL SELECT 'max_doublet_rate', """ + rsql("rate AS rate").replace(" AS rate", "") + """, 0.3,
      CASE WHEN rate <= 0.3 THEN 'pass' ELSE 'fail' END, rate <= 0.3 FROM m
    UNION ALL SELECT 'min_deg_genes', NULL, 5.0, 'warn', false""", "counts"))
def qc_gate(spark, folder):
    metrics = _metrics(spark, folder).agg(
        F.count(F.lit(1)).alias("n_cells"), (F.max("percent_mito") / 100).alias("rate"))
    genes = b.counts(spark, folder).agg(F.countDistinct("gene")).scalar()
    return rounded(qc.qc_gate(
        metrics.withColumn("n_genes", genes),
        {
            "min_cells_after_qc": ("n_cells", 100, "min"), "min_genes": ("n_genes", 1000, "min"),
            "min_deg_genes": ("deg_total", 5, "min"), "max_doublet_rate": ("rate", 0.3, "max"),
            "switched_off": ("n_cells", 0, "min"),
        },
    ))


@register("table_profile", """
    WITH v AS (SELECT * FROM (SELECT 'valid' AS item, 'l_quantity' AS field, CAST(count(l_quantity) AS DOUBLE) AS value FROM lineitem)
    UNION ALL SELECT 'mean', 'l_quantity', avg(l_quantity) FROM lineitem
    UNION ALL SELECT 'min', 'l_quantity', min(l_quantity) FROM lineitem
    UNION ALL SELECT 'max', 'l_quantity', max(l_quantity) FROM lineitem
    UNION ALL SELECT 'valid', 'padj', count(l_discount) FROM lineitem
    UNION ALL SELECT 'mean', 'padj', avg(l_discount) FROM lineitem
    UNION ALL SELECT 'min', 'padj', min(l_discount) FROM lineitem
    UNION ALL SELECT 'max', 'padj', max(l_discount) FROM lineitem
    UNION ALL SELECT 'valid', 'logFC', count(l_tax) FROM lineitem
    UNION ALL SELECT 'mean', 'logFC', avg(l_tax - 0.04) FROM lineitem
    UNION ALL SELECT 'min', 'logFC', min(l_tax - 0.04) FROM lineitem
    UNION ALL SELECT 'max', 'logFC', max(l_tax - 0.04) FROM lineitem
    UNION ALL SELECT 'valid', 'condition', 0
    UNION ALL SELECT 'rows', '', count(*) FROM lineitem
    UNION ALL SELECT 'p_below_0.05', 'padj', count(*) FILTER (l_discount < 0.05) FROM lineitem
    UNION ALL SELECT 'p_below_0.01', 'padj', count(*) FILTER (l_discount < 0.01) FROM lineitem
    UNION ALL SELECT 'up', 'logFC', count(*) FILTER (l_tax - 0.04 > 0) FROM lineitem
    UNION ALL SELECT 'down', 'logFC', count(*) FILTER (l_tax - 0.04 < 0) FROM lineitem
    UNION ALL SELECT 'distinct_condition', 'condition', count(DISTINCT l_returnflag) FROM lineitem)
    SELECT item, field, """ + rsql("value", digits=10) + " FROM v")
def table_profile(spark, folder):
    lines = b.table(spark, folder, "lineitem").select(
        "l_quantity", F.col("l_discount").alias("padj"), (F.col("l_tax") - 0.04).alias("logFC"),
        F.col("l_returnflag").alias("condition"))
    return rounded(qc.table_profile(lines), digits=10)


@register("flag_counts", """SELECT 'direction' AS flag, lower(l_returnflag) AS label, count(*) AS n
    FROM lineitem GROUP BY 2 UNION ALL SELECT 'doublet', lower(l_linestatus), count(*) FROM lineitem GROUP BY 2""")
def flag_counts(spark, folder):
    return qc.flag_counts(b.table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("direction"), F.col("l_linestatus").alias("doublet_call")))


@register("score_histogram", """WITH e AS (SELECT min(-l_extendedprice / 10000.0) AS lo,
    max(-l_extendedprice / 10000.0) AS hi FROM lineitem),
    p AS (SELECT least(39, CAST(floor((-l_extendedprice / 10000.0 - lo) / ((hi - lo) / 40)) AS INTEGER)) AS bin,
      lo, hi FROM lineitem, e)
    SELECT bin, count(*) AS n, """ + rsql("max(lo) + bin * (max(hi) - max(lo)) / 40 AS low")
    + " FROM p GROUP BY 1")
def score_histogram(spark, folder):
    return rounded(qc.score_histogram(b.screening(spark, folder), "affinity", 40))
