"""Registered queries: embeddings, neighbours, models and their evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from targetlens.operators import embedding as em
from targetlens.operators import expression as ex
from targetlens.operators import learning as ml
from targetlens.operators import qc
from targetlens.plans import bindings as b
from targetlens.plans.bindings import sql
from targetlens.plans.expression_queries import METRICS_SQL
from targetlens.plans.registry import Family, rounded, rsql
from targetlens.session import cut_lineage

family = Family()
register = family.register
QUERIES, ORACLES = family.queries, family.oracles

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _points(spark, folder):
    return b.table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"), "label")


def _n_cells(spark, folder):
    return b.cells(spark, folder).agg(F.count(F.lit(1))).scalar()


@register("pca")
def pca(spark, folder):
    # read for the choice of genes, their moments and the vectors
    norm, n = cut_lineage(b.normalised(spark, folder).select("gene", "cell", "value")), _n_cells(spark, folder)
    genes = cut_lineage(ex.top_variance(norm, n, 2000).select("gene"))
    points = em.expression_pca(norm, n, genes, 10, b.cells(spark, folder))
    spread = points.select(F.posexplode("pcs").alias("pc", "x"))
    return rounded(spread.groupBy("pc").agg(F.var_pop("x").alias("variance"), F.count(F.lit(1)).alias("n")), digits=4)


@register("batch_center", """WITH l AS (SELECT vec_id, label, i, CAST(embedding[i] AS DOUBLE) AS x
      FROM embeddings, range(1, 65) r(i)), c AS (SELECT *, x - avg(x) OVER (PARTITION BY label, i) AS y FROM l)
    SELECT vec_id AS cell, CAST(label AS VARCHAR) AS sample, """ + rsql("sum(y) AS total", "sum(y * y) AS energy", digits=5)
    + " FROM c GROUP BY 1, 2")
def batch_center(spark, folder):
    points = _points(spark, folder).select(
        F.col("id").alias("cell"), F.col("label").cast("string").alias("sample"), F.col("v").alias("pcs"))
    add = lambda f: F.aggregate("pcs", F.lit(0.0), lambda a, x: a + f(x))
    return rounded(em.batch_center(points).select(
        "cell", "sample", add(lambda x: x).alias("total"), add(lambda x: x * x).alias("energy")), digits=5)


@register("knn_graph", """WITH p AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    d AS (SELECT a.id, b.id AS neighbour, list_distance(a.v, b.v) AS distance,
      row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank FROM p a JOIN p b ON a.id <> b.id)
    SELECT id, neighbour, """ + rsql("distance", digits=5) + ", CAST(rank AS INTEGER) AS rank FROM d WHERE rank <= 10")
def knn_graph(spark, folder):
    return rounded(em.knn_graph(_points(spark, folder), 10), digits=5)


@register("cluster_cells")
def cluster_cells(spark, folder):
    graph = em.knn_graph(_points(spark, folder), 10)
    return em.cluster_cells(graph).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


@register("cluster_kmeans")
def cluster_kmeans(spark, folder):
    points = _points(spark, folder).select(F.col("id").alias("cell"), F.col("v").alias("pcs"))
    return em.cluster_kmeans(points, 10).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))


REFERENCE_SQL = """
genes AS (SELECT DISTINCT gene FROM norm),
prof AS (SELECT celltype AS label, gene, round(sum(value) / max(n), 9) AS mean FROM norm JOIN cells USING (cell)
  JOIN (SELECT celltype, count(*) AS n FROM cells GROUP BY 1) USING (celltype) GROUP BY 1, 2),
q AS (SELECT label, gene, rank() OVER (PARTITION BY label ORDER BY mean)
  + (count(*) OVER (PARTITION BY label, mean) - 1) / 2.0 AS q FROM prof),
dense AS (SELECT c.cell, g.gene, coalesce(n.value, 0) AS value FROM (SELECT DISTINCT cell FROM norm) c CROSS JOIN genes g
  LEFT JOIN norm n ON n.cell = c.cell AND n.gene = g.gene),
r AS (SELECT cell, gene, rank() OVER (PARTITION BY cell ORDER BY value)
  + (count(*) OVER (PARTITION BY cell, value) - 1) / 2.0 AS r FROM dense),
k AS (SELECT cell, label, corr(CAST(r AS DOUBLE), CAST(q AS DOUBLE)) AS c FROM r JOIN q USING (gene) GROUP BY 1, 2)
"""


@register("reference_annotation", sql(REFERENCE_SQL + "SELECT cell, label, " + rsql("c AS correlation", digits=5)
    + " FROM (SELECT *, row_number() OVER (PARTITION BY cell ORDER BY round(c, 12) DESC, label DESC) AS i FROM k) WHERE i = 1", "counts", "norm", "cells"))
def reference_annotation(spark, folder):
    norm, people = b.normalised(spark, folder), b.cells(spark, folder)
    profiles = rounded(ex.type_means(norm, people), "mean", digits=9).select(
        F.col("celltype").alias("label"), "gene", "mean")
    n_genes = norm.select("gene").distinct().agg(F.count(F.lit(1))).scalar()
    return rounded(em.reference_annotation(norm, profiles, n_genes), digits=5)


@register("doublet_score")
def doublet_score(spark, folder):
    scored = em.doublet_score(b.counts(spark, folder), k=15, n_pcs=10)
    return scored.groupBy("doublet_call").agg(F.count(F.lit(1)).alias("n"))


@register("sample_feature_join", sql(METRICS_SQL + """,
    p AS (SELECT sample, """ + ", ".join(
        f"1.0 * count(*) FILTER (celltype = '{s}') / count(*) AS p{i}" for i, s in enumerate(SEGMENTS)) + """ FROM cells GROUP BY 1),
    m AS (SELECT sample, avg(n_count) AS n_count, avg(n_feature) AS n_feature, avg(percent_mito) AS percent_mito
      FROM metrics JOIN cells USING (cell) GROUP BY 1)
    SELECT sample, condition, """ + rsql(*[f"p{i} AS {s}" for i, s in enumerate(SEGMENTS)], "n_count", "n_feature", "percent_mito")
    + " FROM p JOIN (SELECT DISTINCT sample, condition FROM cells) USING (sample) LEFT JOIN m USING (sample)", "counts", "cells"))
def sample_feature_join(spark, folder):
    return rounded(_features(spark, folder))


NAMES = ["n_count", "n_feature", "percent_mito"]


def _features(spark, folder):
    metrics = qc.cell_qc_metrics(b.counts(spark, folder), b.MITO, b.RIBO)
    return ml.sample_feature_join(b.cells(spark, folder), metrics, SEGMENTS, NAMES)


@register("sample_classifier")
def sample_classifier(spark, folder):
    return ml.sample_classifier(_features(spark, folder), SEGMENTS + NAMES, "rf")


def _labelled(spark, folder):
    """(id, label, x0..x7): one column per embedding block, label 1 for the even clusters."""
    points = _points(spark, folder)
    blocks = [
        F.aggregate(F.slice("v", 8 * i + 1, 8), F.lit(0.0), lambda a, x: a + x).alias(f"x{i}") for i in range(8)]
    return points.select("id", (F.col("label") % 2).cast("double").alias("label"), *blocks)


@register("l1_rfe_select")
def l1_rfe_select(spark, folder):
    columns = [f"x{i}" for i in range(8)]
    kept = ml.l1_rfe_select(_labelled(spark, folder), columns, most=4)
    return spark.createDataFrame([(c,) for c in kept], "feature string")


@register("feature_importance")
def feature_importance(spark, folder):
    from pyspark.ml.feature import VectorAssembler

    columns = [f"x{i}" for i in range(8)]
    data = VectorAssembler(inputCols=columns, outputCol="features").transform(_labelled(spark, folder))
    model = ml.build_classifier("rf", 8, 2).fit(data)
    return rounded(spark.createDataFrame(ml.feature_importance(model, columns), "feature string, importance double"))


@register("permutation_importance")
def permutation_importance(spark, folder):
    from pyspark.ml.feature import VectorAssembler

    columns = [f"x{i}" for i in range(8)]
    rows = _labelled(spark, folder)
    data = VectorAssembler(inputCols=columns, outputCol="features").transform(rows)
    model = ml.build_classifier("lr", len(columns), 2).fit(data)
    return rounded(ml.permutation_importance(model, rows, columns, "label", "id"))


# Predictions for the report operators: labels against a score made from the text length.
SCORED_SQL = """
scored AS (SELECT doc_id, quality AS label, (n_chars % 97) / 96.0 AS score,
  CASE WHEN n_chars % 97 >= 30 THEN 1 ELSE 0 END AS prediction FROM documents JOIN labels USING (doc_id)),
hist AS (SELECT score, count(*) FILTER (label = 1) AS tp, count(*) FILTER (label <> 1) AS fp FROM scored GROUP BY 1),
cum AS (SELECT *, sum(tp) OVER (ORDER BY score DESC) AS ctp, sum(fp) OVER (ORDER BY score DESC) AS cfp,
  sum(tp) OVER () AS p, sum(fp) OVER () AS n FROM hist)
"""


def _scored(spark, folder):
    rest = F.col("n_chars") % 97
    return b.table(spark, folder, "documents").join(b.table(spark, folder, "labels"), "doc_id").select(
        "doc_id", F.col("quality").alias("label"), (rest / 96.0).alias("score"),
        F.when(rest >= 30, 1).otherwise(0).alias("prediction"))


@register("class_metrics", sql("WITH " + SCORED_SQL.strip() + " SELECT "
    + rsql("sum((ctp - tp / 2.0) * fp) / (max(p) * max(n)) AS roc_auc", "sum(tp * ctp / (ctp + cfp)) / max(p) AS average_precision") + " FROM cum"))
def class_metrics(spark, folder):
    return rounded(ml.ranking_quality(_scored(spark, folder)))


@register("roc_curve", "WITH " + SCORED_SQL.strip() + " SELECT " + rsql(
    "score", "cfp / n AS fpr", "ctp / p AS tpr", "ctp / (ctp + cfp) AS precision") + " FROM cum")
def roc_curve(spark, folder):
    return rounded(ml.roc_curve(_scored(spark, folder)))


@register("confusion", "WITH " + SCORED_SQL.strip() + " SELECT label, prediction, count(*) AS n FROM scored GROUP BY 1, 2")
def confusion(spark, folder):
    return ml.confusion(_scored(spark, folder))


@register("class_report", "WITH " + SCORED_SQL.strip() + """, c AS (SELECT unnest([0, 1]) AS class),
    k AS (SELECT class, count(*) FILTER (label = class AND prediction = class) AS h, count(*) FILTER (label = class) AS t,
      count(*) FILTER (prediction = class) AS q FROM scored, c GROUP BY 1)
    SELECT class, """ + rsql("h / q AS precision", "h / t AS recall", "2 * h / (q + t) AS f1") + ", t AS support FROM k")
def class_report(spark, folder):
    return rounded(ml.class_report(_scored(spark, folder)))


@register("calibration", "WITH " + SCORED_SQL.strip() + """ SELECT CAST(least(5, floor(score * 6)) AS INTEGER) AS bin, count(*) AS n,
    """ + rsql("avg(score) AS mean_predicted", "avg(label) AS observed") + " FROM scored GROUP BY 1")
def calibration(spark, folder):
    return rounded(ml.calibration(_scored(spark, folder)))


@register("macro_quality", """WITH s AS (SELECT p_type AS label, CAST(p_size AS DOUBLE) / 50 AS score FROM part),
    f AS (SELECT c.class, CASE WHEN s.label = c.class THEN 1 ELSE 0 END AS label, s.score FROM s, (SELECT DISTINCT label AS class FROM s) c),
    h AS (SELECT class, score, sum(label) AS tp, sum(1 - label) AS fp FROM f GROUP BY 1, 2),
    c AS (SELECT *, sum(tp) OVER (PARTITION BY class ORDER BY score DESC) AS ctp, sum(fp) OVER (PARTITION BY class ORDER BY score DESC) AS cfp,
      sum(tp) OVER (PARTITION BY class) AS p, sum(fp) OVER (PARTITION BY class) AS n FROM h),
    q AS (SELECT class, sum((ctp - tp / 2.0) * fp) / (max(p) * max(n)) AS a, sum(tp * ctp / (ctp + cfp)) / max(p) AS ap FROM c GROUP BY 1)
    SELECT """ + rsql("avg(a) AS roc_auc", "avg(ap) AS average_precision") + " FROM q")
def macro_quality(spark, folder):
    parts = b.table(spark, folder, "part")
    kinds = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    scores = parts.select(
        F.col("p_type").alias("label"), (F.col("p_size") / 50).alias("score"),
        F.explode(F.array(*[F.lit(k) for k in kinds])).alias("class"))
    return rounded(ml.macro_quality(scores))


@register("regression_metrics", "SELECT " + rsql(
    "1 - sum(power(l_extendedprice - 1500 * l_quantity, 2)) / (var_pop(l_extendedprice) * count(*)) AS r2",
    "sqrt(avg(power(l_extendedprice - 1500 * l_quantity, 2))) AS rmse") + " FROM lineitem")
def regression_metrics(spark, folder):
    return rounded(ml.regression_metrics(b.table(spark, folder, "lineitem").select(
        F.col("l_extendedprice").alias("label"), (1500 * F.col("l_quantity")).alias("prediction"))))


@register("prediction_confidence")
def prediction_confidence(spark, folder):
    from pyspark.ml.feature import VectorAssembler

    columns = [f"x{i}" for i in range(8)]
    data = VectorAssembler(inputCols=columns, outputCol="features").transform(_labelled(spark, folder))
    # out of fold: a row's confidence comes from a model that has not seen it
    scored = ml.cross_predict(ml.folds(data, "label", "id", 5), ml.build_classifier("lr", 8, 2), 5)
    return rounded(ml.prediction_confidence(scored, "id", ["even", "odd"]), digits=4)


@register("rescoring")
def rescoring(spark, folder):
    points = _points(spark, folder).select("id", F.col("v").alias("features"), (F.col("label") % 2).alias("active"))
    return rounded(ml.rescoring_out_of_fold(points, "active", "id"), digits=4)


def _texts(spark, folder):
    docs = b.table(spark, folder, "documents").join(b.table(spark, folder, "labels"), "doc_id")
    return docs.select("doc_id", "text", F.col("quality").alias("label"))


@register("text_relevance_train")
def text_relevance_train(spark, folder):
    score = ml.text_relevance_train(_texts(spark, folder), "lr")
    return rounded(score(b.table(spark, folder, "documents").select("doc_id", "text")).select("doc_id", "ml_score"), digits=4)


@register("text_relevance_eval")
def text_relevance_eval(spark, folder):
    return ml.evaluation_summary(ml.text_relevance_eval(_texts(spark, folder), "doc_id", "lr"), {"model": "lr"})
