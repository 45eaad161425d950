"""Models on features and texts, and their evaluation.

Curves and reports are aggregates of (label, score) rows; models come from Spark ML.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import (
    CountVectorizerModel, IDF, NGram, Normalizer, RegexTokenizer, SQLTransformer, StopWordsRemover,
    StringIndexer, VectorAssembler, VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.functions.columns import ratio
from targetlens.functions.ordering import row_numbers, running_totals
from targetlens.operators.qc import crosstab
from targetlens.session import cut_lineage


# ---- evaluation -----------------------------------------------------------------------------


def confusion(predictions: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    return predictions.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("n"))


def class_report(predictions: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """Per class: precision, recall, F1 and support; 0 where undefined."""
    pairs = predictions.select(F.explode(F.array(
        F.struct(F.col(label).alias("class"), F.lit(1).alias("t"), F.lit(0).alias("p"),
                 (F.col(label) == F.col(predicted)).cast("int").alias("hit")),
        F.struct(F.col(predicted).alias("class"), F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("hit")),
    )).alias("x")).select("x.*")
    sums = pairs.groupBy("class").agg(
        F.sum("hit").alias("_h"), F.sum("t").alias("support"), F.sum("p").alias("_p"))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return sums.select(
        "class", zero(ratio(F.col("_h"), F.col("_p"))).alias("precision"),
        zero(ratio(F.col("_h"), F.col("support"))).alias("recall"),
        zero(ratio(2.0 * F.col("_h"), F.col("_p") + F.col("support"))).alias("f1"), "support",
    )


def _thresholds(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per distinct score, high to low: hits and misses here and so far, with the group totals."""
    positive = F.when(F.col("label") == 1, 1).otherwise(0)
    steps = running_totals(
        scored, "score", {"tp": F.sum(positive), "fp": F.sum(1 - positive)}, by, descending=True)
    totals = steps.groupBy(*by).agg(F.sum("tp").alias("_pos"), F.sum("fp").alias("_neg"))
    if by:
        return steps.join(totals, list(by))
    whole = totals.select(F.struct("_pos", "_neg")).scalar()
    return steps.withColumn("_w", whole).select("*", "_w._pos", "_w._neg").drop("_w")


def roc_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(score, fpr, tpr, precision) per distinct threshold of (label 0/1, score)."""
    steps = _thresholds(scored, by)
    return steps.select(
        *by, "score", ratio(F.col("cum_fp"), F.col("_neg")).alias("fpr"),
        ratio(F.col("cum_tp"), F.col("_pos")).alias("tpr"),
        ratio(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp")).alias("precision"),
    )


def ranking_quality(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (trapezoids) and average precision of (label 0/1, score), one row per group."""
    steps = _thresholds(scored, by)
    area = F.sum((F.col("cum_tp") - F.col("tp") / 2.0) * F.col("fp"))
    step = F.col("tp") * ratio(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp"))
    return steps.groupBy(*by).agg(
        ratio(area, F.max(F.col("_pos").cast("double") * F.col("_neg"))).alias("roc_auc"),
        ratio(F.sum(step), F.max("_pos")).alias("average_precision"),
    )


def macro_quality(scores: DataFrame) -> DataFrame:
    """Mean one-vs-rest AUC and average precision from (label, class, score) rows."""
    flagged = scores.select("class", (F.col("label") == F.col("class")).cast("int").alias("label"), "score")
    return ranking_quality(flagged, ["class"]).agg(
        F.avg("roc_auc").alias("roc_auc"), F.avg("average_precision").alias("average_precision"))


def calibration(scored: DataFrame, bins: int | None = None) -> DataFrame:
    """Equal-width probability bins: size, mean prediction, observed share.

    Without ``bins`` their number is the rounded-up root of the rows, within 3..6.
    """
    if bins is None:
        n = scored.agg(F.ceil(F.sqrt(F.count(F.lit(1))))).scalar()
        width = F.least(F.lit(6), F.greatest(F.lit(3), n))
    else:
        width = F.lit(bins)
    placed = scored.withColumn("_k", width).select(
        F.least(F.col("_k") - 1, F.floor(F.col("score") * F.col("_k"))).cast("int").alias("bin"), "score", "label")
    return placed.groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean_predicted"),
        F.avg(F.col("label").cast("double")).alias("observed"))


def regression_metrics(predictions: DataFrame, label: str = "label", predicted: str = "prediction") -> DataFrame:
    """R2 and RMSE in one pass."""
    y, e = F.col(label), F.col(label) - F.col(predicted)
    spread = F.var_pop(y) * F.count(F.lit(1))
    return predictions.agg(
        (1.0 - ratio(F.sum(e * e), spread)).alias("r2"), F.sqrt(F.avg(e * e)).alias("rmse"))


def prediction_confidence(predictions: DataFrame, key: str, labels: Sequence[str]) -> DataFrame:
    """(key, predicted, confidence): label and probability of the most likely class."""
    p = vector_to_array("probability")
    names = F.array(*[F.lit(x) for x in labels])
    return predictions.select(
        key, F.element_at(names, (F.col("prediction") + 1).cast("int")).alias("predicted"),
        F.array_max(p).alias("confidence"))


# ---- features and models ---------------------------------------------------------------------


def sample_feature_join(
    cells: DataFrame, metrics: DataFrame, types: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """One row per sample: cell-type shares, mean QC metrics, condition.

    ``types`` names the cell types (the columns); a type a sample lacks has share 0.
    """
    shares = crosstab(cells, "sample", "celltype").groupBy("sample").pivot("celltype", list(types)).agg(
        F.first("share"))
    conditions = cells.select("sample", "condition").dropna().distinct()
    means = metrics.join(cells.select("cell", "sample"), "cell").groupBy("sample").agg(
        *[F.avg(n).alias(n) for n in names])
    return shares.join(conditions, "sample").join(means, "sample", "left").fillna(0.0, [*types, *names])


class LassoSVC(Estimator):
    """L1 logistic regression, elimination and a linear support vector machine as one estimator.

    Features that the L1 fit gives no weight go (the first five stay if it gives none any); the one
    with the least weight in a machine on the rest goes next, until at most ``most`` are left. A
    logistic regression on the margins of the last machine gives probabilities. The fitted model is
    a pipeline whose first stage slices the features out.
    """

    def __init__(self, classes: int, strength: float = 0.01, fewest: int = 2, most: int = 15):
        super().__init__()
        self.classes, self.strength, self.fewest, self.most = classes, strength, fewest, most

    def _machine(self):
        names = {"featuresCol": "_chosen", "predictionCol": "_side", "rawPredictionCol": "_margin"}
        svm = LinearSVC(maxIter=50, **names)
        return svm if self.classes == 2 else OneVsRest(classifier=svm, **names)

    def _weights(self, machine, spread: np.ndarray) -> np.ndarray:
        rows = [m.coefficients.toArray() for m in getattr(machine, "models", [machine])]
        return np.abs(np.array(rows)).max(axis=0) * spread

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        data = cut_lineage(dataset.select("features", "label"))
        lasso = LogisticRegression(elasticNetParam=1.0, regParam=self.strength, maxIter=100).fit(data)
        found = np.abs(lasso.coefficientMatrix.toArray()).max(axis=0)
        spread = data.select(Summarizer.std(F.col("features")).alias("s")).first()["s"].toArray()
        kept = [int(i) for i in np.flatnonzero(found > 1e-8)] or list(range(min(5, len(found))))
        goal = max(self.fewest, min(self.most, len(kept)))
        while True:
            slicer = VectorSlicer(inputCol="features", outputCol="_chosen", indices=kept)
            machine = self._machine().fit(slicer.transform(data))
            if len(kept) <= goal:
                break
            kept.pop(int(self._weights(machine, spread[kept]).argmin()))
        margins = machine.transform(slicer.transform(data))
        calibrated = LogisticRegression(featuresCol="_margin", rawPredictionCol="rawPrediction").fit(margins.select("_margin", "label"))
        return PipelineModel([slicer, machine, calibrated])


def build_classifier(name: str, features: int, classes: int, seed: int = 42):
    """Spark model for rf, gbm / xgb, mlp, svm, lasso_svm, lr.

    Boosted trees and linear SVM are binary in Spark, so more classes go one-vs-rest.
    """
    if name == "rf":
        return RandomForestClassifier(numTrees=100, maxDepth=8, seed=seed)
    if name in ("gbm", "xgb"):
        tree = GBTClassifier(maxIter=30, maxDepth=3 if name == "gbm" else 4, stepSize=0.1, seed=seed)
        return tree if classes == 2 else OneVsRest(classifier=tree)
    if name == "mlp":
        return MultilayerPerceptronClassifier(layers=[features, 64, 32, classes], maxIter=100, seed=seed)
    if name == "lasso_svm":
        return LassoSVC(classes)
    if name == "svm":
        return LinearSVC(maxIter=50) if classes == 2 else OneVsRest(classifier=LinearSVC(maxIter=50))
    if name == "lr":
        return LogisticRegression(maxIter=100)
    raise ValueError(f"unknown model: {name}")


def folds(df: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..n-1: rows in seeded hash order within their label, dealt in turn."""
    order = [F.col(label), F.xxhash64(F.lit(seed), key), F.col(key)]
    dealt = row_numbers(df, order, "_i")
    return dealt.withColumn("fold", F.pmod(F.col("_i"), F.lit(n)).cast("int")).drop("_i")


def cross_predict(df: DataFrame, estimator, n: int) -> DataFrame:
    """Out-of-fold predictions of an ML estimator; ``df`` has a ``fold`` column."""
    out = None
    for fold in range(n):
        model = estimator.fit(df.where(F.col("fold") != fold))
        part = model.transform(df.where(F.col("fold") == fold))
        out = part if out is None else out.unionByName(part)
    return out


def sample_classifier(
    features: DataFrame, columns: Sequence[str], model: str = "rf", target: str = "condition",
    key: str = "sample", splits: int = 5, seed: int = 42,
) -> DataFrame | None:
    """Out-of-fold (key, label, prediction, predicted, actual); None below 4 rows or 2 classes."""
    facts = features.groupBy(target).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n"), F.count(F.lit(1)), F.min("n")).first()
    if (facts[0] or 0) < 4 or facts[1] < 2:
        return None
    n = max(2, min(splits, facts[2]))
    indexer = StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc").fit(features)
    data = VectorAssembler(inputCols=list(columns), outputCol="features").transform(indexer.transform(features))
    data = folds(data.select(key, target, "label", "features"), "label", key, n, seed)
    scored = cross_predict(data, build_classifier(model, len(columns), facts[1], seed), n)
    names = F.array(*[F.lit(x) for x in indexer.labels])
    return scored.select(
        key, F.col(target).alias("actual"), "label", "prediction",
        F.element_at(names, (F.col("prediction") + 1).cast("int")).alias("predicted"))


def feature_importance(model, names: Sequence[str]) -> list[tuple[str, float]]:
    """(feature, importance) from tree importances or mean absolute coefficients."""
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()).mean(axis=0)
    else:
        values = abs(model.coefficients.toArray())
    return sorted(zip(names, map(float, values)), key=lambda x: -x[1])


def permutation_importance(
    model, df: DataFrame, columns: Sequence[str], label: str, key: str, repeats: int = 3, seed: int = 42
) -> DataFrame:
    """(feature, importance): loss of accuracy when one column is shuffled.

    Shuffling gives the row at place i the value of the row at hash place i; both orders are
    numbered without a single-task sort. ``model`` reads ``features``.
    """
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    hit = F.avg((F.col("prediction") == F.col(label)).cast("double"))
    rows = row_numbers(df.select(key, label, *columns), [F.col(key)], "_i")
    base = model.transform(assembler.transform(rows)).agg(hit.alias("a")).first()["a"]
    results = []
    for r in range(repeats):
        shuffled = row_numbers(rows.select("_i", *columns), [F.xxhash64(F.lit(seed + r), "_i"), F.col("_i")], "_j")
        for c in columns:
            other = shuffled.select(F.col("_j").alias("_i"), F.col(c).alias("_new"))
            mixed = rows.join(other, "_i").withColumn(c, F.col("_new")).drop("_new")
            score = model.transform(assembler.transform(mixed)).agg(hit.alias("a")).first()["a"]
            results.append((c, base - score))
    spark = df.sparkSession
    return spark.createDataFrame(results, "feature string, loss double").groupBy("feature").agg(
        F.avg("loss").alias("importance"))


def l1_rfe_select(
    df: DataFrame, columns: Sequence[str], label: str = "label", fewest: int = 2, most: int = 15,
    strength: float = 0.01,
) -> list[str]:
    """Features kept by an L1 logistic model, then by dropping the least SVM weight in turn.

    Weights are compared on the model's coefficient times the column's spread.
    """
    data = cut_lineage(df.select(F.col(label).cast("double").alias("label"), *columns))

    def weights(names, estimator):
        assembled = VectorAssembler(inputCols=list(names), outputCol="features").transform(data)
        return dict(feature_importance(estimator.fit(assembled), names))

    classes = data.select("label").distinct().count()
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=strength, maxIter=100)
    kept = [c for c, w in weights(columns, lasso).items() if w > 1e-8] or list(columns[:5])
    goal = max(fewest, min(most, len(kept)))
    while len(kept) > goal:
        svm = LinearSVC(maxIter=50, standardization=True)
        scores = weights(kept, svm if classes == 2 else LogisticRegression(maxIter=50))
        kept.remove(min(kept, key=lambda c: scores[c]))
    return [c for c in columns if c in kept]


def infer_task(df: DataFrame, label: str) -> str:
    """classification for text labels or at most two numeric values, else regression."""
    if df.schema[label].dataType.typeName() == "string":
        return "classification"
    few = df.select(label).distinct().limit(3).count() <= 2
    return "classification" if few else "regression"


def rescoring(train: DataFrame, score: DataFrame, label: str, model: str = "rf", seed: int = 42) -> DataFrame:
    """Train on (features array, label) and add ``ml_score`` to the rows to score.

    The score is the probability (or the margin) of the second class, or the prediction of a
    regression. Text labels are numbered in alphabetical order.
    """
    task = infer_task(train, label)
    if train.schema[label].dataType.typeName() == "string":
        indexer = StringIndexer(inputCol=label, outputCol="_y", stringOrderType="alphabetAsc").fit(train)
        train = indexer.transform(train).drop(label).withColumnRenamed("_y", label)
    fit_rows = train.select(array_to_vector("features").alias("features"), F.col(label).cast("double").alias("label"))
    rows = score.withColumn("_raw", F.col("features")).withColumn("features", array_to_vector("features"))
    if task == "regression":
        estimator = {
            "rf": RandomForestRegressor(numTrees=50, seed=seed), "gbm": GBTRegressor(maxIter=30, seed=seed),
        }.get(model, LinearRegression())
        value = F.col("prediction")
    else:
        width = len(fit_rows.select("features").first()[0])
        estimator = build_classifier(model, width, 2, seed)
        value = None
    predicted = estimator.fit(fit_rows).transform(rows)
    if value is None:  # machines without probabilities give their margin
        value = vector_to_array("probability" if "probability" in predicted.columns else "rawPrediction")[1]
    predicted = predicted.withColumn("ml_score", value)
    return predicted.select(*[c for c in score.columns if c != "features"], "ml_score")


def rescoring_out_of_fold(
    rows: DataFrame, label: str, key: str, splits: int = 5, model: str = "rf", seed: int = 42
) -> DataFrame:
    """``rescoring`` of labelled rows, each by a model trained on the other folds only."""
    dealt = cut_lineage(folds(rows, label, key, splits, seed))
    out = None
    for fold in range(splits):
        inside = F.col("fold") == fold
        part = rescoring(dealt.where(~inside).drop("fold"), dealt.where(inside).drop("fold", label), label, model, seed)
        out = part if out is None else out.unionByName(part)
    return out


# ---- texts -----------------------------------------------------------------------------------


@F.udf(returnType=VectorUDT())
def _damped(v):
    """1 + ln(count) on the stored entries of a count vector."""
    return SparseVector(v.size, v.indices, [1.0 + math.log(x) for x in v.values])


def relevance_text() -> Column:
    return F.concat_ws(
        " ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in
               ("disease", "research_direction", "accession", "title", "summary", "organism")])


def frequent_terms(tokens: DataFrame, most: int, min_df: int = 1) -> list[str]:
    """The ``most`` terms of the arrays ``_terms`` with the largest counts, ties in order of the term.

    Terms combine before the shuffle and the first ones are taken part by part. The outer form of explode
    lets no filter on the array's size be derived, for which each text would be cut into words again.
    """
    each = lambda terms: tokens.select(F.explode_outer(terms).alias("term")).where(F.col("term").isNotNull()).groupBy("term")
    counts = each("_terms").agg(F.count(F.lit(1)).alias("n"))
    if min_df > 1:
        within = each(F.array_distinct("_terms")).agg(F.count(F.lit(1)).alias("df"))
        counts = counts.join(within.where(F.col("df") >= min_df), "term", "left_semi")
    return [r["term"] for r in counts.orderBy(F.desc("n"), "term").limit(most).collect()]


def _fit_texts(df: DataFrame, vocabulary: int, min_df: int):
    """``text_features`` and the features of ``df`` itself, whose texts are cut into words twice in all."""
    words = Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="_tokens", pattern=r"\b\w\w+\b", gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="_tokens", outputCol="_words"),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        SQLTransformer(statement="SELECT *, concat(_words, _pairs) AS _terms FROM __THIS__"),
    ]).fit(df)
    terms = frequent_terms(words.transform(df), vocabulary, min_df)
    counter = CountVectorizerModel.from_vocabulary(terms, inputCol="_terms", outputCol="_counts")
    damp = lambda x: counter.transform(words.transform(x)).withColumn("_tf", _damped("_counts"))
    hidden = ["_tokens", "_words", "_pairs", "_terms", "_counts"]
    own = cut_lineage(damp(df).drop("text", *hidden))  # for the document frequencies and the features
    idf = IDF(inputCol="_tf", outputCol="_idf").fit(own)
    scale = Normalizer(inputCol="_idf", outputCol="features")
    weigh = lambda x: scale.transform(idf.transform(x)).drop("_tf", "_idf")
    return (lambda x: weigh(damp(x).drop(*hidden))), len(terms), weigh(own)


def text_features(df: DataFrame, vocabulary: int = 8000, min_df: int = 1):
    """Fit TF-IDF on words and word pairs of ``text``; returns a function adding ``features``.

    Counts are damped to 1 + ln(count), weighted by inverse document frequency, scaled to length 1.
    """
    return _fit_texts(df, vocabulary, min_df)[:2]


def text_relevance_train(samples: DataFrame, model: str = "lr", vocabulary: int = 8000, seed: int = 42):
    """Train a relevance model on labelled (text, label); returns a scoring function.

    The scorer adds ``ml_score``, the probability of label 1.
    """
    featurize, width, own = _fit_texts(samples, vocabulary, 1)
    fitted = build_classifier(model, width, 2, seed).fit(
        own.select("features", F.col("label").cast("double").alias("label")))

    def score(rows: DataFrame) -> DataFrame:
        scored = fitted.transform(featurize(rows))
        drop = [c for c in ("features", "rawPrediction", "probability", "prediction") if c in scored.columns]
        return scored.withColumn("ml_score", vector_to_array("probability")[1]).drop(*drop)

    return score


def text_relevance_eval(
    samples: DataFrame, key: str, model: str = "lr", splits: int = 5, vocabulary: int = 8000, seed: int = 42
) -> DataFrame:
    """Out-of-fold (key, label, prediction, score) of the relevance model.

    Word statistics come from all samples, the models only from the other folds.
    """
    fewest = samples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).first()[0]
    n = max(2, min(splits, fewest))
    _, width, own = _fit_texts(samples, vocabulary, 1)
    data = cut_lineage(own.select(key, F.col("label").cast("double").alias("label"), "features"))
    scored = cross_predict(folds(data, "label", key, n, seed), build_classifier(model, width, 2, seed), n)
    return scored.select(key, "label", "prediction", vector_to_array("probability")[1].alias("score"))


def evaluation_summary(scored: DataFrame, extra: Mapping[str, object] | None = None) -> DataFrame:
    """One row: samples, positives, accuracy, ROC-AUC, average precision."""
    base = scored.agg(
        F.count(F.lit(1)).alias("samples"), F.count_if(F.col("label") == 1).alias("positive"),
        F.round(F.avg((F.col("label") == F.col("prediction")).cast("double")), 4).alias("accuracy"))
    quality = ranking_quality(scored).select(
        F.struct(F.round("roc_auc", 4).alias("roc_auc"), F.round("average_precision", 4).alias("average_precision"))).scalar()
    out = base.withColumn("_q", quality).select("*", "_q.roc_auc", "_q.average_precision").drop("_q")
    return out.withColumns({k: F.lit(v) for k, v in (extra or {}).items()})
