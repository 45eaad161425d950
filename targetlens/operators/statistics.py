"""Statistical tests, differential expression, enrichment and correlation.

Rank tests work on value counts: cells are first collapsed to (group keys, value) with the number
of cells on each side, so ties cost nothing and zeros are added as one analytic tie block.
Formulas are the textbook ones; package-specific shrinkage is not reproduced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from targetlens.functions.columns import ratio, yes
from targetlens.functions.ordering import (
    bh_adjust, pct_rank, quantiles, row_numbers, running_totals, top_rows, value_ranks,
)
from targetlens.session import cut_lineage
from targetlens.functions.special import (
    erfc, fisher_two_sided, hypergeometric_upper_tail, normal_two_sided,
)


def chi2_2x2(a: Column, b: Column, c: Column, d: Column) -> tuple[Column, Column]:
    """Continuity-corrected chi-square of [[a, b], [c, d]] and its p-value.

    The correction is not clamped: an expected count within 0.5 of the observed one still adds.
    """
    n = a + b + c + d
    terms = []
    for cell, row, column in ((a, a + b, a + c), (b, a + b, b + d), (c, c + d, a + c), (d, c + d, b + d)):
        expected = ratio(row * column, n)
        terms.append(
            F.coalesce(ratio(F.pow(F.abs(cell - expected) - 0.5, F.lit(2.0)), expected), F.lit(0.0))
        )
    chi = F.when(n > 0, terms[0] + terms[1] + terms[2] + terms[3])
    p = F.when(chi == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), erfc(F.sqrt(chi / 2.0))))
    return chi, p


def two_conditions(cells: DataFrame) -> DataFrame:
    """One row: the two most frequent conditions (ties by name) as ``first`` and ``second``."""
    counted = cells.where(F.col("condition").isNotNull()).groupBy("condition").agg(
        F.count(F.lit(1)).alias("n")
    )
    head = top_rows(counted, [F.col("n").desc(), F.col("condition")], 2)
    pair = F.sort_array(F.collect_list("condition"))
    return head.agg(pair.alias("_p")).select(
        F.try_element_at("_p", F.lit(1)).alias("first"), F.try_element_at("_p", F.lit(2)).alias("second")
    )


def two_group_normalize(cells: DataFrame) -> DataFrame:
    """Keep tumour and normal labels when both occur, else the two most frequent conditions."""
    label = F.lower("condition")
    tumor, normal = label.contains("tumor"), label.contains("normal")
    both = cells.agg(yes(F.bool_or(tumor)) & yes(F.bool_or(normal))).scalar()
    counted = cells.groupBy("condition").agg(F.count(F.lit(1)).alias("n"))
    best = top_rows(counted, [F.col("n").desc(), F.col("condition")], 2).select(
        F.col("condition"), F.lit(True).alias("_top")
    )
    kept = F.when(both, tumor | normal).otherwise(F.coalesce("_top", F.lit(False)))
    return cells.join(best, "condition", "left").where(yes(kept)).select(*cells.columns)


def _abundance_counts(cells: DataFrame, pair: tuple[str, str] | None) -> DataFrame:
    """(celltype, a, b, total_a, total_b, first, second) for the two conditions."""
    if pair is None:
        names = two_conditions(cells).select(F.struct("first", "second")).scalar()
    else:
        names = F.struct(F.lit(pair[0]).alias("first"), F.lit(pair[1]).alias("second"))
    counted = cells.groupBy("celltype", "condition").agg(F.count(F.lit(1)).alias("n"))
    sides = (
        counted.withColumn("_p", names).groupBy("celltype")
        .agg(
            F.sum(F.when(F.col("condition") == F.col("_p.first"), F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("condition") == F.col("_p.second"), F.col("n")).otherwise(0)).alias("b"),
            F.first("_p.first").alias("first"), F.first("_p.second").alias("second"),
        )
    )
    totals = sides.agg(F.struct(F.sum("a").alias("a"), F.sum("b").alias("b"))).scalar()
    return sides.withColumn("_t", totals).select(
        "celltype", "a", "b", F.col("_t.a").alias("total_a"), F.col("_t.b").alias("total_b"),
        "first", "second",
    )


def differential_abundance(
    cells: DataFrame, pair: tuple[str, str] | None = None, min_cells: int = 5, fdr: float = 0.05
) -> DataFrame:
    """Composition shift of each cell type between two conditions."""
    table = _abundance_counts(cells, pair).where(F.col("a") + F.col("b") >= min_cells)
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    chi, p = chi2_2x2(a, F.col("total_a") - a, b, F.col("total_b") - b)
    f1, f2 = (
        F.coalesce(ratio(F.col(x), F.col(f"total_{x}")), F.lit(0.0)) for x in "ab"
    )
    tested = table.select(
        "celltype", F.col("a").alias("cells_1"), F.col("b").alias("cells_2"),
        f1.alias("fraction_1"), f2.alias("fraction_2"), (F.col("a") + F.col("b")).alias("n_cells"),
        chi.alias("chi2"), p.alias("p_value"),
        F.concat(F.lit("enriched_in_"), F.when(f1 > f2, F.col("first")).otherwise(F.col("second")))
        .alias("direction"),
    )
    return bh_adjust(tested, "p_value").withColumn("significant", F.col("p_adjust") < fdr)


def fisher_2x2(cells: DataFrame, pair: tuple[str, str] | None = None) -> DataFrame:
    """Fisher exact p, sample odds ratio and BH per cell type."""
    table = _abundance_counts(cells, pair)
    a, b, ta, tb = (F.col(c) for c in ("a", "b", "total_a", "total_b"))
    odds = ratio(a * (tb - b), b * (ta - a))
    tested = table.select(
        "celltype", F.col("a").alias("count_1"), F.col("b").alias("count_2"),
        fisher_two_sided(a, ta, a + b, ta + tb).alias("p_value"), odds.alias("odds_ratio"),
        F.when(odds > 0, F.log2(odds)).alias("log2_odds"),
    )
    return bh_adjust(tested, "p_value")


def _rank_sum(w: Column, n1: Column, n2: Column, ties: Column) -> tuple[Column, Column]:
    """Statistic and two-sided normal p with tie and 0.5 continuity correction."""
    n1, n2 = n1.cast("double"), n2.cast("double")
    n = n1 + n2
    statistic = w - n1 * (n1 + 1.0) / 2.0
    shift = statistic - n1 * n2 / 2.0
    spread = F.sqrt(n1 * n2 / 12.0 * ((n + 1.0) - F.coalesce(ratio(ties, n * (n - 1.0)), F.lit(0.0))))
    z = ratio(shift - F.signum(shift) * 0.5, spread)
    return statistic, normal_two_sided(z)


def rank_sum(df: DataFrame, value: str, first: Column, by: Sequence[str]) -> DataFrame:
    """(by, n1, n2, statistic, p_value): two-sample rank-sum test of ``first`` rows against the rest."""
    hist = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        F.count_if(first).alias("n1"), F.count_if(~first).alias("n2")
    )
    return rank_sum_of_counts(hist, value, by)


def rank_sum_of_counts(hist: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Rank-sum test from (by, value, n1, n2) counts."""
    totals = running_totals(
        hist, value, {"n": F.sum(F.col("n1") + F.col("n2")), "m1": F.sum("n1"), "m2": F.sum("n2")}, by
    )
    n = F.col("n").cast("double")
    middle = F.col("cum_n") - (n - 1.0) / 2.0
    sums = totals.groupBy(*by).agg(
        F.sum("m1").alias("n1"), F.sum("m2").alias("n2"), F.sum(F.col("m1") * middle).alias("_w"),
        F.sum(n * n * n - n).alias("_ties"),
    )
    statistic, p = _rank_sum(F.col("_w"), F.col("n1"), F.col("n2"), F.col("_ties"))
    return sums.select(*by, "n1", "n2", statistic.alias("statistic"), p.alias("p_value"))


def qc_pvalue_table(metrics: DataFrame, names: Sequence[str], stage: str = "raw") -> DataFrame:
    """Rank-sum test of every QC metric for every pair of conditions."""
    long = metrics.where(F.coalesce("condition", F.lit("")) != "").select(
        "condition",
        F.explode(
            F.array(*[
                F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x")) for m in names
            ])
        ).alias("m"),
    ).select("condition", "m.metric", "m.x")
    hist = cut_lineage(long.groupBy("metric", "condition", "x").agg(F.count(F.lit(1)).alias("n")))
    others = hist.agg(F.sort_array(F.collect_set("condition"))).scalar()
    paired = hist.withColumn("other", F.explode(others)).where("condition <> other").select(
        "metric", F.least("condition", "other").alias("group1"),
        F.greatest("condition", "other").alias("group2"), "x",
        F.when(F.col("condition") < F.col("other"), F.col("n")).otherwise(0).alias("n1"),
        F.when(F.col("condition") > F.col("other"), F.col("n")).otherwise(0).alias("n2"),
    )
    tests = rank_sum_of_counts(paired, "x", ["metric", "group1", "group2"])
    medians = quantiles(hist, "x", {"median": 0.5}, by=["metric", "condition"], weight="n")
    side = lambda i: medians.select(
        "metric", F.col("condition").alias(f"group{i}"), F.col("median").alias(f"median{i}")
    )
    joined = tests.join(side(1), ["metric", "group1"]).join(side(2), ["metric", "group2"])
    m1, m2 = F.col("median1"), F.col("median2")
    return bh_adjust(joined, "p_value", "padj").select(
        F.lit(stage).alias("stage"), "metric", "group1", "group2", "n1", "n2", "median1", "median2",
        (m2 - m1).alias("median_diff"), "statistic", "p_value", "padj",
        (-F.log10(F.greatest(F.col("p_value"), F.lit(2.2250738585072014e-308)))).alias("neg_log10_p"),
        F.when(m1 == m2, "no difference")
        .when(m2 > m1, F.concat("group2", F.lit(" higher")))
        .otherwise(F.concat("group1", F.lit(" higher"))).alias("direction"),
    )


def one_vs_rest_rank_sum(scores: DataFrame, group: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Each group against all other rows, ranks taken once over everything (per ``by``, e.g. per gene set)."""
    keys = list(by)
    counted = cut_lineage(scores.groupBy(*keys, group, value).agg(F.count(F.lit(1)).alias("k")))
    ranks = running_totals(counted, value, {"n": F.sum("k")}, keys)
    n = F.col("n").cast("double")
    ranks = ranks.select(*keys, value, (F.col("cum_n") - (n - 1.0) / 2.0).alias("_mid"), "n")
    facts = F.struct(F.sum(n * n * n - n).alias("ties"), F.sum("n").alias("n"), F.sum(F.col(value) * F.col("n")).alias("sum"))
    per = counted.join(ranks, [*keys, value]).groupBy(*keys, group).agg(
        F.sum("k").alias("n_cells"), F.sum(F.col("k") * F.col("_mid")).alias("_w"), F.sum(F.col("k") * F.col(value)).alias("_sum"))
    if keys:
        per = per.join(ranks.groupBy(*keys).agg(facts.alias("_all")), keys)
    else:
        per = per.withColumn("_all", ranks.agg(facts).scalar())
    rest = F.col("_all.n") - F.col("n_cells")
    statistic, p = _rank_sum(F.col("_w"), F.col("n_cells"), rest, F.col("_all.ties"))
    mean = F.col("_sum") / F.col("n_cells")
    other = ratio(F.col("_all.sum") - F.col("_sum"), rest)
    tested = per.select(
        *keys, group, "n_cells", mean.alias("module_mean"), other.alias("other_module_mean"),
        (mean - other).alias("module_diff"), statistic.alias("statistic"), p.alias("p_value"),
    )
    return bh_adjust(tested, "p_value", by=keys)


def group_score_summary(scores: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """Cells, mean and exact median of a score per group."""
    middle = quantiles(scores, value, {"module_median": 0.5}, by)
    return (
        scores.groupBy(*by)
        .agg(F.count(F.lit(1)).alias("n_cells"), F.avg(value).alias("module_mean"))
        .join(middle, list(by), "left")
    )


def _sparse_test(
    values: DataFrame, sides: DataFrame, by: Sequence[str], first_n: Column, all_n: Column
) -> DataFrame:
    """Rank-sum test, detection rates and log2 fold change per ``by`` key, zeros analytic.

    ``sides(cell, ..., side)`` says which cells form group 1; absent entries are zeros.
    """
    first = F.col("side") == 1
    back = F.expm1("value")
    hist = values.where(F.col("value") != 0).join(sides, "cell").groupBy(*by, "value").agg(
        F.count_if(first).alias("k1"), F.count_if(~first).alias("k2"),
        F.sum(F.when(first, back).otherwise(0.0)).alias("e1"),
        F.sum(F.when(first, F.lit(0.0)).otherwise(back)).alias("e2"),
    )
    totals = running_totals(
        hist, "value",
        {"n": F.sum(F.col("k1") + F.col("k2")), "c1": F.sum("k1"), "c2": F.sum("k2"),
         "s1": F.sum("e1"), "s2": F.sum("e2")},
        by,
    )
    n = F.col("n").cast("double")
    middle = F.col("cum_n") - (n - 1.0) / 2.0
    sums = totals.groupBy(*by).agg(
        F.sum("c1").alias("_p1"), F.sum("c2").alias("_p2"),
        F.sum("s1").alias("_s1"), F.sum("s2").alias("_s2"),
        F.sum(F.col("c1") * middle).alias("_w"), F.sum(n * n * n - n).alias("_t"),
    )
    sized = sums.withColumn("n1", first_n).withColumn("n2", all_n - F.col("n1"))
    z1 = F.col("n1") - F.col("_p1")
    zeros = (z1 + F.col("n2") - F.col("_p2")).cast("double")
    w = z1 * (zeros + 1.0) / 2.0 + F.col("_w") + zeros * F.col("_p1")
    ties = F.col("_t") + zeros * zeros * zeros - zeros
    statistic, p = _rank_sum(w, F.col("n1"), F.col("n2"), ties)
    mean = lambda s, size: F.coalesce(ratio(F.col(s), F.col(size)), F.lit(0.0))
    return sized.select(
        *by, statistic.alias("statistic"), p.alias("p_val"),
        (F.log2(mean("_s1", "n1") + 1.0) - F.log2(mean("_s2", "n2") + 1.0)).alias("avg_log2fc"),
        ratio(F.col("_p1"), F.col("n1")).alias("pct_1"), ratio(F.col("_p2"), F.col("n2")).alias("pct_2"),
    )


def de_wilcoxon(
    values: DataFrame, cells: DataFrame, pair: tuple[str, str],
    min_pct: float = 0.1, min_lfc: float = 0.25,
) -> DataFrame:
    """Two-condition test per gene on log-normalised values; Bonferroni-adjusted p.

    Genes below the detection and fold-change limits are left out; when none passes, all stay.
    Cap the cells per group beforehand with ``stratified_cap`` if wanted.
    """
    sides = cells.where(F.col("condition").isin(*pair)).select(
        "cell", F.when(F.col("condition") == pair[0], 1).otherwise(2).alias("side")
    )
    first_n = sides.agg(F.count_if(F.col("side") == 1)).scalar()
    all_n = sides.agg(F.count(F.lit(1))).scalar()
    genes = values.agg(F.countDistinct("gene")).scalar()
    tested = _sparse_test(values, sides, ["gene"], first_n, all_n).withColumn(
        "p_val_adj", F.least(F.lit(1.0), F.col("p_val") * genes)
    )
    passes = (F.greatest("pct_1", "pct_2") >= min_pct) & (F.abs("avg_log2fc") >= min_lfc)
    any_passes = tested.agg(yes(F.bool_or(passes))).scalar()
    return tested.where(passes | ~any_passes)


def de_flags(deg: DataFrame, alpha: float = 0.05, min_lfc: float = 0.25) -> DataFrame:
    """Significance, direction and -log10 of the adjusted p-value."""
    significant = yes((F.col("p_val_adj") < alpha) & (F.abs("avg_log2fc") > min_lfc))
    return deg.withColumns(
        {
            "significant": significant,
            "direction": F.when(significant & (F.col("avg_log2fc") > 0), "Up")
            .when(significant, "Down").otherwise("NS"),
            "neg_log10_padj": -F.log10(F.greatest(F.col("p_val_adj"), F.lit(1e-300))),
        }
    )


def deg_order() -> list[Column]:
    return [F.col("p_val_adj").asc_nulls_last(), F.abs("avg_log2fc").desc_nulls_last(), F.col("gene")]


def top_deg_table(deg: DataFrame, means: DataFrame, n: int = 12) -> DataFrame:
    """First significant genes (or, without any, genes with a p-value) with a printed P label."""
    any_significant = deg.agg(yes(F.bool_or("significant"))).scalar()
    usable = deg.where(
        F.when(any_significant, F.col("significant")).otherwise(F.col("p_val_adj").isNotNull())
    )
    p = F.col("p_val_adj")
    label = F.when(p < 0.001, F.format_string("%.1e", F.greatest(p, F.lit(1e-300)))).otherwise(
        F.format_string("%.3f", p)
    )
    return (
        top_rows(usable, deg_order(), n).withColumn("p_label", label)
        .join(means.select("gene", F.col("mean").alias("mean_expr")), "gene", "left")
    )


def cluster_markers(
    values: DataFrame, cells: DataFrame, group: str = "cluster",
    min_pct: float = 0.25, min_lfc: float = 0.5,
) -> DataFrame:
    """Positive markers of each cluster against the rest.

    Cells are counted per (gene, value, cluster) once; ranks are taken once per gene and shared
    by all clusters.
    """
    sized = cells.groupBy(group).agg(F.count(F.lit(1)).alias("n1"))
    all_n = cells.agg(F.count(F.lit(1))).scalar()
    counted = (
        values.where(F.col("value") != 0).join(cells.select("cell", group), "cell")
        .groupBy("gene", "value", group).agg(F.count(F.lit(1)).alias("k"))
    )
    counted = cut_lineage(counted)
    ranks = running_totals(counted, "value", {"n": F.sum("k")}, ["gene"])
    n = F.col("n").cast("double")
    ranks = ranks.select("gene", "value", (F.col("cum_n") - (n - 1.0) / 2.0).alias("_mid"), "n")
    per_gene = ranks.groupBy("gene").agg(
        F.sum("n").alias("_pos"), F.sum(n * n * n - n).alias("_t"),
        F.sum(F.expm1("value") * F.col("n")).alias("_e"),
    )
    per = counted.join(ranks, ["gene", "value"]).groupBy("gene", group).agg(
        F.sum("k").alias("_p1"), F.sum(F.col("k") * F.col("_mid")).alias("_w"),
        F.sum(F.col("k") * F.expm1("value")).alias("_e1"),
    )
    sums = (
        per.join(per_gene, "gene").join(sized, group).withColumn("_n", all_n)
        .withColumn("n2", F.col("_n") - F.col("n1"))
    )
    zeros = (F.col("_n") - F.col("_pos")).cast("double")
    w = (F.col("n1") - F.col("_p1")) * (zeros + 1.0) / 2.0 + F.col("_w") + zeros * F.col("_p1")
    statistic, p = _rank_sum(
        w, F.col("n1"), F.col("n2"), F.col("_t") + zeros * zeros * zeros - zeros
    )
    genes = values.agg(F.countDistinct("gene")).scalar()
    lfc = F.log2(F.col("_e1") / F.col("n1") + 1.0) - F.log2(
        F.coalesce(ratio(F.col("_e") - F.col("_e1"), F.col("n2")), F.lit(0.0)) + 1.0
    )
    tested = sums.select(
        group, "gene", statistic.alias("statistic"), p.alias("p_val"), lfc.alias("avg_log2fc"),
        ratio(F.col("_p1"), F.col("n1")).alias("pct_1"),
        ratio(F.col("_pos") - F.col("_p1"), F.col("n2")).alias("pct_2"),
    )
    return tested.where(
        (F.greatest("pct_1", "pct_2") >= min_pct) & (F.col("avg_log2fc") >= min_lfc)
    ).withColumn("p_val_adj", F.least(F.lit(1.0), F.col("p_val") * genes))


def size_factors(bulk: DataFrame) -> DataFrame:
    """(sample, size_factor): median over genes of the ratio to the geometric mean.

    Only genes counted in every sample take part.
    """
    n = bulk.select("sample").distinct().agg(F.count(F.lit(1))).scalar()
    logs = bulk.where(F.col("value") > 0).groupBy("gene").agg(
        F.avg(F.ln("value")).alias("_g"), F.count(F.lit(1)).alias("_k")
    ).withColumn("_n", n).where(F.col("_k") == F.col("_n"))
    ratios = bulk.join(logs, "gene").select("sample", (F.ln("value") - F.col("_g")).alias("_r"))
    return quantiles(ratios, "_r", {"_m": 0.5}, ["sample"]).select(
        "sample", F.exp("_m").alias("size_factor")
    )


def de_pseudobulk(bulk: DataFrame, conditions: DataFrame, pair: tuple[str, str]) -> DataFrame:
    """Negative-binomial Wald test on sample sums.

    Counts are divided by median-of-ratios size factors; the dispersion of a gene is the moment
    estimate (variance - mean) / mean^2, pooled over both groups and not below 0; the variance of
    each log mean is (1 / mean + dispersion) / n. No shrinkage of dispersion or fold change.
    """
    roles = conditions.where(F.col("condition").isin(*pair)).select(
        "sample", (F.col("condition") == pair[0]).alias("_one")
    )
    counted = bulk.join(roles, "sample")
    scaled = counted.join(size_factors(counted.select("gene", "sample", "value")), "sample").select(
        "gene", "_one", (F.col("value") / F.col("size_factor")).alias("q")
    )
    sizes = roles.agg(
        F.struct(F.count_if("_one").alias("n1"), F.count_if(~F.col("_one")).alias("n2"))
    ).scalar()
    part = lambda one, x: F.sum(F.when(F.col("_one") == one, x).otherwise(0.0))
    q = F.col("q")
    sums = scaled.groupBy("gene").agg(
        part(True, q).alias("_a"), part(False, q).alias("_b"),
        part(True, q * q).alias("_aa"), part(False, q * q).alias("_bb"),
    ).withColumn("_n", sizes)
    n1, n2 = F.col("_n.n1"), F.col("_n.n2")
    m1, m2 = F.col("_a") / n1, F.col("_b") / n2
    within = F.col("_aa") - F.col("_a") * m1 + F.col("_bb") - F.col("_b") * m2
    variance = ratio(within, n1 + n2 - 2)
    mean = (F.col("_a") + F.col("_b")) / (n1 + n2)
    dispersion = F.greatest(F.lit(0.0), F.coalesce(ratio(variance - mean, mean * mean), F.lit(0.0)))
    change = F.when((m1 > 0) & (m2 > 0), F.ln(m1 / m2))
    error = F.sqrt((1.0 / m1 + dispersion) / n1 + (1.0 / m2 + dispersion) / n2)
    tested = sums.select(
        "gene", mean.alias("base_mean"), dispersion.alias("dispersion"),
        (change / F.ln(F.lit(2.0))).alias("avg_log2fc"),
        F.when(change.isNotNull(), normal_two_sided(ratio(change, error))).alias("p_val"),
    )
    return bh_adjust(tested, "p_val", "p_val_adj")


def de_pseudobulk_or_cells(bulk, values, cells, pair) -> DataFrame:
    """``de_pseudobulk`` with at least 4 samples and 2 per condition, else ``de_wilcoxon``."""
    both = cells.where(F.col("condition").isin(*pair)).select("sample", "condition").distinct()
    per = both.groupBy("condition").agg(F.count(F.lit(1)).alias("n"))
    usable = per.agg(yes((F.sum("n") >= 4) & (F.min("n") >= 2) & (F.count(F.lit(1)) == 2))).first()[0]
    columns = ["gene", "avg_log2fc", "p_val", "p_val_adj"]
    if usable:
        return de_pseudobulk(bulk, both, pair).select(*columns, F.lit("samples").alias("replicates"))
    return de_wilcoxon(values, cells, pair).select(*columns, F.lit("cells").alias("replicates"))


def deg_selection(deg: DataFrame, up: bool, fewest: int = 10) -> DataFrame:
    """Significant genes of one direction; relaxed limits when there are fewer than ``fewest``."""
    sign = 1.0 if up else -1.0
    strict = yes(F.col("significant") & (sign * F.col("avg_log2fc") > 0))
    loose = yes((F.col("p_val_adj") < 0.1) & (sign * F.col("avg_log2fc") > 0.1))
    few = deg.agg(F.count_if(strict) < fewest).scalar()
    return deg.where((strict & ~few) | (loose & few))


def ora(
    selected: DataFrame, universe: DataFrame, sets: DataFrame, p_cutoff: float = 0.1,
    fewest: int = 3,
) -> DataFrame:
    """Over-representation of gene sets (set_name, gene) among the selected genes."""
    known = cut_lineage(
        sets.select("set_name", "gene").distinct()
        .join(universe.select("gene").distinct(), "gene", "left_semi")
    )
    chosen = cut_lineage(
        selected.select("gene").distinct().join(known.select("gene").distinct(), "gene", "left_semi")
    )
    population = known.select("gene").distinct().agg(F.count(F.lit(1))).scalar()
    drawn = chosen.agg(F.count(F.lit(1))).scalar()
    hits = known.join(chosen.withColumn("_in", F.lit(1)), "gene", "left").groupBy("set_name").agg(
        F.count(F.lit(1)).alias("set_size"), F.count("_in").alias("overlap")
    ).withColumns({"n_selected": drawn, "n_universe": population})
    tested = hits.where((F.col("overlap") > 0) & (F.col("n_selected") >= fewest)).withColumn(
        "p_value",
        hypergeometric_upper_tail(
            F.col("overlap"), F.col("n_selected"), F.col("set_size"), F.col("n_universe")
        ),
    )
    return bh_adjust(tested, "p_value").where(F.col("p_value") < p_cutoff)


def top_enrichment(terms: DataFrame, n: int = 5, cutoff: float = 0.05) -> DataFrame:
    return top_rows(
        terms.where(F.col("p_adjust") <= cutoff), [F.col("p_adjust"), F.col("set_name")], n
    )


def enrichment_scores(hits: DataFrame, n: Column) -> DataFrame:
    """(perm, set_name, es) from hits (perm, set_name, weight, place), places 1..n.

    The running sum only turns at hits, so its extremes are read just before and at each hit.
    """
    w = W.partitionBy("perm", "set_name")
    upto = w.orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    steps = (
        hits.withColumns(
            {"_all": F.sum("weight").over(w), "_k": F.count(F.lit(1)).over(w),
             "_cum": F.sum("weight").over(upto), "_i": F.row_number().over(upto)}
        )
        .withColumn("_n", n)
        .withColumn("_miss", (F.col("place") - F.col("_i")) / (F.col("_n") - F.col("_k")).cast("double"))
        .withColumn("_at", ratio(F.col("_cum"), F.col("_all")) - F.col("_miss"))
        .withColumn("_before", ratio(F.col("_cum") - F.col("weight"), F.col("_all")) - F.col("_miss"))
    )
    ends = steps.groupBy("perm", "set_name").agg(
        F.max("_at").alias("_hi"), F.min("_before").alias("_lo"), F.max("_k").alias("set_size")
    )
    return ends.select(
        "perm", "set_name", "set_size",
        F.when(F.col("_hi") >= -F.col("_lo"), F.col("_hi")).otherwise(F.col("_lo")).alias("es"),
    )


def gsea(
    deg: DataFrame, sets: DataFrame, permutations: int = 200, smallest: int = 10,
    largest: int = 500, seed: int = 42,
) -> DataFrame:
    """Preranked enrichment: score, permutation p and BH per gene set.

    Genes are ranked by fold change. Each permutation gives a set member the place and weight
    of another gene; places are ranks in a seeded hash order of all genes.
    """
    ranked = row_numbers(
        deg.where(F.col("avg_log2fc").isNotNull()).select("gene", "avg_log2fc"),
        [F.col("avg_log2fc").desc(), F.col("gene")], "place",
    ).select("gene", "place", F.abs("avg_log2fc").alias("weight"))
    n = ranked.agg(F.count(F.lit(1))).scalar()
    members = sets.select("set_name", "gene").distinct().join(ranked.select("gene"), "gene", "left_semi")
    sized = members.groupBy("set_name").agg(F.count(F.lit(1)).alias("_k")).where(
        F.col("_k").between(smallest, largest)
    )
    members = members.join(sized, "set_name", "left_semi")
    observed = members.join(ranked, "gene").withColumn("perm", F.lit(0))
    # A permutation shuffles gene labels: the gene at hash place i takes rank place i.
    draws = ranked.select(
        "gene", F.explode(F.sequence(F.lit(1), F.lit(permutations))).alias("perm")
    ).withColumn("_h", F.xxhash64(F.lit(seed), "perm", "gene"))
    hashed = value_ranks(draws, "_h", ["perm"]).select("perm", "_h", F.col("min_rank").alias("place"))
    places = members.join(draws, "gene").join(hashed, ["perm", "_h"]).join(
        ranked.select("place", "weight"), "place"
    )
    columns = ["perm", "set_name", "weight", "place"]
    scores = enrichment_scores(
        observed.select(*columns).unionByName(places.select(*columns)), n
    )
    actual = scores.where("perm = 0").select("set_name", "set_size", "es")
    null = scores.where("perm > 0").select("set_name", F.col("es").alias("_null"))
    same = F.signum("_null") == F.signum("es")
    tested = actual.join(null, "set_name").groupBy("set_name", "set_size", "es").agg(
        F.count_if(same).alias("_same"), F.count_if(same & (F.abs("_null") >= F.abs("es"))).alias("_more"),
        F.avg(F.when(same, F.abs("_null"))).alias("_mean"),
    ).select(
        "set_name", "set_size", "es", ratio(F.col("es"), F.col("_mean")).alias("nes"),
        ((F.col("_more") + 1) / (F.col("_same") + 1)).alias("p_value"),
    )
    return bh_adjust(tested, "p_value")


# ---- correlation over samples -------------------------------------------------------------


def _moment_columns(values: DataFrame) -> DataFrame:
    return values.groupBy("gene").agg(
        F.sum("value").alias("_sx"), F.sum(F.col("value") * F.col("value")).alias("_sxx")
    )


def pearson(n, sx, sy, sxx, syy, sxy) -> Column:
    top = n * sxy - sx * sy
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    good = (vx > 1e-9 * F.abs(n * sxx)) & (vy > 1e-9 * F.abs(n * syy))
    return F.when(good, ratio(top, F.sqrt(vx) * F.sqrt(vy)))


def correlate_with(values: DataFrame, profile: DataFrame, n: Column) -> DataFrame:
    """(gene, r): Pearson r of every gene with ``profile(sample, y)`` over n samples.

    Samples absent from either side count as zero.
    """
    y = F.col("y")
    sums = profile.agg(F.struct(F.sum(y).alias("y"), F.sum(y * y).alias("yy"))).scalar()
    cross = values.join(profile, "sample", "left").groupBy("gene").agg(
        F.sum("value").alias("_sx"), F.sum(F.col("value") * F.col("value")).alias("_sxx"),
        F.sum(F.col("value") * F.coalesce(y, F.lit(0.0))).alias("_sxy"),
    ).withColumn("_y", sums).withColumn("_n", n.cast("double"))
    return cross.select(
        "gene",
        pearson(F.col("_n"), F.col("_sx"), F.col("_y.y"), F.col("_sxx"), F.col("_y.yy"), F.col("_sxy"))
        .alias("r"),
    )


def sample_count(values: DataFrame) -> Column:
    return values.select("sample").distinct().agg(F.count(F.lit(1))).scalar()


def signature_corr(values: DataFrame, signature: Sequence[str]) -> DataFrame:
    """(gene, proliferation_correlation): r with the mean of the known signature genes."""
    n = sample_count(values)
    members = values.where(F.col("gene").isin(list(signature)))
    k = members.select("gene").distinct().agg(F.count(F.lit(1)).cast("double")).scalar()
    profile = members.groupBy("sample").agg(F.sum("value").alias("_s")).select(
        "sample", (F.col("_s") / k).alias("y")
    )
    return correlate_with(values, profile, n).select("gene", F.col("r").alias("proliferation_correlation"))


def reversal_corr(
    values: DataFrame, lfc: DataFrame, up: Sequence[str], down: Sequence[str] = ()
) -> DataFrame:
    """(gene, reversal_correlation, reversal_signal): r with the disease module without the gene.

    The module is mean(up genes) - mean(down genes). For a gene of the up set the module of the
    others follows from the sums, (sum - x) / (n_up - 1), so no gene needs its own pass.
    """
    n = sample_count(values).cast("double")
    in_up, in_down = F.col("gene").isin(list(up)), F.col("gene").isin(list(down))
    n_up = values.where(in_up).select("gene").distinct().agg(F.count(F.lit(1)).cast("double")).scalar()
    n_down = values.where(in_down).select("gene").distinct().agg(F.count(F.lit(1)).cast("double")).scalar()
    module = (
        values.where(in_up | in_down).groupBy("sample")
        .agg(
            F.sum(F.when(in_up, F.col("value")).otherwise(0.0)).alias("u"),
            F.sum(F.when(in_down, F.col("value")).otherwise(0.0)).alias("d"),
        )
        .select("sample", "u", F.coalesce(ratio(F.col("d"), n_down), F.lit(0.0)).alias("d"))
    )
    u, d, x = F.col("u"), F.col("d"), F.col("value")
    whole = module.agg(
        F.struct(
            F.sum(u).alias("u"), F.sum(d).alias("d"), F.sum(u * u).alias("uu"),
            F.sum(d * d).alias("dd"), F.sum(u * d).alias("ud"),
        )
    ).scalar()
    sums = (
        values.join(module.withColumn("_m", F.lit(1)), "sample", "left").fillna(0.0, ["u", "d"])
        .groupBy("gene")
        .agg(
            F.sum(x).alias("sx"), F.sum(x * x).alias("sxx"), F.sum(x * u).alias("sxu"),
            F.sum(x * d).alias("sxd"),
        )
        .withColumns({"_w": whole, "_n": n, "_up": n_up, "_own": F.when(in_up, 1.0).otherwise(0.0)})
    )
    own, k, w = F.col("_own"), F.col("_up") - F.col("_own"), F.col("_w")
    # y = (u - own * x) / k - d over the samples
    sy = (w["u"] - own * F.col("sx")) / k - w["d"]
    syy = (
        (w["uu"] - 2 * own * F.col("sxu") + own * F.col("sxx")) / (k * k)
        - 2.0 * (w["ud"] - own * F.col("sxd")) / k + w["dd"]
    )
    sxy = (F.col("sxu") - own * F.col("sxx")) / k - F.col("sxd")
    r = F.when(k > 0, pearson(F.col("_n"), F.col("sx"), sy, F.col("sxx"), syy, sxy))
    return sums.where(F.col("_up") > 0).select(
        "gene", F.coalesce(r, F.lit(0.0)).alias("reversal_correlation")
    ).join(lfc.select("gene", "log2fc"), "gene").select(
        "gene", "reversal_correlation",
        (F.col("log2fc") * F.col("reversal_correlation")).alias("reversal_signal"),
    )


def _variable_moments(values: DataFrame, max_genes: int | None) -> DataFrame:
    """(gene, _sx, _sxx, _n) of all genes, or of the ``max_genes`` most variable when given."""
    n = sample_count(values).cast("double")
    moments = _moment_columns(values).withColumn("_n", n)
    if max_genes is None:
        return moments
    spread = F.col("_sxx") - F.col("_sx") * F.col("_sx") / F.col("_n")
    return top_rows(moments.withColumn("_var", spread), [F.col("_var").desc(), F.col("gene")], max_genes).drop("_var")


def pathway_corr(values: DataFrame, pathway: Sequence[str], max_genes: int | None = None) -> DataFrame:
    """(gene, pathway_control): mean |r| with the pathway genes.

    Every measurement meets at most the pathway genes of its sample, a list given by parameter.
    With ``max_genes`` only the most variable genes count and the others get 0.
    """
    top = _variable_moments(values, max_genes)
    chosen = values if max_genes is None else values.join(top.select("gene"), "gene", "left_semi")
    mine = chosen.where(F.col("gene").isin(list(pathway))).select(
        F.col("gene").alias("pg"), "sample", F.col("value").alias("y")
    )
    k = top.where(F.col("gene").isin(list(pathway))).agg(F.count(F.lit(1)).cast("double")).scalar()
    cross = chosen.join(mine, "sample").groupBy("gene", "pg").agg(
        F.sum(F.col("value") * F.col("y")).alias("_sxy")
    )
    other = top.select(
        F.col("gene").alias("pg"), F.col("_sx").alias("_sy"), F.col("_sxx").alias("_syy")
    )
    r = pearson(F.col("_n"), F.col("_sx"), F.col("_sy"), F.col("_sxx"), F.col("_syy"), F.col("_sxy"))
    control = (
        cross.join(top, "gene").join(other, "pg").groupBy("gene")
        .agg(F.sum(F.coalesce(F.abs(r), F.lit(0.0))).alias("_r"))
        .select("gene", (F.col("_r") / k).alias("pathway_control"))
    )
    return values.select("gene").distinct().join(control, "gene", "left").fillna(
        0.0, ["pathway_control"]
    )


#: Entries of one gene block; the number of blocks grows with the table, their size does not.
BLOCK_ENTRIES = 1_000_000
#: Cells of one dense slice of a block.
SLICE_CELLS = 4_000_000


def _block_strength(cutoff: float):
    """Per gene of two gene blocks: how many genes of the other block it goes with, and its sum of |r|."""

    def strength(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        n = float(part["n"].iloc[0])
        sides = []
        for block in key:
            rows = part[part["block"] == block]
            if rows.empty:
                return pd.DataFrame({"gene": [], "linked": [], "total": []})
            genes, g = np.unique(rows["gene"].to_numpy(dtype=object), return_inverse=True)
            sides.append((genes, g, rows["sample_no"].to_numpy(), rows["value"].to_numpy()))
        samples, cells = part["sample_no"].unique(), max(len(sides[0][0]), len(sides[1][0]))
        samples.sort()
        step = max(1, SLICE_CELLS // cells)
        cross = np.zeros((len(sides[0][0]), len(sides[1][0])))
        for at in range(0, len(samples), step):
            low, high = samples[at], samples[min(at + step, len(samples)) - 1]
            grids = []
            for genes, g, s, v in sides:
                inside = (s >= low) & (s <= high)
                grid = np.zeros((len(genes), min(step, len(samples) - at)))
                grid[g[inside], np.searchsorted(samples[at:at + step], s[inside])] = v[inside]
                grids.append(grid)
            cross += grids[0] @ grids[1].T
        sums = [(np.bincount(g, v, len(genes)), np.bincount(g, v * v, len(genes))) for genes, g, _, v in sides]
        spread = [n * xx - x * x for x, xx in sums]
        flat = [d <= 1e-9 * np.abs(n * xx) for d, (_, xx) in zip(spread, sums)]
        scale = [np.where(f, np.inf, np.sqrt(np.maximum(d, 0))) for f, d in zip(flat, spread)]
        r = np.abs((n * cross - np.outer(sums[0][0], sums[1][0])) / np.outer(scale[0], scale[1]))
        alone = key[0] == key[1]
        if alone:
            np.fill_diagonal(r, 0.0)
        out = [pd.DataFrame({"gene": sides[0][0], "linked": (r >= cutoff).sum(axis=1), "total": r.sum(axis=1)})]
        if not alone:
            out.append(pd.DataFrame({"gene": sides[1][0], "linked": (r >= cutoff).sum(axis=0), "total": r.sum(axis=0)}))
        return pd.concat(out)

    return strength


def coexpression_degree(
    values: DataFrame, max_genes: int | None = None, cutoff: float = 0.7
) -> DataFrame:
    """(gene, hub_degree): number of genes with |r| >= cutoff.

    Without any such pair the mean |r| is used. Genes are dealt to blocks of bounded size and each
    pair of blocks is one task; only the row sums of its part of the matrix leave it, so neither
    gene pairs nor the matrix are ever written. With ``max_genes`` only the most variable genes
    count and the others get 0.
    """
    top = _variable_moments(values, max_genes).select("gene", "_n")
    chosen = cut_lineage(values.join(top, "gene").select("gene", "sample", "value", F.col("_n").alias("n")))
    numbered = row_numbers(chosen.select("sample").distinct(), [F.col("sample")], "sample_no")
    blocks = max(1, -(-chosen.count() // BLOCK_ENTRIES))
    own = F.pmod(F.xxhash64("gene"), F.lit(blocks))
    others = F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda o: F.struct(
        F.least(F.col("block"), o).alias("low"), F.greatest(F.col("block"), o).alias("high")))
    dealt = chosen.join(numbered, "sample").select(
        "gene", "sample_no", F.col("value").cast("double").alias("value"), "n", own.cast("int").alias("block")
    ).withColumn("pair", F.explode(others)).select("*", "pair.low", "pair.high").drop("pair")
    parts = dealt.groupBy("low", "high").applyInPandas(_block_strength(cutoff), "gene string, linked long, total double")
    sums = cut_lineage(parts.groupBy("gene").agg(
        F.sum("linked").cast("double").alias("linked"), F.sum("total").alias("total")))
    most = sums.agg(F.coalesce(F.max("linked"), F.lit(0.0))).scalar()
    genes = sums.agg(F.count(F.lit(1))).scalar()
    found = sums.withColumns({"_most": most, "_genes": genes}).select(
        "gene", F.when(F.col("_most") > 0, F.col("linked")).otherwise(F.col("total") / F.col("_genes")).alias("hub_degree"))
    return values.select("gene").distinct().join(found, "gene", "left").fillna(0.0, ["hub_degree"])



def cox_median_split(
    expression: DataFrame, survival: DataFrame, rounds: int = 25,
    fewest_rows: int = 20, fewest_events: int = 5,
) -> DataFrame:
    """(gene, hr): hazard ratio of samples above the gene's median, Breslow ties, 1.0 when too few.

    The covariate is binary, so a gene is summarised by counts per distinct time: events in each
    arm and samples still at risk (t_j >= t). Each Newton step is one aggregation of those counts,
    with the coefficient kept in [-3, 3]. ``survival(sample, months, status)``.
    """
    usable = survival.where((F.col("months") > 0) & F.col("status").isNotNull())
    # read for the medians, the risk sets and the sizes: written once, with no more than they need
    joined = cut_lineage(
        expression.join(usable, "sample").where(F.col("value").isNotNull()).select("gene", "months", "status", "value"))
    middle = quantiles(joined, "value", {"_median": 0.5}, ["gene"])
    armed = joined.join(middle, "gene").select(
        "gene", "months", "status", (F.col("value") > F.col("_median")).alias("_high")
    )
    one = F.when(F.col("_high"), 1).otherwise(0)
    event = F.when(F.col("status") > 0, 1).otherwise(0)
    risk = running_totals(
        armed, "months",
        {"r1": F.sum(one), "r0": F.sum(1 - one), "d1": F.sum(one * event), "d0": F.sum((1 - one) * event)},
        ["gene"], descending=True,
    )
    terms = cut_lineage(
        risk.where(F.col("d1") + F.col("d0") > 0).select(
            "gene", F.col("d1").cast("double").alias("d1"),
            (F.col("d1") + F.col("d0")).cast("double").alias("d"),
            F.col("cum_r1").cast("double").alias("n1"), F.col("cum_r0").cast("double").alias("n0"),
        )
    )
    sizes = armed.groupBy("gene").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(event).alias("_events")
    )
    inside = lambda x, reach: F.greatest(F.lit(-reach), F.least(F.lit(reach), x))
    beta = terms.select("gene", F.lit(0.0).alias("beta")).distinct()
    share = F.col("n1") * F.exp("beta") / (F.col("n1") * F.exp("beta") + F.col("n0"))
    for _ in range(rounds):
        slopes = terms.join(beta, "gene").groupBy("gene", "beta").agg(
            F.sum(F.col("d1") - F.col("d") * share).alias("_g"),
            F.sum(F.col("d") * share * (1.0 - share)).alias("_h"),
        )
        step = inside(F.coalesce(ratio(F.col("_g"), F.col("_h")), F.lit(0.0)), 1.0)
        moved = cut_lineage(
            slopes.select("gene", inside(F.col("beta") + step, 3.0).alias("beta"), F.col("beta").alias("_old"))
        )
        beta = moved.select("gene", "beta")
        if (moved.agg(F.max(F.abs(F.col("beta") - F.col("_old")))).first()[0] or 0.0) < 1e-9:
            break
    enough = (F.col("_rows") >= fewest_rows) & (F.col("_events") >= fewest_events)
    return sizes.join(beta, "gene", "left").select(
        "gene", F.when(enough, F.exp(F.coalesce("beta", F.lit(0.0)))).otherwise(1.0).alias("hr")
    )


def as_scores(df: DataFrame, value: str, name: str) -> DataFrame:
    """Percentile-rank score of a value column, missing values counting as 0 correlation."""
    return pct_rank(df.fillna(0.0, [value]), value, name)


def count_flags(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    return df.agg(*[F.count_if(c).alias(n) for n, c in flags.items()])
