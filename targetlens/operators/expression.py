"""Operators on long expression tables (gene, cell, value); an absent row means zero."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from targetlens.functions.columns import number, ratio
from targetlens.functions.ordering import quantiles, row_numbers, top_rows, value_ranks
from targetlens.session import cut_lineage

# Marker genes per cell type, in annotation order.
CELL_TYPE_MARKERS = {
    "T_NK": ["CD3D", "CD3E", "CD8A", "NKG7", "GNLY", "CD4"],
    "B": ["CD79A", "MS4A1", "CD19", "IGHG1"],
    "Myeloid": ["LYZ", "CD68", "C1QA", "C1QB", "FCGR3A"],
    "Hepatocyte": ["ALB", "APOA1", "APOA2", "FGB", "SERPINA1"],
    "Cholangiocyte": ["KRT19", "KRT7", "EPCAM", "SOX9", "CFTR"],
    "Hepatic_stellate": ["COL1A1", "COL1A2", "ACTA2", "RGS5", "PDGFRB"],
    "Endothelial": ["PECAM1", "VWF", "CLDN5", "PLVAP"],
    "Fibroblast": ["COL1A1", "COL1A2", "DCN", "LUM", "PDGFRB"],
    "Malignant": ["EPCAM", "KRT8", "KRT18", "KRT19", "AFP", "GPC3"],
    "Mast": ["TPSAB1", "CPA3", "MS4A2"],
}


def gene_sets(spark, sets: Mapping[str, Sequence[str]]) -> DataFrame:
    """(set_name, set_pos, gene) from a named-list parameter."""
    rows = [(n, i, g) for i, (n, genes) in enumerate(sets.items()) for g in dict.fromkeys(genes)]
    return spark.createDataFrame(rows, "set_name string, set_pos int, gene string")


def wide_to_long(wide: DataFrame, gene: str | None = None) -> DataFrame:
    """(gene, sample, value) from a gene x sample table: numeric, all-null genes dropped, gaps 0."""
    key = gene or wide.columns[0]
    names = [c for c in wide.columns if c != key]
    text = wide.select(
        F.col(f"`{key}`").cast("string").alias("gene"),
        *[F.col(f"`{c}`").cast("string").alias(c) for c in names],
    )
    present = F.coalesce(*[number(F.col(f"`{c}`")) for c in names]).isNotNull()
    long = text.where(present).unpivot("gene", [f"`{c}`" for c in names], "sample", "value")
    return long.select("gene", "sample", F.coalesce(number("value"), F.lit(0.0)).alias("value"))


def long_to_matrix(long: DataFrame) -> DataFrame:
    """Average duplicate (gene, sample) measurements."""
    return long.groupBy("gene", "sample").agg(F.avg("value").alias("value"))


def long_metadata(long: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Distinct sample rows with their group (and extra columns) from a long table."""
    return (
        long.select("sample", "condition", *extra).dropna(subset=["sample", "condition"]).distinct()
    )


def log_normalize(counts: DataFrame, scale: float = 1e4) -> DataFrame:
    """ln(1 + scale * x / cell total)."""
    cell_total = F.sum("value").over(W.partitionBy("cell"))
    return counts.withColumn("value", F.log1p(scale * ratio(F.col("value"), cell_total)))


def log2_transform(expression: DataFrame) -> DataFrame:
    return expression.withColumn("value", F.log2(F.col("value") + 1.0))


def group_means_lfc(
    expression: DataFrame, roles: DataFrame | None, normalise: bool = True
) -> DataFrame:
    """Mean log2(x + 1) per gene in the case and normal samples and their difference.

    ``roles(sample, role)`` labels samples "case" or "normal"; without roles the overall mean
    is the statistic. Absent rows count as zero.
    """
    values = log2_transform(expression) if normalise else expression
    if roles is None:
        n = values.select("sample").distinct().agg(F.count(F.lit(1))).scalar()
        return values.groupBy("gene").agg(F.sum("value").alias("_s")).select(
            "gene", (F.col("_s") / n).alias("expression")
        )
    sizes = roles.agg(
        F.struct(
            F.count_if(F.col("role") == "case").alias("case"),
            F.count_if(F.col("role") == "normal").alias("normal"),
        )
    ).scalar()
    side = lambda r: F.sum(F.when(F.col("role") == r, F.col("value")).otherwise(0.0))
    sums = values.join(roles, "sample", "left").groupBy("gene").agg(
        side("case").alias("_case"), side("normal").alias("_normal")
    )
    return (
        sums.withColumn("_n", sizes)
        .select(
            "gene", ratio(F.col("_case"), F.col("_n.case")).alias("case_mean"),
            ratio(F.col("_normal"), F.col("_n.normal")).alias("normal_mean"),
        )
        .withColumn("log2fc", F.col("case_mean") - F.col("normal_mean"))
    )


def pseudobulk_sum(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """(gene, sample, condition, value): summed counts per sample and condition."""
    return (
        counts.join(cells.select("cell", "sample", "condition"), "cell")
        .groupBy("gene", "sample", "condition").agg(F.sum("value").alias("value"))
    )


def pseudobulk_usable(cells: DataFrame) -> DataFrame:
    """One row: whether there are >= 4 samples and >= 2 samples in every condition."""
    per = (
        cells.select("sample", "condition").distinct().groupBy("condition")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per.agg(
        F.sum("n").alias("n_samples"), F.min("n").alias("fewest"),
        ((F.sum("n") >= 4) & (F.min("n") >= 2)).alias("usable"),
    )


def pseudobulk_mean(counts: DataFrame, cells: DataFrame) -> DataFrame:
    """Summed counts per sample and condition divided by the number of cells there."""
    sizes = cells.groupBy("sample", "condition").agg(F.count(F.lit(1)).alias("n_cells"))
    return (
        pseudobulk_sum(counts, cells).join(sizes, ["sample", "condition"])
        .select("gene", "sample", "condition", (F.col("value") / F.col("n_cells")).alias("value"))
    )


def group_profile(cells: DataFrame) -> DataFrame:
    """Per sample and condition: number of cells and dominant cell type (first label on ties)."""
    counted = cells.groupBy("sample", "condition", "celltype").agg(F.count(F.lit(1)).alias("n"))
    first = F.struct((-F.col("n")).alias("n"), F.col("celltype").alias("label"))
    return counted.groupBy("sample", "condition").agg(
        F.sum("n").alias("n_cells"), F.min(first)["label"].alias("cell_type")
    )


def majority_label(df: DataFrame, group: str, label: str) -> DataFrame:
    """Most frequent label per group; ties go to the first label."""
    counted = df.groupBy(group, label).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("n"), F.col(label).alias("label")))
    return counted.groupBy(group).agg(first["label"].alias("majority"))


def type_means(values: DataFrame, cells: DataFrame, group: str = "celltype") -> DataFrame:
    """(gene, group, mean, share_expressing) over all cells of the group, zeros included."""
    sizes = cells.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    sums = (
        values.join(cells.select("cell", group), "cell").groupBy("gene", group)
        .agg(F.sum("value").alias("_s"), F.count_if(F.col("value") > 0).alias("_pos"))
    )
    return sums.join(sizes, group).select(
        "gene", group, (F.col("_s") / F.col("_n")).alias("mean"),
        (F.col("_pos") / F.col("_n")).alias("share_expressing"),
    )


def expr_dot_summary(values: DataFrame, cells: DataFrame, group: str = "celltype") -> DataFrame:
    """Mean expression and percentage of expressing cells per gene and group."""
    return type_means(values, cells, group).select(
        "gene", group, "mean", (100.0 * F.col("share_expressing")).alias("percent")
    )


def expression_specificity(means: DataFrame, group: str = "celltype") -> DataFrame:
    """(gene, specificity): 1 - entropy / log2(k) of the mean expression over the k groups."""
    k = means.select(group).distinct().agg(F.count(F.lit(1)).cast("double")).scalar()
    totals = means.groupBy("gene").agg(F.sum("mean").alias("_all"))
    share = F.greatest(F.lit(1e-12), ratio(F.col("mean"), F.col("_all")))
    parts = means.join(totals, "gene").groupBy("gene").agg(
        (-F.sum(share * F.log2(share))).alias("_h"), F.count(F.lit(1)).alias("_groups"),
        F.max("_all").alias("_all"),
    )
    # Groups without a row are zero shares, clipped like the others.
    tiny = 1e-12
    absent = (F.col("_k") - F.col("_groups")) * F.lit(-tiny) * F.log2(F.lit(tiny))
    value = 1.0 - (F.col("_h") + absent) / F.log2("_k")
    return parts.withColumn("_k", k).select(
        "gene",
        F.when(F.col("_all") == 0, 1.0)
        .otherwise(F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), F.lit(0.5)))
        .alias("specificity"),
    )


def detection_and_top_type(
    values: DataFrame, cells: DataFrame, manifest: DataFrame, group: str = "celltype"
) -> DataFrame:
    """Per gene of ``manifest(gene, feedback_score)``: detection rate, specificity, top group and
    the combined cell support."""
    wanted = values.join(manifest.select("gene"), "gene", "left_semi")
    n = cells.agg(F.count(F.lit(1))).scalar()
    detected = wanted.groupBy("gene").agg(F.count_if(F.col("value") > 0).alias("_d"))
    means = type_means(wanted, cells, group)
    top = means.groupBy("gene").agg(
        F.min(F.struct((-F.col("mean")).alias("m"), F.col(group).alias("g")))["g"].alias("top_type")
    )
    specific = F.coalesce(F.col("specificity"), F.lit(0.5))
    return (
        manifest.join(detected, "gene").join(expression_specificity(means, group), "gene")
        .join(top, "gene")
        .select(
            *manifest.columns, (F.col("_d") / n).alias("detection_rate"),
            specific.alias("specificity"), "top_type",
            F.least(
                F.lit(1.0), 0.7 * F.coalesce(F.col("feedback_score"), F.lit(0.5)) + 0.3 * specific
            ).alias("cell_support"),
        )
    )


def gene_moments(values: DataFrame, n_cells: Column, key: str = "gene") -> DataFrame:
    """(gene, mean, variance) with absent rows as zeros; sample variance (n - 1)."""
    return (
        values.groupBy(key)
        .agg(F.sum("value").alias("_s"), F.sum(F.col("value") * F.col("value")).alias("_ss"))
        .withColumn("_n", n_cells.cast("double"))
        .select(
            key, (F.col("_s") / F.col("_n")).alias("mean"),
            F.greatest(
                F.lit(0.0),
                ratio(F.col("_ss") - F.col("_s") * F.col("_s") / F.col("_n"), F.col("_n") - 1.0),
            ).alias("variance"),
        )
    )


def top_variance(values: DataFrame, n_cells: Column, k: int = 2000) -> DataFrame:
    """The k genes of largest variance."""
    return top_rows(gene_moments(values, n_cells), [F.col("variance").desc(), F.col("gene")], k)


def variable_genes(values: DataFrame, n_cells: Column, k: int = 2000, bins: int = 20) -> DataFrame:
    """Top genes by variance standardised within bins of similar mean.

    Each gene's log variance is compared with the mean and standard deviation of the log
    variances in its mean-rank bin.
    """
    moments = cut_lineage(gene_moments(values, n_cells).where(F.col("variance") > 0))
    ranks = value_ranks(moments, "mean").select(
        "mean", F.floor((F.col("min_rank") - 1) * bins / F.col("n_all")).cast("int").alias("bin")
    )
    binned = moments.join(ranks, "mean").withColumn("_lv", F.ln("variance"))
    fit = binned.groupBy("bin").agg(
        F.avg("_lv").alias("_mu"), F.stddev_samp("_lv").alias("_sd")
    )
    scored = binned.join(fit, "bin").select(
        "gene", "mean", "variance", "bin",
        F.coalesce(ratio(F.col("_lv") - F.col("_mu"), F.col("_sd")), F.lit(0.0)).alias("standardized"),
    )
    return top_rows(scored, [F.col("standardized").desc(), F.col("gene")], k)


def scale_genes(values: DataFrame, n_cells: Column) -> DataFrame:
    """z scores of the present entries and ``z_zero``, the score every absent entry has."""
    moments = gene_moments(values, n_cells)
    sd = F.sqrt("variance")
    z = lambda x: F.coalesce(ratio(x - F.col("mean"), sd), F.lit(0.0))
    return values.join(moments, "gene").select(
        *[c for c in values.columns if c != "value"], z(F.col("value")).alias("z"),
        z(F.lit(0.0)).alias("z_zero"),
    )


def marker_annotation(values: DataFrame, markers: DataFrame, cells: DataFrame) -> DataFrame:
    """(cell, label, score): marker set of the highest mean expression, first set on ties.

    Genes of a set that occur nowhere in ``values`` are left out; cells without any marker get
    the first set with score 0.
    """
    known = markers.join(values.select("gene").distinct(), "gene", "left_semi")
    sizes = known.groupBy("set_name", "set_pos").agg(F.count(F.lit(1)).alias("_size"))
    scored = (
        values.join(known, "gene").groupBy("cell", "set_name").agg(F.sum("value").alias("_s"))
        .join(sizes, "set_name")
        .select("cell", "set_name", "set_pos", (F.col("_s") / F.col("_size")).alias("score"))
    )
    best = scored.groupBy("cell").agg(
        F.min(F.struct((-F.col("score")).alias("m"), "set_pos", "set_name")).alias("_b")
    )
    fallback = sizes.agg(F.min(F.struct("set_pos", "set_name"))["set_name"]).scalar()
    positive = F.coalesce(-F.col("_b.m") > 0, F.lit(False))
    return cells.select("cell").join(best, "cell", "left").select(
        "cell", F.when(positive, F.col("_b.set_name")).otherwise(fallback).alias("label"),
        F.when(positive, -F.col("_b.m")).otherwise(0.0).alias("score"),
    )


def module_score(
    values: DataFrame, sets: DataFrame, cells: DataFrame, controls: int = 50, bins: int = 24
) -> DataFrame:
    """(cell, set_name, score): set mean minus the mean of expression-matched control genes.

    Genes are binned by mean expression; each bin that holds a set gene gives its first
    ``controls`` genes by hash as controls. Sets with fewer than three known genes are skipped.
    """
    n = cells.agg(F.count(F.lit(1))).scalar()
    means = cut_lineage(
        values.groupBy("gene").agg((F.sum("value")).alias("_s")).withColumn("mean", F.col("_s") / n)
    )
    ranks = value_ranks(means, "mean").select(
        "mean", F.floor((F.col("min_rank") - 1) * bins / F.col("n_all")).cast("int").alias("bin")
    )
    binned = cut_lineage(means.join(ranks, "mean").select("gene", "bin"))
    hashed = W.partitionBy("bin").orderBy(F.md5("gene"), "gene")
    pool = binned.withColumn("_r", F.row_number().over(hashed)).where(F.col("_r") <= controls)
    known = sets.join(binned, "gene")
    enough = known.groupBy("set_name").agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") >= 3)
    known = known.join(enough, "set_name", "left_semi")
    control = known.select("set_name", "bin").distinct().join(pool, "bin").select("set_name", "gene")
    roles = known.select("set_name", "gene", F.lit(1).alias("in_set")).unionByName(
        control.withColumn("in_set", F.lit(0))
    )
    sizes = roles.groupBy("set_name").agg(
        F.sum("in_set").alias("_in"), F.sum(1 - F.col("in_set")).alias("_out")
    )
    side = lambda x: F.sum(F.when(F.col("in_set") == x, F.col("value")).otherwise(0.0))
    sums = (
        values.join(roles, "gene").groupBy("cell", "set_name")
        .agg(side(1).alias("_a"), side(0).alias("_b")).join(sizes, "set_name")
        .select(
            "cell", "set_name",
            (F.col("_a") / F.col("_in") - F.col("_b") / F.col("_out")).alias("score"),
        )
    )
    names = F.explode(sizes.agg(F.sort_array(F.collect_set("set_name"))).scalar())  # few set names
    grid = cells.select("cell", names.alias("set_name"))
    return grid.join(sums, ["cell", "set_name"], "left").fillna(0.0, ["score"])


def cell_cycle_phase(
    values: DataFrame, s_genes: DataFrame, g2m_genes: DataFrame, cells: DataFrame, fewest: int = 5
) -> DataFrame:
    """(cell, s_score, g2m_score, phase); the phase is G1 when neither score is positive.

    Both sets need ``fewest`` genes that are measured; otherwise, and where a score is missing, the
    phase is NULL.
    """
    sets = s_genes.select(F.lit("S").alias("set_name"), "gene").unionByName(
        g2m_genes.select(F.lit("G2M").alias("set_name"), "gene")
    )
    wide = module_score(values, sets, cells).groupBy("cell").agg(
        F.max(F.when(F.col("set_name") == "S", F.col("score"))).alias("s_score"),
        F.max(F.when(F.col("set_name") == "G2M", F.col("score"))).alias("g2m_score"),
    )
    measured = sets.join(values.select("gene").distinct(), "gene", "left_semi")
    usable = measured.groupBy("set_name").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.when(F.col("n") >= fewest, 1))).scalar()
    s, g = F.col("s_score"), F.col("g2m_score")
    phase = F.when((s <= 0) & (g <= 0), "G1").when(s >= g, "S").when(s < g, "G2M")
    return wide.withColumn("_usable", usable).withColumn("phase", F.when(F.col("_usable") == 2, phase)).drop("_usable")


def regress_out(values: DataFrame, covariates: DataFrame, n_cells: Column, x1: str, x2: str) -> DataFrame:
    """Residuals of the present entries after a two-variable least-squares fit per gene.

    Sums over absent entries come from the covariate totals, so zeros are never written out;
    ``fit_zero`` style residuals of absent entries follow from the returned coefficients.
    """
    a, c, v = F.col(x1), F.col(x2), F.col("value")
    whole = covariates.agg(
        F.struct(
            F.sum(a).alias("a"), F.sum(c).alias("c"), F.sum(a * a).alias("aa"),
            F.sum(c * c).alias("cc"), F.sum(a * c).alias("ac"),
        )
    ).scalar()
    joined = values.join(covariates.select("cell", x1, x2), "cell")
    sums = joined.groupBy("gene").agg(
        F.sum(v).alias("_v"), F.sum(v * a).alias("_va"), F.sum(v * c).alias("_vc")
    ).withColumn("_w", whole).withColumn("_n", n_cells.cast("double"))
    n = F.col("_n")
    saa = F.col("_w.aa") - F.col("_w.a") * F.col("_w.a") / n
    scc = F.col("_w.cc") - F.col("_w.c") * F.col("_w.c") / n
    sac = F.col("_w.ac") - F.col("_w.a") * F.col("_w.c") / n
    sva = F.col("_va") - F.col("_v") * F.col("_w.a") / n
    svc = F.col("_vc") - F.col("_v") * F.col("_w.c") / n
    det = saa * scc - sac * sac
    fits = sums.select(
        "gene", F.coalesce(ratio(sva * scc - svc * sac, det), F.lit(0.0)).alias("b1"),
        F.coalesce(ratio(svc * saa - sva * sac, det), F.lit(0.0)).alias("b2"),
        (F.col("_v") / n).alias("_mv"), (F.col("_w.a") / n).alias("_ma"), (F.col("_w.c") / n).alias("_mc"),
    )
    b0 = F.col("_mv") - F.col("b1") * F.col("_ma") - F.col("b2") * F.col("_mc")
    return joined.join(fits, "gene").select(
        "gene", "cell", (v - b0 - F.col("b1") * a - F.col("b2") * c).alias("residual"),
        b0.alias("b0"), "b1", "b2",
    )


def sliding_windows(
    scores: DataFrame, positions: DataFrame, cells: DataFrame, width: int = 100, step: int = 25
) -> DataFrame:
    """(cell, window, score): mean over windows of genes in genome order, absent entries included.

    ``positions(gene, pos)`` holds 1-based positions; ``scores(gene, cell, z, z_zero)`` comes
    from ``scale_genes``. The window total of a cell is the total of the zero scores plus the
    differences of its present entries.
    """
    last = positions.agg(F.max("pos")).scalar()
    starts = positions.withColumn("_last", last).select(
        "gene", "pos",
        F.explode(
            F.sequence(
                F.greatest(F.lit(0), F.ceil((F.col("pos") - width) / float(step))).cast("int"),
                F.least(
                    F.floor((F.col("pos") - 1) / float(step)),
                    F.greatest(F.lit(0), F.floor((F.col("_last") - width // 2) / float(step))),
                ).cast("int"),
            )
        ).alias("window"),
    ).where(
        (F.col("pos") > F.col("window") * step) & (F.col("pos") <= F.col("window") * step + width)
    )
    zero = scores.select("gene", "z_zero").distinct()
    base = starts.join(zero, "gene", "left").groupBy("window").agg(
        F.sum(F.coalesce("z_zero", F.lit(0.0))).alias("_base"), F.count(F.lit(1)).alias("_n")
    )
    present = (
        scores.join(starts, "gene").groupBy("cell", "window")
        .agg(F.sum(F.col("z") - F.col("z_zero")).alias("_d"))
    )
    windows = base.agg(F.sort_array(F.collect_set("window"))).scalar()  # genes / step numbers
    grid = cells.select("cell", F.explode(windows).alias("window"))
    return grid.join(present, ["cell", "window"], "left").join(base, "window").select(
        "cell", "window",
        ((F.coalesce("_d", F.lit(0.0)) + F.col("_base")) / F.col("_n")).alias("score"),
    )


def inferred_cnv(windows: DataFrame) -> DataFrame:
    """Subtract each window's median over the cells."""
    windows = cut_lineage(windows)
    middle = quantiles(windows, "score", {"_median": 0.5}, by=["window"])
    return windows.join(middle, "window").select(
        "cell", "window", (F.col("score") - F.col("_median")).alias("score")
    )


def genome_positions(genes: DataFrame) -> DataFrame:
    """(gene, pos): 1-based order of genes by (chromosome, start, gene)."""
    order = [F.col(c) for c in genes.columns if c != "gene"] + [F.col("gene")]
    return row_numbers(genes, order, "pos").select("gene", "pos")


def stratified_cap(cells: DataFrame, group: str, n: int, seed: int = 42, key: str = "cell") -> DataFrame:
    """At most ``n`` cells of each group, chosen by a seeded hash (the smallest MD5 of ``seed:key``).

    Every group is first spread over salts that each keep at most ``n`` cells, so a group of any
    size is cut down in parallel before its survivors meet.
    """
    mark = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary"))
    salted = cells.withColumn("_h", mark).withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1024)))
    first = W.partitionBy(group, "_salt").orderBy("_h", key)
    kept = salted.withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= n)
    last = W.partitionBy(group).orderBy("_h", key)
    return (
        kept.withColumn("_r", F.row_number().over(last)).where(F.col("_r") <= n)
        .drop("_h", "_salt", "_r")
    )


def stride_sample(samples: DataFrame, order: Sequence[Column], cap: int) -> DataFrame:
    """Every k-th row, k = n // cap, then at most ``cap`` rows; all rows when n <= cap."""
    n = samples.agg(F.count(F.lit(1))).scalar()
    numbered = row_numbers(samples, order, "_i").withColumn("_n", n)
    step = F.greatest(F.lit(1), F.floor(F.col("_n") / cap))
    return numbered.where(
        (F.pmod(F.col("_i") - 1, step) == 0) & (F.floor((F.col("_i") - 1) / step) < cap)
    ).drop("_i", "_n")


def top_k_per_group(df: DataFrame, group: str, order: Column, k: int) -> DataFrame:
    """Rows within the first ``k`` ranks of their group, ties included."""
    place = W.partitionBy(group).orderBy(order)
    return df.withColumn("_r", F.rank().over(place)).where(F.col("_r") <= k).drop("_r")


def cell_communication(
    means: DataFrame, pairs: DataFrame, sizes: DataFrame, half: float = 0.5, min_cells: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """(sender, receiver, n_pairs, weight) from ligand-receptor pairs.

    Mass action on the type means: L * R / (half + L * R), for cell types of at least
    ``min_cells`` cells. ``means(gene, celltype, mean)``, ``pairs(ligand, receptor)``; columns ``by`` of
    the pairs, e.g. a set name, keep sums apart.
    """
    big = sizes.where(F.col("n") >= min_cells).select("celltype")
    usable = means.join(big, "celltype", "left_semi").where(F.col("mean") > 0)
    sent = usable.select(
        F.col("gene").alias("ligand"), F.col("celltype").alias("sender"), F.col("mean").alias("_l")
    )
    received = usable.select(
        F.col("gene").alias("receptor"), F.col("celltype").alias("receiver"), F.col("mean").alias("_r")
    )
    force = F.col("_l") * F.col("_r")
    return (
        pairs.join(sent, "ligand").join(received, "receptor")
        .groupBy(*by, "sender", "receiver")
        .agg(F.count(F.lit(1)).alias("n_pairs"), F.sum(force / (half + force)).alias("weight"))
    )
