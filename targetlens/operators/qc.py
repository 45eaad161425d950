"""Cell quality metrics, filters and gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.functions.columns import col, number, ratio, resolve_column
from targetlens.functions.ordering import quantiles
from targetlens.session import cut_lineage

# Gene-name patterns of mitochondrial and ribosomal genes.
MITO_PATTERN = "^MT-|^mt-"
RIBO_PATTERN = "^RP[SL]"

# Column aliases used when profiling a table.
NUMERIC_TYPES = ("double", "float", "integer", "long", "short", "byte", "decimal")
P_ALIASES = (
    "p_val_adj", "padj", "fdr", "p.adjust", "pvalue", "p_value", "p.value",
)
FOLD_CHANGE_ALIASES = ("avg_log2fc", "log2foldchange", "log2fc", "logfc")
DISTINCT_ALIASES = {
    "sample": ("sample", "sample_id"),
    "condition": ("condition", "group"),
    "cluster": ("cluster", "seurat_clusters"),
    "celltype": ("celltype", "cell_type", "celltype_annot", "celltype_annot_cell"),
}
FLAG_ALIASES = {
    "significant": ("significant",),
    "direction": ("direction", "change"),
    "doublet": ("doublet_call", "df.classifications"),
}


def cell_qc_metrics(
    counts: DataFrame, mito: str = MITO_PATTERN, ribo: str = RIBO_PATTERN
) -> DataFrame:
    """Per cell: total count, detected genes and the mitochondrial / ribosomal percentages."""
    value = F.col("value")
    part = lambda pattern: 100.0 * ratio(
        F.sum(F.when(F.col("gene").rlike(pattern), value).otherwise(0.0)), F.sum(value)
    )
    return counts.groupBy("cell").agg(
        F.sum(value).alias("n_count"),
        F.count_if(value > 0).alias("n_feature"),
        part(mito).alias("percent_mito"),
        part(ribo).alias("percent_ribo"),
    )


def qc_bounds(
    metrics: DataFrame,
    feature_floor: float = 200.0, feature_ceiling: float = 20000.0,
    count_floor: float = 300.0, count_ceiling: float = 500000.0,
    mito_ceiling: float = 30.0,
    overrides: Mapping[str, float] | None = None,
    sample_level: bool = False,
) -> DataFrame:
    """One row of thresholds from the 1 % and 99 % quantiles, relaxed when they exclude everything."""
    given = overrides or {}
    edges = {"q01": 0.01, "q99": 0.99}
    long = metrics.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("x"))
                for m in ("n_feature", "n_count", "percent_mito")
            ])
        ).alias("m")
    ).select("m.metric", "m.x")
    long = cut_lineage(long.groupBy("metric", "x").agg(F.count(F.lit(1)).alias("n")))
    spread = quantiles(long, "x", edges, by=["metric"], weight="n").join(
        long.groupBy("metric").agg(F.max("x").alias("top")), "metric"
    )
    pick = lambda metric, c: F.max(F.when(F.col("metric") == metric, F.col(c)))
    raw = spread.agg(
        F.greatest(F.lit(feature_floor), pick("n_feature", "q01")).alias("lo_feature"),
        F.least(F.lit(feature_ceiling), pick("n_feature", "q99")).alias("hi_feature"),
        F.greatest(F.lit(count_floor), pick("n_count", "q01")).alias("lo_count"),
        F.least(F.lit(count_ceiling), pick("n_count", "q99")).alias("hi_count"),
        F.least(F.lit(mito_ceiling), pick("percent_mito", "q99")).alias("hi_mito"),
        (pick("n_feature", "top") + 1).alias("all_feature"),
        (pick("n_count", "top") + 1).alias("all_count"),
    )
    for name, bound in given.items():
        raw = raw.withColumn(name, F.lit(float(bound)))
    relaxed = F.lit(sample_level) | (F.col("lo_feature") > F.col("hi_feature")) | (
        F.col("lo_count") > F.col("hi_count")
    )
    either = lambda loose, strict: F.when(F.col("_r"), loose).otherwise(F.col(strict))
    return raw.withColumn("_r", relaxed).select(
        either(F.lit(0.0), "lo_feature").alias("lo_feature"),
        either(F.col("all_feature"), "hi_feature").alias("hi_feature"),
        either(F.lit(0.0), "lo_count").alias("lo_count"),
        either(F.col("all_count"), "hi_count").alias("hi_count"),
        either(F.lit(100.0), "hi_mito").alias("hi_mito"),
    )


def quantile_qc_filter(metrics: DataFrame, bounds: DataFrame) -> DataFrame:
    """Cells inside the one-row ``bounds``."""
    limit = bounds.select(F.struct(*bounds.columns)).scalar()
    return (
        metrics.withColumn("_b", limit)
        .where(
            F.col("n_feature").between(F.col("_b.lo_feature"), F.col("_b.hi_feature"))
            & F.col("n_count").between(F.col("_b.lo_count"), F.col("_b.hi_count"))
            & (F.col("percent_mito") <= F.col("_b.hi_mito"))
        )
        .drop("_b")
    )


def doublet_rate(cells: DataFrame) -> DataFrame:
    """Per sample: cells, doublets and their share, from (sample, doublet_call)."""
    doublet = F.lower(F.col("doublet_call").cast("string")) == "doublet"
    return cells.groupBy("sample").agg(
        F.count("doublet_call").alias("n_cells"), F.count_if(doublet).alias("n_doublets")
    ).withColumn("doublet_rate", ratio(F.col("n_doublets"), F.col("n_cells")))


def crosstab(df: DataFrame, rows: str | Sequence[str], columns: str) -> DataFrame:
    """Long contingency table with counts and the share within each row key."""
    keys = [rows] if isinstance(rows, str) else list(rows)
    counted = df.groupBy(*keys, columns).agg(F.count(F.lit(1)).alias("n"))
    totals = counted.groupBy(*keys).agg(F.sum("n").alias("_all"))
    return counted.join(totals, keys).select(
        *keys, columns, "n", ratio(F.col("n"), F.col("_all")).alias("share")
    )


def retention(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after a filter and the percentage kept."""
    return before.agg(F.count(F.lit(1)).alias("n_before")).withColumn(
        "n_after", after.agg(F.count(F.lit(1))).scalar()
    ).withColumn("percent_kept", 100.0 * ratio(F.col("n_after"), F.col("n_before")))


def qc_gate(
    metrics: DataFrame,
    thresholds: Mapping[str, tuple[str, float | None, str]],
    fail_on_missing: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Checks of a metrics table, one row per check (and per metrics row); ``keep`` passes columns on.

    ``thresholds`` maps a check name to (metric column, threshold, "min" or "max"); a threshold
    of None or 0 switches the check off. A missing metric warns, or fails on request.
    """
    checks = []
    for name, (metric, threshold, side) in thresholds.items():
        if threshold is None or float(threshold) == 0:
            continue
        value = number(F.col(metric).cast("string")) if metric in metrics.columns else F.lit(None)
        value = value.cast("double")
        limit = F.lit(float(threshold))
        good = value >= limit if side == "min" else value <= limit
        level = (
            F.when(value.isNull(), "fail" if fail_on_missing else "warn")
            .when(good, "pass").otherwise("fail")
        )
        checks.append(
            F.struct(
                F.lit(name).alias("name"), value.alias("value"), limit.alias("threshold"),
                level.alias("level"), F.coalesce(good, F.lit(False)).alias("ok"),
            )
        )
    if not checks:
        empty = "name string, value double, threshold double, level string, ok boolean"
        return metrics.sparkSession.createDataFrame([], empty)
    return metrics.select(*keep, F.explode(F.array(*checks)).alias("c")).select(*keep, "c.*")


def gate_status(checks: DataFrame) -> DataFrame:
    """One row: overall status and the number of failed and warned checks."""
    return checks.agg(
        F.count_if(F.col("level") == "fail").alias("failed"),
        F.count_if(F.col("level") == "warn").alias("warned"),
    ).withColumn(
        "status",
        F.when(F.col("failed") > 0, "fail").when(F.col("warned") > 0, "warn").otherwise("pass"),
    )


def validate_inputs(expression: DataFrame, metadata: DataFrame) -> DataFrame:
    """(check, ok): expression is non-empty and numeric, metadata usable for two groups."""
    numbers = expression.agg(
        F.count(F.lit(1)).alias("rows"), F.count(number(F.col("value").cast("string"))).alias("numeric")
    )
    sizes = metadata.groupBy("sample").agg(F.count(F.lit(1)).alias("n"))
    repeated = sizes.agg(F.max("n")).scalar()
    summary = metadata.agg(
        F.count_if(F.col("sample").isNull()).alias("missing"),
        F.countDistinct("condition").alias("conditions"),
    )
    facts = numbers.select(
        "rows", "numeric", summary.select("missing").scalar().alias("missing"),
        summary.select("conditions").scalar().alias("conditions"), repeated.alias("repeated"),
    )
    rule = lambda name, ok: F.struct(
        F.lit(name).alias("check"), F.coalesce(ok, F.lit(False)).alias("ok")
    )
    return facts.select(
        F.explode(
            F.array(
                rule("expression_not_empty", F.col("rows") > 0),
                rule("expression_numeric", F.col("numeric") > 0),
                rule("samples_present", F.col("missing") == 0),
                rule("samples_unique", F.col("repeated") == 1),
                rule("two_conditions", F.col("conditions") >= 2),
            )
        ).alias("c")
    ).select("c.*")


def table_profile(df: DataFrame) -> DataFrame:
    """One pass over a table: (item, field, value) with row count, column statistics, p-value and
    fold-change counts and distinct labels, by column alias."""
    aggs: dict[tuple[str, str], Column] = {("rows", ""): F.count(F.lit(1))}
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in NUMERIC_TYPES}

    def read(name: str) -> Column:
        return col(name).cast("double") if name in numeric else number(col(name).cast("string"))

    for field in df.schema.fields:
        x = read(field.name)
        for item, fn in (("valid", F.count), ("mean", F.avg), ("min", F.min), ("max", F.max)):
            aggs[(item, field.name)] = fn(x)
    p = resolve_column(df, P_ALIASES)
    if p:
        x = read(p)
        aggs[("p_below_0.05", p)] = F.count_if(x < 0.05)
        aggs[("p_below_0.01", p)] = F.count_if(x < 0.01)
    fold = resolve_column(df, FOLD_CHANGE_ALIASES)
    if fold:
        x = read(fold)
        aggs[("up", fold)] = F.count_if(x > 0)
        aggs[("down", fold)] = F.count_if(x < 0)
    for item, aliases in DISTINCT_ALIASES.items():
        label = resolve_column(df, aliases)
        if label:
            aggs[(f"distinct_{item}", label)] = F.countDistinct(
                F.when(col(label).cast("string") != "", col(label))
            )
    items = list(aggs)
    row = df.agg(*[a.cast("double").alias(f"v{i}") for i, a in enumerate(aggs.values())])
    return row.select(
        F.explode(
            F.array(*[
                F.struct(F.lit(i).alias("item"), F.lit(f).alias("field"), F.col(f"v{n}").alias("value"))
                for n, (i, f) in enumerate(items)
            ])
        ).alias("p")
    ).select("p.*").where(F.col("value").isNotNull())


def flag_counts(df: DataFrame) -> DataFrame:
    """(flag, label, n): value counts of the flag columns a table happens to have."""
    flags = {n: resolve_column(df, aliases) for n, aliases in FLAG_ALIASES.items()}
    pairs = [
        F.struct(F.lit(n).alias("flag"), F.lower(F.trim(col(c).cast("string"))).alias("label"))
        for n, c in flags.items() if c
    ]
    return (
        df.select(F.explode(F.array(*pairs)).alias("f")).groupBy("f.flag", "f.label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def score_histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width counts between the minimum and the maximum; the last bin is closed."""
    x = F.col(value).cast("double")
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    width = (F.col("_e.hi") - F.col("_e.lo")) / bins
    place = F.floor(ratio(x - F.col("_e.lo"), width)).cast("int")
    return (
        df.where(x.isNotNull()).withColumn("_e", ends)
        .select(
            F.coalesce(F.least(F.lit(bins - 1), place), F.lit(0)).alias("bin"),
            F.col("_e.lo").alias("_lo"), width.alias("_w"),
        )
        .groupBy("bin").agg(
            F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"), F.first("_w").alias("_w")
        )
        .select("bin", "n", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("low"))
    )


def dataset_summary(counts: DataFrame, cells: DataFrame, deg: DataFrame) -> DataFrame:
    """One row: cells, genes, samples, cell types, conditions and significant genes up / down."""
    facts = cells.agg(
        F.countDistinct("cell").alias("n_cells"), F.countDistinct("sample").alias("n_samples"),
        F.countDistinct("celltype").alias("n_celltypes"),
        F.countDistinct("condition").alias("n_conditions"),
    )
    changed = deg.agg(
        F.struct(
            F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("significant") & (F.col("avg_log2fc") > 0)).alias("up"),
            F.count_if(F.col("significant") & (F.col("avg_log2fc") < 0)).alias("down"),
        )
    ).scalar()
    return facts.select(
        "*", counts.agg(F.countDistinct("gene")).scalar().alias("n_genes"), changed.alias("_d")
    ).select(
        "n_cells", "n_genes", "n_samples", "n_celltypes", "n_conditions",
        F.col("_d.total").alias("deg_total"), F.col("_d.up").alias("deg_up"),
        F.col("_d.down").alias("deg_down"),
    )
