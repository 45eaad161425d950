import math
import random
import statistics as py

import numpy as np
import pytest
from pyspark.sql import functions as F

from targetlens.functions import ordering as od
from targetlens.functions import special as sp
from targetlens.operators import expression as ex
from targetlens.operators import qc
from targetlens.operators import statistics as st


@pytest.fixture(params=["one task", "ranges"])
def way(request, monkeypatch):
    """Run both ways of the ordered operators: keyed windows and value ranges."""
    if request.param == "ranges":
        monkeypatch.setattr(od, "ONE_TASK_ROWS", 3)
        monkeypatch.setattr(od, "RANGES", 5)
    return request.param


def test_ranges_are_cut_again_until_they_fit(spark, monkeypatch):
    """Two levels and more through every caller give what one task gives; NULL groups included."""
    from targetlens.operators import learning as ml

    rng = random.Random(12)
    rows = [(i, None if i % 4 == 0 else f"g{i % 3}", float(rng.randint(0, 400)), rng.random() < 0.4) for i in range(900)]
    df = spark.createDataFrame(rows + [(1000, "g0", None, True)], "k int, g string, v double, yes boolean").cache()
    life = spark.createDataFrame([(i, float(rng.randint(1, 300)), int(rng.random() < 0.7)) for i in range(900)], "sample int, months double, status int")
    one = F.when(F.col("yes"), 1).otherwise(0)

    def answers():
        return {name: sorted((tuple(r) for r in found.collect()), key=repr) for name, found in {
            "pct": od.pct_rank(df, "v", "s", descending=True), "pct_by": od.pct_rank(df.where("g IS NOT NULL"), "v", "s", ["g"]),
            "totals": od.running_totals(df, "v", {"n": F.count(F.lit(1)), "y": F.sum(one)}, ["g"], descending=True),
            "bh": od.bh_adjust(df.withColumn("p", F.col("v") / 401), "p"), "quantiles": od.quantiles(df, "v", {"a": 0.1, "b": 0.5, "c": 0.93}),
            "rank_sum": st.rank_sum(df.where("g IS NOT NULL"), "v", F.col("yes"), ["g"]),
            "auc": ml.ranking_quality(df.where("v IS NOT NULL").select(one.alias("label"), F.col("v").alias("score"))),
            "cox": st.cox_median_split(df.select(F.coalesce("g", F.lit("x")).alias("gene"), F.col("k").alias("sample"), F.col("v").alias("value")), life),
            "suffix": od.suffix_minimum(df.groupBy("v").agg(F.min("k").alias("t")), "v", "t", "m"),
        }.items()}

    expected = answers()
    monkeypatch.setattr(od, "ONE_TASK_ROWS", 12)
    monkeypatch.setattr(od, "RANGES", 4)
    ranged = od._ranged(df.where("v IS NOT NULL").groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")), "v", ["g"])
    sizes = [r["count"] for r in ranged.groupBy("g", "_range").count().collect()]
    assert max(sizes) <= 12 and len(sizes) > 4 * 4  # more ranges than one level can give a group
    assert sorted(ranged.agg(F.count_distinct("_range")).first()) > [4 * 4]
    got = answers()
    for name, rows in expected.items():
        assert len(got[name]) == len(rows)
        for a, b in zip(got[name], rows):
            assert a == pytest.approx(b, nan_ok=True) if all(isinstance(x, (int, float)) for x in b) else all(
                x == pytest.approx(y) if isinstance(y, float) else x == y for x, y in zip(a, b)), name


def average_ranks(values):
    order = sorted(values)
    return [order.index(v) + (order.count(v) + 1) / 2 for v in values]


def test_pct_rank(spark, way):
    rng = random.Random(1)
    values = [rng.randint(0, 12) for _ in range(60)] + [7] * 30
    df = spark.createDataFrame(list(enumerate(map(float, values))) + [(900, None)], "k int, v double")
    got = {r.k: r.s for r in od.pct_rank(df, "v", "s").collect()}
    for k, rank in enumerate(average_ranks(values)):
        assert got[k] == pytest.approx(rank / len(values))
    assert got[900] == 0.5


def test_pct_rank_example(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.0), (4, None), (5, 5.0)], "k int, v double")
    got = [r.s for r in od.pct_rank(df, "v", "s").orderBy("k").collect()]
    assert got == [0.25, 0.625, 0.625, 0.5, 1.0]


def test_bh(spark, way):
    rng = random.Random(2)
    p = [rng.random() ** 3 for _ in range(40)] + [0.01] * 5
    df = spark.createDataFrame(list(enumerate(p)), "k int, p double")
    got = {r.k: r.p_adjust for r in od.bh_adjust(df, "p").collect()}
    order = sorted(range(len(p)), key=lambda i: p[i])
    best = 1.0
    for place in range(len(p), 0, -1):
        i = order[place - 1]
        best = min(best, p[i] * len(p) / place)
        assert got[i] == pytest.approx(best)


def test_quantiles(spark, way):
    rng = random.Random(3)
    rows = [(g, rng.gauss(0, 1)) for g in "ab" for _ in range(25)] + [("c", 4.0)]
    got = {
        r.g: r for r in od.quantiles(
            spark.createDataFrame(rows, "g string, v double"), "v", {"lo": 0.01, "mid": 0.5}, ["g"]).collect()}
    for g in "abc":
        v = sorted(x for k, x in rows if k == g)
        assert got[g].mid == pytest.approx(py.median(v))
        place = (len(v) - 1) * 0.01
        assert got[g].lo == pytest.approx(v[0] + (v[min(1, len(v) - 1)] - v[0]) * place)


def test_row_numbers(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(500)], "k int, g int").repartition(7)
    got = {r.k: r.n for r in od.row_numbers(df, [F.col("g").desc(), F.col("k")], "n").collect()}
    order = sorted(range(500), key=lambda i: (-(i % 3), i))
    assert [got[k] for k in order] == list(range(1, 501))


def test_special_functions(spark):
    row = spark.range(1).select(
        sp.erfc(F.lit(0.7)).alias("e"), sp.ln_factorial(F.lit(20)).alias("f"),
        sp.hypergeometric_upper_tail(F.lit(3), F.lit(5), F.lit(8), F.lit(20)).alias("h"),
        sp.fisher_two_sided(F.lit(3), F.lit(4), F.lit(4), F.lit(8)).alias("tea"),
        sp.hypergeometric_upper_tail(F.lit(500200), F.lit(1000000), F.lit(1000000), F.lit(2000000)).alias("big"),
    ).first()
    assert row.e == pytest.approx(math.erfc(0.7), rel=2e-7)
    assert row.f == pytest.approx(math.lgamma(21), rel=1e-12)
    expected = sum(math.comb(8, x) * math.comb(12, 5 - x) for x in range(3, 6)) / math.comb(20, 5)
    assert row.h == pytest.approx(expected)
    assert row.tea == pytest.approx(34 / 70)
    sd = math.sqrt(1e6 * 1e6 * 1e6 * 1e6 / (4e12 * 2e6))
    assert row.big == pytest.approx(0.5 * math.erfc((200 - 0.5) / sd / math.sqrt(2)), rel=1e-3)


def rank_sum_reference(x, y):
    ranks = average_ranks(x + y)
    n1, n2 = len(x), len(y)
    u = sum(ranks[:n1]) - n1 * (n1 + 1) / 2
    ties = sum((x + y).count(v) ** 3 - (x + y).count(v) for v in set(x + y))
    n = n1 + n2
    sd = math.sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))
    shift = u - n1 * n2 / 2
    z = (shift - math.copysign(0.5, shift) * (shift != 0)) / sd
    return u, math.erfc(abs(z) / math.sqrt(2))


def test_rank_sum(spark, way):
    rng = random.Random(4)
    x, y = [rng.randint(0, 9) for _ in range(30)], [rng.randint(2, 11) for _ in range(20)]
    rows = [("m", float(v), True) for v in x] + [("m", float(v), False) for v in y]
    df = spark.createDataFrame(rows, "m string, v double, one boolean")
    got = st.rank_sum(df, "v", F.col("one"), ["m"]).first()
    u, p = rank_sum_reference(x, y)
    assert got.statistic == u and got.p_value == pytest.approx(p, rel=1e-6)


def test_sparse_test_equals_dense_test(spark, way):
    rng = random.Random(5)
    cells = [(i, "A" if i < 18 else "B", i % 3) for i in range(40)]
    values = [(g, i, round(rng.random(), 1) + 0.1) for g in ("g1", "g2") for i, _, _ in cells if rng.random() < 0.6]
    v = spark.createDataFrame(values, "gene string, cell int, value double")
    c = spark.createDataFrame(cells, "cell int, condition string, cluster int")
    got = {r.gene: r for r in st.de_wilcoxon(v, c, ("A", "B"), 0.0, 0.0).collect()}
    markers = {(r.gene, r.cluster): r for r in st.cluster_markers(v, c, "cluster", 0.0, -99).collect()}
    known = {(g, i): x for g, i, x in values}
    for g in ("g1", "g2"):
        dense = {i: known.get((g, i), 0.0) for i, _, _ in cells}
        u, p = rank_sum_reference([dense[i] for i in range(18)], [dense[i] for i in range(18, 40)])
        assert got[g].statistic == pytest.approx(u) and got[g].p_val == pytest.approx(p, rel=1e-6)
        for k in range(3):
            u, p = rank_sum_reference(
                [dense[i] for i, _, c_ in cells if c_ == k], [dense[i] for i, _, c_ in cells if c_ != k])
            assert markers[g, k].statistic == pytest.approx(u)
            assert markers[g, k].p_val == pytest.approx(p, rel=1e-6)


def test_differential_abundance_fixture(spark):
    rows = []
    for condition, t, h in (("Tumor", 40, 10), ("Normal", 10, 40)):
        rows += [(condition, "T_cell")] * t + [(condition, "Hepatocyte")] * h
    cells = spark.createDataFrame(rows, "condition string, celltype string")
    got = st.differential_abundance(cells).collect()
    assert len(got) == 2 and all(r.significant and 0 <= r.p_adjust <= 1 for r in got)
    swapped = st.differential_abundance(cells, ("Tumor", "Normal")).collect()
    assert sorted(r.p_value for r in got) == pytest.approx(sorted(r.p_value for r in swapped))


def test_gsea_against_brute_force(spark):
    genes = [(f"g{i}", 10.0 - i) for i in range(30)]
    deg = spark.createDataFrame(genes, "gene string, avg_log2fc double")
    hits = ["g0", "g1", "g3", "g25"]
    sets = spark.createDataFrame([("s", h) for h in hits], "set_name string, gene string")
    got = st.gsea(deg, sets, permutations=50, smallest=2).first()
    total = sum(abs(w) for g, w in genes if g in hits)
    run, best = 0.0, 0.0
    for g, w in genes:
        run += abs(w) / total if g in hits else -1 / (30 - 4)
        best = run if abs(run) > abs(best) else best
    assert got.es == pytest.approx(best) and got.set_size == 4 and 0 < got.p_value <= 1


def test_cox_matches_a_grid_search(spark):
    rng = random.Random(6)
    rows = []
    for i in range(80):
        x = rng.random()
        months = round(rng.expovariate(0.05 * (3 if x > 0.5 else 1)), 0) + 1
        rows.append((str(i), x, months, int(rng.random() < 0.8)))
    df = spark.createDataFrame(rows, "sample string, value double, months double, status int")
    got = st.cox_median_split(
        df.select(F.lit("g").alias("gene"), "sample", "value"), df.select("sample", "months", "status")).first()
    middle = py.median(r[1] for r in rows)

    def loss(beta):
        out = 0.0
        for _, x, t, d in rows:
            if d:
                risk = sum(math.exp(beta * (x2 > middle)) for _, x2, t2, _ in rows if t2 >= t)
                out -= beta * (x > middle) - math.log(risk)
        return out

    best = min((i / 500 for i in range(-1500, 1501)), key=loss)
    assert math.log(got.hr) == pytest.approx(best, abs=3e-3)
    few = st.cox_median_split(
        df.limit(10).select(F.lit("g").alias("gene"), "sample", "value"), df.select("sample", "months", "status"))
    assert few.first().hr == 1.0


def test_qc_gate(spark):
    metrics = spark.createDataFrame([(50, 500, 10)], "n_cells_after_qc int, n_genes int, deg_total int")

    def status(cells, genes, deg, doublet, **kw):
        limits = {
            "min_cells_after_qc": ("n_cells_after_qc", cells, "min"), "min_genes": ("n_genes", genes, "min"),
            "min_deg_genes": ("deg_total", deg, "min"), "max_doublet_rate": ("doublet_rate", doublet, "max")}
        checks = qc.qc_gate(metrics, limits, **kw)
        return qc.gate_status(checks).first().status, {r.name: r.level for r in checks.collect()}

    assert status(100, 1000, 5, 0.3)[0] == "fail"
    assert status(10, 100, 1, None)[0] == "pass"
    assert status(10, 100, 1, 0.3) == ("warn", {
        "min_cells_after_qc": "pass", "min_genes": "pass", "min_deg_genes": "pass", "max_doublet_rate": "warn"})
    assert status(10, 100, 1, 0.3, fail_on_missing=True)[0] == "fail"


def test_qc_bounds_relax(spark):
    df = spark.createDataFrame([(i, 100.0 + i, 50 + i, 1.0) for i in range(20)],
                               "cell int, n_count double, n_feature int, percent_mito double")
    assert qc.quantile_qc_filter(df, qc.qc_bounds(df)).count() == 20
    strict = qc.qc_bounds(df, feature_floor=1.0, count_floor=1.0, overrides={"hi_count": 110.0})
    assert qc.quantile_qc_filter(df, strict).count() == 10


def test_stratified_cap(spark):
    df = spark.createDataFrame([(i, "a" if i % 4 else "b") for i in range(400)], "cell int, g string")
    capped = ex.stratified_cap(df, "g", 60)
    got = {r.g: r["count"] for r in capped.groupBy("g").count().collect()}
    assert got == {"a": 60, "b": 60}
    assert sorted(r.cell for r in capped.collect()) == sorted(
        r.cell for r in ex.stratified_cap(df.repartition(5), "g", 60).collect())


@pytest.mark.parametrize("entries", [10_000_000, 150])
def test_coexpression_in_blocks(spark, monkeypatch, entries):
    monkeypatch.setattr(st, "BLOCK_ENTRIES", entries)
    monkeypatch.setattr(st, "SLICE_CELLS", 60)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(5, 40))
    grid = np.vstack([base[i % 5] + rng.normal(scale=0.2 + 0.2 * (i // 5), size=40) for i in range(20)])
    grid[rng.random(grid.shape) < 0.2] = 0
    grid[19] = 3.0
    rows = [(f"g{i}", f"s{j}", float(v)) for i, line in enumerate(grid) for j, v in enumerate(line) if v]
    strength = np.nan_to_num(np.abs(np.corrcoef(grid)))
    np.fill_diagonal(strength, 0)
    df = spark.createDataFrame(rows, "gene string, sample string, value double")
    got = {r["gene"]: r["hub_degree"] for r in st.coexpression_degree(df, cutoff=0.5).collect()}
    assert got == {f"g{i}": float((strength[i] >= 0.5).sum()) for i in range(20)}
    weak = {r["gene"]: r["hub_degree"] for r in st.coexpression_degree(df, cutoff=1.1).collect()}
    assert weak == {f"g{i}": pytest.approx(strength[i].sum() / 20, abs=1e-9) for i in range(20)}


def test_cox_reads_its_expression_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        read.add(1)
        return x

    rows = [(g, s, float((s * 7 + ord(g)) % 11)) for g in "ab" for s in range(40)]
    expression = spark.createDataFrame(rows, "gene string, sample long, value double").withColumn("value", seen("value"))
    life = spark.createDataFrame([(s, float(1 + s % 9), s % 2) for s in range(40)], "sample long, months double, status int")
    # the check for NULL and the column itself, of one pass
    assert st.cox_median_split(expression, life).count() == 2 and read.value <= 2 * len(rows)
