import gzip
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from targetlens.operators import embedding as em
from targetlens.operators import learning as ml
from targetlens.sources import parsers as ps
from targetlens.sources import readers as rd
from targetlens.sources import sinks as sk
from targetlens.streaming import streams as sm


def test_read_lines_over_many_blocks(spark, tmp_path):
    for name, n in (("a", 3000), ("b", 10)):
        (tmp_path / f"{name}.log").write_text("\n".join(f"{name}{i}" for i in range(1, n + 1)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        lines = rd.read_lines(spark, str(tmp_path))
        assert lines.count() == 3010
        assert lines.where("value <> concat(substring(value, 1, 1), line_no)").count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_matrix_market(spark, tmp_path):
    with gzip.open(tmp_path / "m.mtx.gz", "wt") as fh:
        fh.write("%%MatrixMarket\n%c\n3 3 3\n1 1 5\n2 1 1\n3 3 2.5\n")
    lines = rd.read_lines(spark, str(tmp_path / "m.mtx.gz"))
    name = lines.first().file
    lists = lambda *names: spark.createDataFrame(
        [(name, i + 1, n) for i, n in enumerate(names)], "file string, pos long, name string")
    got = sorted((r.gene, r.cell, r.value) for r in ps.scan_mtx(lines, lists("A", "A"), lists("c1", "c2")).collect())
    assert got == [("A", "c1", 5.0), ("A.1", "c1", 1.0), ("Gene3", "Cell3", 2.5)]


@pytest.mark.parametrize("header", ["gene,AAC-1,GGT-1", '"AAC-1","GGT-1"'])
def test_gene_csv(spark, tmp_path, header):
    (tmp_path / "x.csv").write_text(header + '\n"A",1,0\nB,0,2\n')
    got = sorted((r.gene, r.cell, r.value) for r in ps.scan_gene_csv(rd.read_lines(spark, str(tmp_path / "x.csv"))).collect())
    assert got == [("A", "AAC-1", 1.0), ("B", "GGT-1", 2.0)]


def test_delimited(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("Symbol\tDatabase\n alb\tCTD\nALB\tCTD\n\tX\n")
    table = rd.scan_delimited(spark, str(tmp_path / "t.tsv"))
    assert [tuple(r) for r in rd.target_table(table, "t").collect()] == [("ALB", "CTD")]
    assert [r.gene for r in rd.gene_list(table).collect()] == ["ALB"]


def test_xml_catalog(spark, tmp_path):
    (tmp_path / "s.xml").write_text(
        '<r><DocSum><Id>7</Id><Item Name="Accession" Type="String">GSE9</Item>'
        '<Item Name="title" Type="String"> scRNA liver </Item><Item Name="Samples" Type="List">'
        '<Item Name="Sample" Type="Structure"></Item><Item Name="Sample" Type="Structure"></Item></Item></DocSum></r>')
    row = rd.scan_catalog_xml(spark, str(tmp_path / "s.xml")).first()
    assert (row.uid, row.Accession, row.title, row.n_samples) == ("7", "GSE9", "scRNA liver", "2")


def test_affinity_log(spark, tmp_path):
    (tmp_path / "l.txt").write_text("mode | affinity\n-----+\n   1   -8.3  0.000  0.000\n   2   -7.1  1.822  3.310\nx 1 2\n")
    modes = ps.scan_affinity_log(rd.read_lines(spark, str(tmp_path)))
    assert modes.count() == 2
    best = ps.best_mode(modes).first()
    assert (best.mode, best.affinity, best.rmsd_ub) == (1, -8.3, 0.0)


def test_structure_box(spark, tmp_path):
    atom = "{:<6}{:>5}  C1  {:<3} A{:>4}    {:8.3f}{:8.3f}{:8.3f}"
    lines = [atom.format("ATOM", i, "ALA", 1, i, i, i) for i in range(4)]
    (tmp_path / "a.pdb").write_text("\n".join(lines + [atom.format("HETATM", 9, "HOH", 2, 50, 0, 0)]))
    lines += [atom.format("HETATM", 9 + i, "LIG", 3, 10 + 20 * i, 0, 1) for i in range(3)]
    (tmp_path / "b.pdb").write_text("\n".join(lines))
    text = rd.read_lines(spark, str(tmp_path))
    box = {r.file[-5:]: r for r in ps.scan_structure_box(text).collect()}
    assert box["a.pdb"].mode == "protein_centroid" and box["a.pdb"].size_x == 30.0 and box["a.pdb"].center_x == 1.5
    assert box["b.pdb"].mode == "cocrystal_ligand" and box["b.pdb"].size_x == 46.0 and box["b.pdb"].size_y == 18.0
    assert box["b.pdb"].center_x == 30.0 and box["b.pdb"].valid
    group = ps.scan_hetero_groups(text).first()
    assert (group.resname, group.atoms) == ("LIG", 3)


def test_evidence_json(spark):
    rows = [
        ("G", "string", json.dumps({"status_code": 200, "records": [{"preferredName_B": "X"}, {"stringId_B": "Y"}, {"preferredName_B": "X"}]})),
        ("G", "reactome", json.dumps({"ok": False, "summary": {"total": "12"}})),
        ("G", "kegg", json.dumps({"ok": True, "pathways": ["p1", "p2"], "pathway_count": 5})),
        ("G", "opentargets", json.dumps({"ok": True, "summary": {"search": {"hits": [
            {"entity": "target", "object": {"id": "E1"}}, {"entity": "disease", "object": {"id": "D"}},
            {"entity": "target", "object": {"approvedSymbol": "S"}}]}}})),
    ]
    r = ps.scan_evidence_json(spark.createDataFrame(rows, "gene string, section string, json string")).first()
    assert (r.string_partners, r.string_partner_ids) == (3, "X,Y")
    assert (r.reactome_pathways, r.kegg_pathways, r.kegg_pathway_ids) == (12, 5, "p1,p2")
    assert (r.opentargets_hits, r.opentargets_target_ids) == (2, "E1,S")
    assert r.database_sources == "kegg,opentargets,string"


def test_file_roles(spark):
    names = {
        "GSE1_RNA-Seq_counts.txt.gz": "matrix", "x_fpkm.csv": "skip", "x_tpm.txt": "skip", "normalized.csv": "skip",
        "GSE1_series_matrix.txt.gz": "skip", "GSM12_GC1.txt.gz": "matrix", "barcodes.tsv.gz": "barcodes",
        "features.tsv": "genes", "metadata.csv": "metadata", "all.tar.gz": "skip"}
    df = spark.createDataFrame([("d", n) for n in names], "dataset string, name string")
    got = {r.name: r.role for r in df.withColumn("role", ps.file_role(F.col("name"))).collect()}
    assert got == names
    assert ps.classify_files(df.where("name like 'GSM%'")).first().mode == "bulk"
    assert ps.classify_files(df.where("name like 'bar%'")).first().mode == "single_cell"
    assert ps.classify_files(df.where("name like 'meta%'")).first().mode == "generic"


def test_fingerprint_and_append(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    mark = lambda d: sk.input_fingerprint(d, "t").first().digest
    assert mark(df) == mark(df.repartition(2)) != mark(df.union(df)) and mark(df) != mark(df.limit(1))
    path = str(tmp_path / "r")
    sk.sink_append_results(df, path)
    sk.sink_append_results(df, path)
    assert spark.read.parquet(path).count() == 4


@pytest.mark.parametrize("block", [4096, 16])
def test_knn_against_brute_force(spark, block):
    rng = np.random.default_rng(1)
    v = np.concatenate([rng.normal(c, 0.3, (40, 5)) for c in (-2, 0, 3)] + [np.ones((50, 5))])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = {}
    for r in em.knn_graph(df, 4, block=block).collect():
        got.setdefault(r.id, []).append((r.rank, r.neighbour, r.distance))
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(len(v)):
        assert np.allclose([x[2] for x in sorted(got[i])], np.sort(d[i])[:4], atol=1e-5)
        assert len({x[1] for x in got[i]} | {i}) == 5


def test_knn_of_string_ids(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 1, (60, 3)), np.ones((30, 3))])
    names = [f"cell-{(i * 37) % 90:02d}" for i in range(90)]
    df = spark.createDataFrame([(n, x.tolist()) for n, x in zip(names, v)], "id string, v array<double>")
    rows = em.knn_graph(df, 3, block=8).collect()
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    for i, name in enumerate(names):
        order = sorted((round(d[i, j], 9), names[j]) for j in range(90) if j != i)[:3]
        assert [(round(r.distance, 6), r.neighbour) for r in sorted(rows, key=lambda r: r["rank"]) if r.id == name] == [
            (pytest.approx(x, abs=1e-5), n) for x, n in order]


def test_searched_leaves_do_not_grow_with_the_points(spark):
    searched, number = [], []
    for n in (2500, 10000, 40000):
        side = float(np.sqrt(n))
        points = spark.range(n).select(F.col("id").alias("n"), F.array(F.rand(3) * side, F.rand(4) * side).alias("v"))
        placed, nodes = em.pivot_tree(points, 64)
        sizes = [r["count"] for r in placed.groupBy("node").count().collect()]
        assert max(sizes) <= 64 and sum(sizes) == n
        leaves = nodes.join(nodes.selectExpr("parent AS node"), "node", "left_anti").selectExpr(
            "node AS leaf", "center AS center_a", "radius AS radius_a", "2.0D AS reach")
        number.append(leaves.count())
        searched.append(em.leaf_pairs(leaves, nodes).count() / number[-1])
    assert number[2] > 8 * number[0] and searched[2] < 1.5 * searched[0]


@pytest.mark.parametrize("classes", [2, 3])
def test_lasso_svm(spark, classes):
    """The informative features stay, and rows are predicted by models that have not seen them."""
    from pyspark.ml.functions import array_to_vector

    from targetlens.operators import learning as ml

    rng = np.random.default_rng(2)
    labels = rng.integers(0, classes, 240)
    noise = rng.normal(0, 1, (240, 6))
    noise[:, 2] += 3 * labels
    noise[:, 4] -= 3 * (labels == 1)
    df = spark.createDataFrame([(i, float(y), x.tolist()) for i, (y, x) in enumerate(zip(labels, noise))], "id long, label double, x array<double>").coalesce(1)
    data = df.select("id", "label", array_to_vector("x").alias("features"))
    model = ml.LassoSVC(classes, most=2).fit(data)
    assert set(model.stages[0].getIndices()) == {2, 4}
    scored = ml.cross_predict(ml.folds(data, "label", "id", 3), ml.build_classifier("lasso_svm", 6, classes), 3)
    rows = scored.select("id", "label", "prediction", "probability").collect()
    assert len(rows) == 240 and np.mean([r.label == r.prediction for r in rows]) > 0.85
    assert all(abs(sum(r.probability) - 1) < 1e-6 and int(np.argmax(r.probability)) == r.prediction for r in rows)


def test_clusters_and_batches(spark):
    links = [(a, b) for g in (range(0, 5), range(10, 15)) for a in g for b in g if a < b]
    df = spark.createDataFrame(links, "id long, neighbour long")
    got = {r.id: r.cluster for r in em.cluster_cells(df).collect()}
    assert {got[i] for i in range(5)} == {0} and {got[i] for i in range(10, 15)} == {10}
    points = spark.createDataFrame([(1, "a", [1.0, 2.0]), (2, "a", [3.0, 2.0]), (3, "b", [9.0, 9.0])],
                                   "cell long, sample string, pcs array<double>")
    got = {r.cell: list(r.pcs) for r in em.batch_center(points).collect()}
    assert got == {1: [-1.0, 0.0], 2: [1.0, 0.0], 3: [0.0, 0.0]}


def test_ranking_quality(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (1, 0.4), (0, 0.1)]
    r = ml.ranking_quality(spark.createDataFrame(rows, "label int, score double")).first()
    pairs = [(p, n) for y, p in rows if y for z, n in rows if not z]
    assert r.roc_auc == pytest.approx(sum((p > n) + 0.5 * (p == n) for p, n in pairs) / len(pairs))
    assert r.average_precision == pytest.approx(1 / 3 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 4)


def test_text_relevance(spark):
    rows = []
    for i in range(20):
        good = i % 2 == 0
        text = "hepatocellular carcinoma single cell sequencing" if good else "mouse kidney imaging of tissue"
        rows.append((i, f"{text} study {i}", int(good)))
    df = spark.createDataFrame(rows, "id int, text string, label int")
    scored = ml.text_relevance_train(df)(df.select("id", "text"))
    assert {r.id for r in scored.where("ml_score > 0.5").collect()} == set(range(0, 20, 2))
    out = ml.evaluation_summary(ml.text_relevance_eval(df, "id", splits=4)).first()
    assert out.samples == 20 and out.accuracy == 1.0 and out.roc_auc == 1.0


def test_frequent_terms(spark):
    """Most frequent first, ties by term whatever the order of the rows; empty and missing arrays count nothing."""
    rows = [(["b", "a", "c", "a"],), (["c", "d", "d", "d"],), ([],), (None,)]
    for part in (rows, rows[::-1]):
        df = spark.createDataFrame(part, "_terms array<string>").repartition(3)
        assert ml.frequent_terms(df, 3) == ["d", "a", "c"]
        assert ml.frequent_terms(df, 9, min_df=2) == ["c"]
        plan = df.select("_terms").withColumn("_terms", F.transform("_terms", lambda x: F.upper(x)))
        assert ml.frequent_terms(plan, 1) == ["D"]


def test_classifier_and_selection(spark):
    rng = random.Random(3)
    rows = [(i, "A" if i % 2 else "B", rng.random() + 2 * (i % 2), rng.random(), rng.random() - (i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "sample int, condition string, x double, noise double, y double")
    out = ml.sample_classifier(df, ["x", "noise", "y"], "rf")
    assert out.where("predicted = actual").count() >= 38
    assert ml.sample_classifier(df.limit(3), ["x"], "rf") is None
    labelled = df.withColumn("label", (F.col("condition") == "A").cast("double"))
    assert "x" in ml.l1_rfe_select(labelled, ["x", "noise", "y"], most=2)


def test_stream_drops_repeats_and_late_rows(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    schema = "id long, ts timestamp_ntz, drug string, event string"
    batches = [
        [(1, "2024-01-01 10:00:00", "A", "X"), (1, "2024-01-01 10:00:00", "A", "X"), (2, "2024-01-01 11:00:00", "A", "Y")],
        [(3, "2024-01-03 12:00:00", "B", "X")],
        [(4, "2024-01-01 09:00:00", "A", "X"), (5, "2024-01-05 09:00:00", "B", "Y")],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "id long, ts string, drug string, event string").withColumn(
            "ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(str(source / str(i)))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(str(source))
        sm.stream_signals(stream, str(out / "counts"), str(out / "state")).awaitTermination()
    stored = {(str(r.start)[:10], r.drug, r.event): r.a for r in spark.read.parquet(str(out / "counts")).collect()}
    assert stored == {("2024-01-01", "A", "X"): 1, ("2024-01-01", "A", "Y"): 1, ("2024-01-03", "B", "X"): 1}
    assert sm.current_signals(spark.read.parquet(str(out / "counts"))).count() == 3


def test_append_once(spark, tmp_path):
    write = sm.append_once(str(tmp_path / "r"))
    one = spark.createDataFrame([("a", "failed"), ("b", "ok"), ("a", "ok")], "id string, status string")
    write(one, 0)
    write(one, 0)
    write(spark.createDataFrame([("b", "ok"), ("c", "failed")], "id string, status string"), 1)
    got = sorted((r.id, r.status) for r in spark.read.parquet(str(tmp_path / "r")).collect())
    assert got == [("a", "ok"), ("b", "ok"), ("c", "failed")]


def test_parsers_on_ordinary_variations(spark):
    lines = [("a", 1, 'x,"C,1",C2'), ("a", 2, '"A,B",1,2'), ("a", 3, 'G"",0,3'), ("b", 1, "AAAC-1,AAAG-1"), ("b", 2, "TP53,4,0")]
    df = spark.createDataFrame(lines, "file string, line_no int, value string")
    got = {(r.file, r.gene, r.cell, r.value) for r in ps.scan_gene_csv(df).collect()}
    assert got >= {("a", "A,B", "C,1", 1.0), ("a", "A,B", "C2", 2.0), ("b", "TP53", "AAAC-1", 4.0)} and len(got) == 4
    names = spark.createDataFrame([("a", 1, "TP53"), ("a", 2, "TP53"), ("b", 1, "TP53")], "file string, pos long, name string")
    assert sorted((r.file, r.name) for r in ps.make_unique(names).collect()) == [("a", "TP53"), ("a", "TP53.1"), ("b", "TP53")]
    series = [
        ("f", 1, '!Sample_title\t"s1"\t"s2"'), ("f", 2, '!Sample_characteristics_ch1\t"age: 1"\t"age: 2"'),
        ("f", 3, '!Sample_characteristics_ch1\t"age: 3"\t"age: 2"'),
    ]
    rows = ps.scan_series_matrix(spark.createDataFrame(series, "file string, line_no int, value string")).collect()
    assert {r["sample"]: dict(r.traits) for r in rows} == {"s1": {"age": "1; 3"}, "s2": {"age": "2"}}


def test_fingerprint_tells_fields_apart(spark):
    mark = lambda *row: sk.input_fingerprint(spark.createDataFrame([row], "a string, b string"), "t").first().digest
    assert mark("a|b", "c") != mark("a", "b|c") and mark(None, "a") != mark("-", "a")


def test_points_travel_once_a_block_and_not_once_a_leaf(spark, monkeypatch):
    n, sent, tiles = 1200, [], em._neighbour_tiles
    monkeypatch.setattr(em, "_neighbour_tiles", lambda q, t, *a: sent.append(max(q.count(), t.count())) or tiles(q, t, *a))
    v = np.random.default_rng(5).normal(0, 1, (n, 24))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    got = {(r.id, r["rank"]): r.neighbour for r in em.knn_graph(df, 3, block=16).collect()}
    assert max(sent) <= 9 * n
    d = ((v[:, None] - v[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    best = np.argsort(d, axis=1)
    assert all(got[i, k + 1] == best[i, k] for i in range(n) for k in range(3))


def test_expression_pca_against_dense_components(spark):
    import numpy as np

    from targetlens.operators import embedding as em

    rng = np.random.default_rng(6)
    grid = rng.integers(1, 9, (60, 7)) * (rng.random((60, 7)) < 0.4)
    grid[0, 0] = 5
    rows = [(f"g{j}", i, float(grid[i, j])) for i in range(60) for j in range(7) if grid[i, j]]
    values = spark.createDataFrame(rows, "gene string, cell long, value double")
    genes = values.select("gene").distinct()
    vectors, zeros = em.cell_vectors(em.scale_genes(values, F.lit(60.0)))
    assert sum(r["v"].numNonzeros() for r in vectors.collect()) == len(rows) and len(zeros) == 7
    got = {r["cell"]: np.array(r["pcs"]) for r in em.expression_pca(values, F.lit(60.0), genes, 3).collect()}
    held = sorted(got)
    shown = {r["gene"]: (r["mean"], r["variance"]) for r in em.gene_moments(values, F.lit(60.0)).collect()}
    z = np.stack([(grid[held, j] - shown[f"g{j}"][0]) / np.sqrt(shown[f"g{j}"][1]) for j in range(7)], axis=1)
    _, axes = np.linalg.eigh(np.cov(z.T))
    want = z @ axes[:, ::-1][:, :3]
    have = np.stack([got[c] for c in held])
    assert np.allclose(np.abs(have), np.abs(want), atol=1e-8)


def test_expression_pca_has_every_cell(spark):
    rows = [("a", 1, 2.0), ("b", 1, 1.0), ("a", 2, 5.0), ("b", 2, 3.0), ("b", 3, 4.0), ("c", 4, 1.0)]
    values = spark.createDataFrame(rows, "gene string, cell long, value double")
    genes = spark.createDataFrame([("a",), ("b",)], "gene string")
    cells = spark.createDataFrame([(i,) for i in range(1, 6)], "cell long")
    got = {r["cell"]: np.array(r["pcs"]) for r in em.expression_pca(values, F.lit(5.0), genes, 2, cells).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]  # 4 has none of the genes, 5 has no row at all
    assert np.allclose(got[4], got[5])
    x = np.array([[2.0, 1.0], [5.0, 3.0], [0.0, 4.0], [0.0, 0.0], [0.0, 0.0]])
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    want = z @ np.linalg.eigh(np.cov(z.T))[1][:, ::-1]
    assert np.allclose(np.abs(np.stack([got[c] for c in sorted(got)])), np.abs(want), atol=1e-8)
    assert sorted(r["cell"] for r in em.expression_pca(values, F.lit(4.0), genes, 2).collect()) == [1, 2, 3, 4]


def test_knn_of_copies_searches_each_point_once(spark, monkeypatch):
    searched, search = [], em._nearest_points
    monkeypatch.setattr(em, "_nearest_points", lambda p, *a: searched.append([tuple(r) for r in p.select("n", "asked").collect()]) or search(p, *a))
    v = np.concatenate([np.repeat([[0.0, 0.0], [1.0, 0.0]], 30, axis=0), np.repeat([[0.0, 2.0], [3.0, 1.0]], 2, axis=0), [[0.0, 1.0], [5.0, 5.0]]])
    order = np.random.default_rng(4).permutation(len(v))
    v = v[order]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>")
    d = np.sqrt(((v[:, None] - v[None]) ** 2).sum(-1))
    for condition, ids in ((None, range(len(v))), (F.col("id") % 3 == 0, range(0, len(v), 3))):
        got = {}
        for r in em.knn_graph(df, 4, 8, condition).collect():
            got.setdefault(r.id, []).append((r["rank"], r.neighbour, r.distance))
        assert sorted(got) == list(ids)
        for i in ids:
            want = sorted((d[i, j], j) for j in range(len(v)) if j != i)[:4]
            assert [(x, n) for _, n, x in sorted(got[i])] == want
    assert len(searched[0]) == 6 and sum(a for _, a in searched[0]) == 4 and sum(a for _, a in searched[1]) < 4
