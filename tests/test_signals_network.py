import itertools
import random

import pytest

from targetlens.operators import network as net
from targetlens.operators import signals as sig


def test_signals_fixture(spark):
    rows = [("A", "X", 10), ("A", "Y", 2), ("B", "X", 2), ("B", "Y", 20)]
    df = spark.createDataFrame(rows, "drug string, event string, count long")
    out = {(r.drug, r.event): r for r in sig.disproportionality(sig.pair_contingency(df)).collect()}
    ax = out["A", "X"]
    assert (ax.a, ax.b, ax.c, ax.d) == (10, 2, 2, 20)
    assert ax.ror > 10 and ax.ror_lower > 1 and ax.signal
    assert sig.top_signal_drugs(sig.disproportionality(sig.pair_contingency(df))).first().drug == "A"


def test_signals_without_counts_and_zero_cells(spark):
    df = spark.createDataFrame([("A", "X"), ("A ", "X"), ("B", "Y"), ("", "Y")], "drug string, event string")
    out = {(r.drug, r.event): r for r in sig.disproportionality(sig.pair_contingency(df)).collect()}
    assert out["A", "X"].a == 2 and out["A", "X"].ror is None and out["A", "X"].signal is False
    assert len(out) == 2


def test_overlap_and_hubs(spark):
    targets = spark.createDataFrame(
        [(" alb", "CTD"), ("GPC3", "CTD"), ("MMP9", "ChEMBL"), ("AKT1", "STITCH"), ("SRC", "CTD"), ("ALB", "ChEMBL")],
        "gene string, source string")
    disease = spark.createDataFrame([(g,) for g in ("ALB", "GPC3", "MMP9", "EGFR", "TP53")], "gene string")
    overlap = net.overlap_sources(targets, disease)
    got = {r.gene: r for r in overlap.collect()}
    assert set(got) == {"ALB", "GPC3", "MMP9"}
    assert got["ALB"].n_sources == 2 and got["ALB"].sources == "CTD;ChEMBL"
    edges = spark.createDataFrame(
        [("ALB", "GPC3"), ("GPC3", "MMP9"), ("MMP9", "AKT1"), ("SRC", "EGFR")], "protein1 string, protein2 string")
    nodes, links = net.ctpd_network(overlap, edges)
    assert nodes.count() == 5
    assert links.where("edge_type = 'ppi'").count() == 2 and links.count() == 8


def test_diamond(spark):
    edges = spark.createDataFrame(
        [("A", "B"), ("a ", "C"), ("B", "D"), ("C", "D"), ("B", "A"), ("D", "D")], "protein1 string, protein2 string")
    genes = spark.createDataFrame([(g,) for g in "ABCDE"], "gene string")
    got = {r.gene: r for r in net.hub_scores(edges, genes, with_betweenness=True).collect()}
    assert got["A"].ppi_degree == 2 and got["E"].ppi_degree == 0
    assert got["A"].ppi_hub_score >= got["E"].ppi_hub_score
    assert got["A"].ppi_betweenness == pytest.approx(1 / 6) and got["E"].ppi_betweenness == 0


def brute_graph(pairs):
    around = {}
    for a, b in pairs:
        around.setdefault(a, set()).add(b)
        around.setdefault(b, set()).add(a)
    clustering = {
        n: (2 * sum(1 for x, y in itertools.combinations(m, 2) if y in around[x]) / (len(m) * (len(m) - 1)) if len(m) > 1 else 0.0)
        for n, m in around.items()
    }
    flow = dict.fromkeys(around, 0.0)
    for s in around:
        order, dist, paths, before = [], {s: 0}, {s: 1.0}, {s: []}
        queue = [s]
        while queue:
            v = queue.pop(0)
            order.append(v)
            for w in around[v]:
                if w not in dist:
                    dist[w], paths[w], before[w] = dist[v] + 1, 0.0, []
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    paths[w] += paths[v]
                    before[w].append(v)
        delta = dict.fromkeys(order, 0.0)
        for w in reversed(order):
            for v in before[w]:
                delta[v] += paths[v] / paths[w] * (1 + delta[w])
            if w != s:
                flow[w] += delta[w]
    n = len(around)
    return clustering, {k: v / ((n - 1) * (n - 2)) for k, v in flow.items()}


def test_clustering_and_betweenness_against_brute_force(spark):
    rng = random.Random(3)
    pairs = {tuple(sorted(rng.sample("ABCDEFGHIJKL", 2))) for _ in range(20)} | {("X", "Y")}
    clustering, between = brute_graph(pairs)
    edges = net.edge_clean(spark.createDataFrame(sorted(pairs), "protein1 string, protein2 string"))
    got = {r.gene: r.ppi_clustering for r in net.clustering_coef(edges).collect()}
    assert got == pytest.approx(clustering)
    got = {r.gene: r.ppi_betweenness for r in net.betweenness(edges).collect()}
    assert got == pytest.approx(between)


def test_betweenness_in_batches_and_from_a_sample(spark):
    rng = random.Random(5)
    pairs = {tuple(sorted(rng.sample([f"N{i:02d}" for i in range(40)], 2))) for _ in range(90)}
    between = brute_graph(pairs)[1]
    edges = net.edge_clean(spark.createDataFrame(sorted(pairs), "protein1 string, protein2 string"))
    got = {r.gene: r.ppi_betweenness for r in net.betweenness(edges, state_rows=40 * 15).collect()}
    assert got == pytest.approx(between)
    # a loose bound ends the batches early, and the values stay near
    rough = {r.gene: r.ppi_betweenness for r in net.betweenness(edges, state_rows=40 * 10, error=0.05).collect()}
    assert max(abs(rough[g] - between[g]) for g in between) < 0.2 and rough != pytest.approx(between)


def test_venn(spark):
    rows = [("a", "s1"), ("a", "s2"), ("b", "s1"), ("c", "s2"), ("c", "s2"), ("d", "s2")]
    got = {r.region: r.n for r in net.venn_regions(spark.createDataFrame(rows, "gene string, set_name string")).collect()}
    assert got == {"s1&s2": 1, "s1": 1, "s2": 2}


def test_results_over_several_batches(spark, tmp_path):
    """A key that fails, fails again and then succeeds has one ok row in the end."""
    from targetlens.streaming.streams import latest_results, stream_results_append

    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in ([(1, "failed"), (2, "ok")], [(1, "failed"), (2, "failed")], [(1, "ok"), (3, "failed")]):
        spark.createDataFrame(rows, "id long, status string").coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema("id long, status string").parquet(source)
        stream_results_append(stream, f"{out}/rows", f"{out}/state").awaitTermination()
    got = {r["id"]: r["status"] for r in latest_results(spark, f"{out}/rows").collect()}
    assert got == {1: "ok", 2: "ok", 3: "failed"}
    stored = sorted((r["id"], r["batch"], r["status"]) for r in spark.read.parquet(f"{out}/rows").collect())
    assert stored == [(1, 0, "failed"), (1, 1, "failed"), (1, 2, "ok"), (2, 0, "ok"), (3, 0, "failed")]


def test_betweenness_steps_join_numbers(spark, monkeypatch):
    kinds, search = [], net._dependencies
    monkeypatch.setattr(net, "_dependencies", lambda links, starts: kinds.append(dict(links.dtypes)) or search(links, starts))
    edges = spark.createDataFrame([("A", "B"), ("B", "C"), ("C", "D")], "src string, dst string")
    got = {r.gene: r.ppi_betweenness for r in net.betweenness(edges).collect()}
    assert kinds == [{"node": "bigint", "neighbour": "bigint"}]
    assert got == {"A": 0.0, "B": pytest.approx(2 / 3), "C": pytest.approx(2 / 3), "D": 0.0}


def test_registered_betweenness_starts_from_every_node(spark, tmp_path):
    from targetlens.plans import network_queries as nq

    rng = random.Random(8)
    lines = [(order, line, rng.randrange(60)) for order in range(40) for line in range(1, 5)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber long, l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    pairs = {tuple(sorted((f"P{a[2]}", f"P{b[2]}"))) for a, b in zip(lines, lines[1:]) if a[0] == b[0] and a[2] != b[2]}
    between = brute_graph(pairs)[1]
    got = {r.gene: r.ppi_betweenness for r in nq.betweenness(spark, str(tmp_path)).collect()}
    assert len(got) > nq.SOURCES and got == pytest.approx(between, abs=1e-8)
    assert "LIMIT" not in nq.ORACLES["betweenness"]


@pytest.mark.parametrize("part_links", [4, 40, 1 << 20])
def test_betweenness_of_components_large_and_small(spark, part_links):
    rng = random.Random(9)
    pairs = {tuple(sorted(rng.sample([f"{c}{i:02d}" for i in range(12)], 2))) for c in "ABC" for _ in range(16)}
    pairs |= {(f"D{i:02d}", f"D{i + 1:02d}") for i in range(20)} | {("X", "Y")}
    between = brute_graph(pairs)[1]
    edges = net.edge_clean(spark.createDataFrame(sorted(pairs), "protein1 string, protein2 string"))
    got = {r.gene: r.ppi_betweenness for r in net.betweenness(edges, part_links=part_links).collect()}
    assert got == pytest.approx(between)
    starts = spark.createDataFrame([("A00",), ("D03",)], "gene string")
    some = [{r.gene: r.ppi_betweenness for r in net.betweenness(edges, starts, part_links=k).collect()} for k in (part_links, 1 << 20)]
    assert some[0] == pytest.approx(some[1])
