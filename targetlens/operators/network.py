"""Compound/disease overlap and interaction-network metrics."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.functions.columns import col, first_alias
from targetlens.functions.ordering import pct_rank, row_numbers
from targetlens.session import cut_lineage

# Accepted endpoint column names, in order of preference.
FIRST_ENDPOINT = ("protein1", "node1", "source", "gene1", "string_id1", "from", "source_node")
SECOND_ENDPOINT = ("protein2", "node2", "target", "gene2", "string_id2", "to", "target_node")


def normalize_keys(df: DataFrame, column: str, name: str = "gene") -> DataFrame:
    """Distinct trimmed upper-case keys without blanks."""
    return (
        df.select(F.upper(F.trim(col(column).cast("string"))).alias(name))
        .where(F.col(name) != "").distinct()
    )


def edge_clean(edges: DataFrame) -> DataFrame:
    """Undirected distinct edges (src < dst): trimmed, upper-case, no blanks, no self loops."""
    first, second = first_alias(edges, FIRST_ENDPOINT), first_alias(edges, SECOND_ENDPOINT)
    if first is None or second is None:
        raise ValueError("edge table needs two endpoint columns, e.g. protein1/protein2")
    key = lambda c: F.upper(F.trim(col(c).cast("string")))
    ends = edges.select(key(first).alias("_a"), key(second).alias("_b")).where(
        (F.col("_a") != "") & (F.col("_b") != "") & (F.col("_a") != F.col("_b"))
    )
    return ends.select(
        F.least("_a", "_b").alias("src"), F.greatest("_a", "_b").alias("dst")
    ).distinct()


def both_directions(edges: DataFrame) -> DataFrame:
    """(node, neighbour) from undirected edges."""
    ends = F.explode(
        F.array(
            F.struct(F.col("src").alias("node"), F.col("dst").alias("neighbour")),
            F.struct(F.col("dst").alias("node"), F.col("src").alias("neighbour")),
        )
    )
    return edges.select(ends.alias("e")).select("e.node", "e.neighbour")


def degree(edges: DataFrame) -> DataFrame:
    """(gene, ppi_degree): number of neighbours."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("gene"))
    return ends.groupBy("gene").agg(F.count(F.lit(1)).alias("ppi_degree"))


def edges_within(edges: DataFrame, genes: DataFrame) -> DataFrame:
    """Edges whose endpoints are both in ``genes(gene)``."""
    return edges.join(
        genes.select(F.col("gene").alias("src")).distinct(), "src", "left_semi"
    ).join(genes.select(F.col("gene").alias("dst")).distinct(), "dst", "left_semi").select(
        *edges.columns
    )


def triangles(edges: DataFrame) -> DataFrame:
    """(gene, triangles). Edges point from the lower to the higher degree.

    A node then points to at most sqrt(2 * edges) others, however many neighbours it has, so
    these lists are short and a triangle is a common member of the lists of an edge's two ends.
    """
    places = row_numbers(degree(edges), [F.col("ppi_degree"), F.col("gene")], "place").select("gene", "place")
    at = lambda end, name: places.select(F.col("gene").alias(end), F.col("place").alias(name))
    pointed = cut_lineage(
        edges.join(at("src", "_a"), "src").join(at("dst", "_b"), "dst")
        .select(F.least("_a", "_b").alias("u"), F.greatest("_a", "_b").alias("v"))
    )
    lists = pointed.groupBy("u").agg(F.collect_list("v").alias("_to"))
    closed = (
        pointed.join(lists, "u")
        .join(lists.select(F.col("u").alias("v"), F.col("_to").alias("_on")), "v")
        .select("u", "v", F.array_intersect("_to", "_on").alias("w"))
        .where(F.size("w") > 0)
    )
    per_node = closed.select(
        F.explode(F.concat(
            F.array(
                F.struct(F.col("u").alias("place"), F.size("w").alias("n")),
                F.struct(F.col("v").alias("place"), F.size("w").alias("n")),
            ),
            F.transform("w", lambda x: F.struct(x.alias("place"), F.lit(1).alias("n"))),
        )).alias("t")
    ).groupBy("t.place").agg(F.sum("t.n").alias("triangles"))
    return per_node.join(places, "place").select("gene", "triangles")


def clustering_coef(edges: DataFrame) -> DataFrame:
    """(gene, ppi_degree, ppi_clustering): local clustering coefficient."""
    edges = cut_lineage(edges)
    d = F.col("ppi_degree").cast("double")
    return (
        degree(edges).join(triangles(edges), "gene", "left")
        .select(
            "gene", "ppi_degree",
            F.when(
                d > 1, 2.0 * F.coalesce(F.col("triangles"), F.lit(0)) / (d * (d - 1.0))
            ).otherwise(F.lit(0.0)).alias("ppi_clustering"),
        )
    )


def sampled_nodes(edges: DataFrame, k: int) -> DataFrame:
    """(gene): ``k`` nodes in hash order, the same ones on every run; all of them in a smaller graph."""
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("gene")).distinct()
    return nodes.orderBy(F.md5(F.col("gene").cast("binary")), "gene").limit(k)


def _levels(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(node, flow, square): dependencies on a node summed over the sources ``starts(gene)``, by joins.

    All sources of the batch advance together, one join per distance. In an undirected graph the
    neighbours of a level lie in it or next to it, so a new level is told from the two before it
    and nothing else is remembered. Dependencies then flow back one level at a time.
    """
    levels = [cut_lineage(starts.select(F.col("gene").alias("source"), F.col("gene").alias("node"), F.lit(1.0).alias("paths")))]
    while True:
        reached = levels[-1].join(links, "node").groupBy("source", F.col("neighbour").alias("node")).agg(F.sum("paths").alias("paths"))
        for near in levels[-2:]:
            reached = reached.join(near.select("source", "node"), ["source", "node"], "left_anti")
        fresh = cut_lineage(reached)
        if fresh.isEmpty():
            break
        levels.append(fresh)
    dependency = levels[-1].withColumn("delta", F.lit(0.0))
    found = [dependency]
    for level in reversed(levels[1:-1]):
        shares = dependency.select("source", "node", ((1.0 + F.col("delta")) / F.col("paths")).alias("share"))
        credit = shares.join(links, "node").groupBy("source", F.col("neighbour").alias("node")).agg(F.sum("share").alias("share"))
        dependency = cut_lineage(level.join(credit, ["source", "node"], "left").select(
            "source", "node", "paths", (F.col("paths") * F.coalesce(F.col("share"), F.lit(0.0))).alias("delta")))
        found.append(dependency)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.where("source <> node").groupBy("node").agg(
        F.sum("delta").alias("flow"), F.sum(F.col("delta") * F.col("delta")).alias("square"))


#: Directed links of a part of the graph that one task searches, and of a pack of small components.
PART_LINKS, PACK_LINKS = 1 << 22, 1 << 13
#: Entries (node, source) that a task holds at once, sources at least, and visits of links of a task.
STATE_CELLS, TOGETHER, TASK_VISITS = 160_000, 8, 1 << 24
#: Neighbours of a node that are added column by column, and the share of all links from which a level is.
COLUMNS, FEW = 256, 50


def _neighbours(links_of: np.ndarray, first: np.ndarray, count: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, neighbour) of the links of ``nodes``: which of them, and the other end."""
    n = count[nodes]
    row = np.repeat(np.arange(len(nodes)), n)
    return row, links_of[np.arange(len(row)) + (first[nodes] - np.cumsum(n) + n)[row]]


def _added(at: np.ndarray, amounts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct places of ``at`` and the sum of the amounts there."""
    places, back = np.unique(at, return_inverse=True)
    return places, np.bincount(back, weights=amounts, minlength=len(places))


def _flows(first: np.ndarray, count: np.ndarray, links_of: np.ndarray, sources: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over the sources of the dependencies on each node, and of their squares.

    ``links_of[first[v]:first[v] + count[v]]`` are the neighbours of v. Some sources advance together. A level
    that few links leave takes those only and keeps them for the way back; for a larger one the columns of
    neighbours, nodes of most links first, are added up for all of these sources at once.
    """
    n, total = len(first), int(count.sum())
    order = np.argsort(-count, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    first, count, links_of, sources = first[order], count[order], place[links_of], place[sources]
    columns = [links_of[first[:m] + k] for k, m in enumerate(np.searchsorted(-count, -np.arange(min(count[0], COLUMNS)), side="left"))]
    longer = np.flatnonzero(count > COLUMNS)
    flow, square = np.zeros(n), np.zeros(n)

    def over_links(x: np.ndarray) -> np.ndarray:
        y, buffer = np.zeros_like(x), np.empty_like(x)
        for at in columns:
            m = len(at)
            np.take(x, at, axis=0, out=buffer[:m], mode="clip")
            y[:m] += buffer[:m]
        for v in longer:
            y[v] += x[links_of[first[v] + COLUMNS:first[v] + count[v]]].sum(axis=0)
        return y

    together = max(TOGETHER, STATE_CELLS // n)
    for begin in range(0, len(sources), together):
        some = sources[begin:begin + together]
        s = len(some)
        level, paths, delta = np.full((n, s), -1, dtype=np.int32), np.zeros((n, s)), np.zeros((n, s))
        level_at, paths_at, delta_at = level.ravel(), paths.ravel(), delta.ravel()
        fresh = some * s + np.arange(s)
        level_at[fresh], paths_at[fresh] = 0, 1.0
        left = total * s - int(count[some].sum())
        steps, depth = [], 0
        while left:  # links of nodes that are not reached yet
            depth += 1
            node = fresh // s
            if count[node].sum() * FEW < total * s:
                row, far = _neighbours(links_of, first, count, node)
                a, b = fresh[row], far * s + (fresh - node * s)[row]
                new = level_at[b] < 0
                a, b = a[new], b[new]
                fresh, more = _added(b, paths_at[a])
                steps.append((a, b))
            else:
                y = over_links(np.where(level == depth - 1, paths, 0.0))
                y[level >= 0] = 0.0
                fresh = np.flatnonzero(y)
                more = y.ravel()[fresh]
                steps.append(None)
            if not len(fresh):
                steps.pop()
                break
            level_at[fresh], paths_at[fresh] = depth, more
            left -= int(count[fresh // s].sum())
        for depth in range(len(steps), 1, -1):
            if steps[depth - 1] is None:
                share = np.divide(1.0 + delta, paths, out=np.zeros_like(paths), where=level == depth)
                delta += np.where(level == depth - 1, over_links(share) * paths, 0.0)
            else:
                a, b = steps[depth - 1]
                at, share = _added(a, paths_at[a] / paths_at[b] * (1.0 + delta_at[b]))
                delta_at[at] += share
        flow += delta.sum(axis=1)
        square += (delta * delta).sum(axis=1)
    return flow[place], square[place]


def _search_part(around: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
    """(node, flow, square) of one part of the graph, (node, around), from some of its nodes, (gene)."""
    if not len(around) or not len(starts):
        return pd.DataFrame({"node": [], "flow": [], "square": []})
    around = around.sort_values("node")
    nodes = around["node"].to_numpy()
    count = around["around"].map(len).to_numpy().astype(np.int64)
    links_of = np.searchsorted(nodes, np.concatenate(list(around["around"])))
    flow, square = _flows(np.cumsum(count) - count, count, links_of, np.sort(np.searchsorted(nodes, starts["gene"].to_numpy())))
    return pd.DataFrame({"node": nodes, "flow": flow, "square": square})


def _dependencies(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(node, flow, square): dependencies on a node summed over sources, and their squares.

    ``starts(gene, part, start)`` are all nodes with the part of the graph they lie in, and whether they are
    sources. A part is whole components with a bounded number of links: it is searched inside tasks, each for a
    share of its sources. Nodes of components that are too large for that have no part; those are searched by joins.
    """
    sources = starts.where("start")
    small, large = sources.where(F.col("part").isNotNull()), sources.where(F.col("part").isNull())
    inside = starts.where(F.col("part").isNotNull()).select("part", F.col("gene").alias("node"))
    around = cut_lineage(inside.join(links, "node").groupBy("part", "node").agg(F.collect_list("neighbour").alias("around")))
    sizes = around.groupBy("part").agg(F.sum(F.size("around")).alias("links")).join(
        small.groupBy("part").agg(F.count(F.lit(1)).alias("sources")), "part")
    visits = F.col("links") * F.col("sources")
    whole = sizes.agg(F.sum(visits)).first()[0] or 0
    # more sources a task where there are many parts, so that a part does not travel more often than there are tasks to fill
    share = max(TASK_VISITS, -(-whole // (8 * links.sparkSession.sparkContext.defaultParallelism)))
    shares = cut_lineage(sizes.select("part", F.greatest(F.lit(1), F.ceil(visits / share)).cast("long").alias("shares")))
    tasks = max(shares.agg(F.sum("shares")).first()[0] or 0, 1)
    tasks = max(tasks, min(3 * tasks, 1024))
    each = around.join(shares.select("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share")), "part")
    asked = small.join(shares, "part").select("part", F.pmod(F.xxhash64("gene"), F.col("shares")).alias("share"), "gene")
    # long work on few rows: more partitions than shares, so that seldom two of them meet in one task
    each, asked = (side.repartition(tasks, "part", "share") for side in (each, asked))
    found = each.groupBy("part", "share").cogroup(asked.groupBy("part", "share")).applyInPandas(
        _search_part, "node long, flow double, square double")
    if not large.isEmpty():
        found = found.unionByName(_levels(links, large))
    return found.groupBy("node").agg(F.sum("flow").alias("flow"), F.sum("square").alias("square"))


def _reached(links: DataFrame, starts: DataFrame) -> DataFrame:
    """(node): what can be reached from ``starts(gene)``."""
    fresh = seen = cut_lineage(starts.select(F.col("gene").alias("node")))
    while True:
        fresh = cut_lineage(links.join(fresh, "node", "left_semi").select(F.col("neighbour").alias("node")).distinct().join(seen, "node", "left_anti"))
        if fresh.isEmpty():
            return seen
        seen = cut_lineage(seen.unionByName(fresh))


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node it reaches over ``links(node, neighbour)``, given in both directions.

    A component so far takes the smallest name next to any of its nodes, and then that of the component it
    was named after, until no name changes.
    """
    named = cut_lineage(links.select("node").distinct().withColumn("component", F.col("node")))
    while True:
        beside = links.join(named.select(F.col("node").alias("neighbour"), "component"), "neighbour").groupBy("node").agg(F.min("component").alias("m"))
        target = cut_lineage(named.join(beside, "node").groupBy("component").agg(F.least("component", F.min("m")).alias("to")))
        if target.where("`to` < component").isEmpty():
            return named
        hop = target.join(target.select(F.col("component").alias("to"), F.col("to").alias("then")), "to").select("component", "then")
        named = cut_lineage(named.join(hop, "component").select("node", F.col("then").alias("component")))


def _parts(links: DataFrame, nodes: DataFrame, limit: int) -> DataFrame:
    """(node, part) of ``nodes(node)``: components, small ones in packs; no part for those of more than ``limit`` links.

    A graph of at most ``limit`` links is one part.
    """
    total = links.count()
    if total <= limit:
        return nodes.select("node", F.lit(0).cast("long").alias("part"))
    member = components(links)
    sizes = links.groupBy("node").agg(F.count(F.lit(1)).alias("n")).join(member, "node").groupBy("component").agg(F.sum("n").alias("links"))
    pack = min(PACK_LINKS, limit)
    packed = -1 - F.pmod(F.xxhash64("component"), F.lit(-(-total // pack)))
    part = F.when(F.col("links") <= pack // 8, packed).when(F.col("links") <= limit, F.col("component"))
    return member.join(sizes.select("component", part.alias("part")), "component").select("node", "part")


#: Rows (source, node) that a batch of sources may hold at once.
STATE_ROWS = 20_000_000


def betweenness(
    edges: DataFrame, sources: DataFrame | None = None, state_rows: int = STATE_ROWS, error: float | None = None,
    part_links: int = PART_LINKS,
) -> DataFrame:
    """(gene, ppi_betweenness): normalised betweenness from shortest-path counts.

    Components of up to ``part_links`` directed links are searched inside tasks, which share their sources out.
    Larger ones are searched by joins in batches of sources: a batch holds so many that its state stays within
    ``state_rows`` rows, whatever the size of the graph; its dependencies are summed per node before the next
    one starts. ``sources(gene)`` restricts the starting nodes (scaled up accordingly). With ``error``, sources
    come in batches in hash order, which end as soon as the largest standard error of a node's value, from the variance
    over the sources so far, is within it. Sums per node stay in tables; the driver sees counts.
    """
    edges = cut_lineage(edges.select("src", "dst"))
    names = row_numbers(degree(edges).select("gene"), [F.col("gene")], "_n")
    nodes = cut_lineage(names)
    end = lambda c, n: nodes.select(F.col("gene").alias(c), F.col("_n").alias(n))
    # the steps join numbers, which are shorter than names
    links = cut_lineage(both_directions(
        edges.join(end("src", "_a"), "src").join(end("dst", "_b"), "dst").select(F.col("_a").alias("src"), F.col("_b").alias("dst"))))
    starts = nodes if sources is None else nodes.join(sources.select("gene"), "gene", "left_semi")
    numbered = cut_lineage(row_numbers(starts, [F.md5(F.col("gene").cast("binary")), F.col("gene")], "_i"))
    n, total = nodes.count(), numbered.count()
    inside = nodes.select(F.col("_n").alias("node"))
    if sources is not None and links.count() > part_links:
        inside = _reached(links, numbered.select(F.col("_n").alias("gene")))
        links = cut_lineage(links.join(inside, "node", "left_semi"))
    placed = cut_lineage(_parts(links, inside, part_links).join(numbered.select(F.col("_n").alias("node"), "_i"), "node", "left"))
    # the state of parts lies inside their tasks, so that only joins need batches
    joined = error is not None or not placed.where(F.col("part").isNull()).isEmpty()
    size = max(1, state_rows // max(n, 1)) if joined else max(total, 1)
    scale = float(n) / ((n - 1.0) * (n - 2.0)) if n > 2 else None
    sums, done = None, 0
    while done < total:
        turn = F.coalesce((F.col("_i") > done) & (F.col("_i") <= done + size), F.lit(False))
        found = _dependencies(links, placed.select(F.col("node").alias("gene"), "part", turn.alias("start"))).withColumnRenamed("node", "_n")
        sums = found if sums is None else sums.unionByName(found).groupBy("_n").agg(F.sum("flow").alias("flow"), F.sum("square").alias("square"))
        sums = cut_lineage(sums)
        done = min(done + size, total)
        if error is not None and scale is not None and 1 < done < total:
            mean = F.col("flow") / done
            spread = F.sqrt(F.greatest(F.col("square") / done - mean * mean, F.lit(0.0)) / (done - 1.0)) * scale
            if (sums.agg(F.max(spread)).first()[0] or 0.0) <= error:
                break
    if sums is None or scale is None:
        return nodes.select("gene", F.lit(0.0).alias("ppi_betweenness"))
    return nodes.join(sums, "_n", "left").select(
        "gene", F.coalesce(F.col("flow") * (scale / done), F.lit(0.0)).alias("ppi_betweenness"))


def hub_scores(
    edges: DataFrame, genes: DataFrame | None = None, with_betweenness: bool = False, sample: int | None = None
) -> DataFrame:
    """Metrics of the requested genes (0 when absent) and the percentile rank of the degree.

    ``with_betweenness`` adds ppi_betweenness, from ``sample`` sources if that is given.
    """
    clean = cut_lineage(edge_clean(edges))
    metrics = clustering_coef(clean)
    if with_betweenness:
        metrics = metrics.join(betweenness(clean, None if sample is None else sampled_nodes(clean, sample)), "gene", "left")
    if genes is not None:
        metrics = normalize_keys(genes, "gene").join(metrics, "gene", "left")
    filled = metrics.fillna(0)
    return pct_rank(filled, "ppi_degree", "ppi_hub_score")


def overlap_sources(targets: DataFrame, disease: DataFrame) -> DataFrame:
    """Disease genes hit by compound targets: number and sorted list of the sources."""
    hits = (
        targets.select(
            F.upper(F.trim("gene")).alias("gene"), F.trim("source").alias("source")
        )
        .where(F.col("gene") != "").distinct()
        .join(normalize_keys(disease, "gene"), "gene", "left_semi")
    )
    return hits.groupBy("gene").agg(
        F.count(F.lit(1)).alias("n_sources"),
        F.array_join(F.sort_array(F.collect_list("source")), ";").alias("sources"),
    ).withColumns({"in_compound": F.lit(True), "in_disease": F.lit(True)})


def overlap_with_hubs(overlap: DataFrame, hubs: DataFrame) -> DataFrame:
    return overlap.join(hubs, "gene", "left")


def venn_regions(memberships: DataFrame) -> DataFrame:
    """Exclusive region sizes from (gene, set_name): one row per combination of sets that occurs."""
    return (
        memberships.select("gene", "set_name").distinct()
        .groupBy("gene").agg(F.array_join(F.sort_array(F.collect_list("set_name")), "&").alias("region"))
        .groupBy("region").agg(F.count(F.lit(1)).alias("n"))
    )


def ctpd_network(
    overlap: DataFrame,
    edges: DataFrame | None,
    compound: str = "Compound",
    disease: str = "Disease",
) -> tuple[DataFrame, DataFrame]:
    """Node and edge tables of the compound - target - disease network."""
    spark = overlap.sparkSession
    ends = spark.range(2).select(
        F.when(F.col("id") == 0, "compound").otherwise("disease").alias("node_id"),
        F.when(F.col("id") == 0, compound).otherwise(disease).alias("label"),
        F.when(F.col("id") == 0, "compound").otherwise("disease").alias("node_type"),
    )
    nodes = ends.unionByName(
        overlap.select(
            F.col("gene").alias("node_id"), F.col("gene").alias("label"),
            F.lit("target").alias("node_type"),
        )
    )
    links = overlap.select(
        F.explode(
            F.array(
                _link(F.lit("compound"), F.col("gene"), "compound_target", F.col("sources")),
                _link(F.col("gene"), F.lit("disease"), "disease_target", F.lit("disease")),
            )
        ).alias("e")
    ).select("e.*")
    if edges is not None:
        inside = edges_within(edge_clean(edges), overlap.select("gene"))
        links = links.unionByName(
            inside.select(
                F.col("src").alias("source"), F.col("dst").alias("target"),
                F.lit("ppi").alias("edge_type"), F.lit("STRING").alias("sources"),
            )
        )
    return nodes, links


def _link(source: Column, target: Column, kind: str, sources: Column) -> Column:
    return F.struct(
        source.alias("source"), target.alias("target"), F.lit(kind).alias("edge_type"),
        sources.alias("sources"),
    )


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """Row-bind by name; columns missing from a table are NULL."""
    out = tables[0]
    for nxt in tables[1:]:
        out = out.unionByName(nxt, allowMissingColumns=True)
    return out


def intersect_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def except_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that do not occur in ``right``."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")
