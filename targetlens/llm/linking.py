"""Links inside buckets of possibly similar items, without listing all pairs of a bucket."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.llm.common import Scratch, bounded

Near = Callable[[Column, Column], Column]
#: Rows of one side of a comparison task.
PIECE = 4096
#: Pairs that a call holds before they are confirmed.
WAITING = 1 << 16


def unordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def with_sketches(pairs: DataFrame, nodes: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, b) whose sketches are near."""
    left = nodes.select(F.col("node").alias("a"), F.col("sketch").alias("sa"))
    right = nodes.select(F.col("node").alias("b"), F.col("sketch").alias("sb"))
    return pairs.join(left, "a").join(right, "b").where(near(F.col("sa"), F.col("sb"))).select("a", "b")


def _spokes(members: DataFrame, near: Near) -> DataFrame:
    """(bucket, node, sketch, center, close): each member and the center of its bucket.

    The center is the heaviest member, the smallest node of equals. It is found by an aggregate
    and joined back, so a bucket of m members gives m - 1 rows.
    """
    order = F.struct(F.col("weight"), (-F.col("node")).alias("minus"), F.col("node"), F.col("sketch"))
    centers = members.groupBy("bucket").agg(F.max(order).alias("c"))
    return members.join(centers, "bucket").where(F.col("node") != F.col("c.node")).select(
        "bucket", "node", "sketch", F.col("c.node").alias("center"),
        near(F.col("sketch"), F.col("c.sketch")).alias("close"),
    )


def bucket_links(
    members: DataFrame, nodes: DataFrame, near: Near, verify: Callable[[DataFrame], DataFrame], scratch: Scratch,
    settle: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """Verified pairs (a, b) that connect everything the verified pairs of all buckets would.

    ``members`` has (bucket, node), two longs; ``nodes`` has one row per node with weight and
    sketch. Most buckets hold one node and some hold two: a count with the smallest and largest
    node finds them. In larger buckets, members that are verified
    against the bucket's center need no link among each other. Only the others are compared with
    all members of the bucket, by ``settle`` (see ``links_between``), so what is written grows with
    the links that are needed, not with the square of a group of copies. ``near`` is the cheap test
    on sketches, ``verify`` the exact one; ``settle`` gets both sides as (bucket, node).
    """
    # two longs per row are dealt by bucket and counted there; partial counts would only be wider
    crowds = scratch.keep(
        members.select("bucket", "node").repartition("bucket").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"))
        .where("n > 1 and lo != hi")
    )
    large = crowds.where("n > 2").select("bucket")
    inside = members.join(bounded(large, large.count()), "bucket", "left_semi").distinct()
    return links_inside(unordered(crowds.where("n = 2"), "lo", "hi"), inside, nodes, near, verify, scratch, settle)


def crowded(members: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) that are alone in a bucket, and the distinct (bucket, node) of larger buckets.

    A count with the smallest and largest node tells which buckets hold one node, two or more. Rows of ``members``
    may be repeated: a bucket of two nodes may then be among the larger ones. The rows are dealt by bucket once,
    for the counts and for what meets them again, however many buckets there are.
    """
    dealt = members.select("bucket", "node").repartition("bucket")
    counts = dealt.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("lo"), F.max("node").alias("hi"))
    held = scratch.keep(dealt.join(counts.where("n > 1 and lo != hi").hint("shuffle_hash"), "bucket"))
    return unordered(held.where("n = 2"), "lo", "hi"), held.where("n > 2").select("bucket", "node").distinct()


def links_inside(
    twos: DataFrame, inside: DataFrame, nodes: DataFrame, near: Near, verify: Callable[[DataFrame], DataFrame], scratch: Scratch,
    settle: Callable[[DataFrame, DataFrame], DataFrame],
) -> DataFrame:
    """``bucket_links`` of pairs and members that are found already; ``nodes`` needs the nodes of these buckets only."""
    twos = with_sketches(twos, nodes, near)
    crowd = scratch.keep(inside.join(nodes.select("node", "weight", "sketch"), "node"))
    around = scratch.keep(_spokes(crowd, near))
    first = scratch.keep(verify(twos.unionByName(unordered(around.where("close"), "node", "center")).distinct()))
    sure = first.select(F.col("a").alias("sa"), F.col("b").alias("sb"))
    ends = around.join(
        sure, (F.least("node", "center") == F.col("sa")) & (F.greatest("node", "center") == F.col("sb")), "left_anti"
    ).select("bucket", "node").distinct()
    ends = scratch.keep(ends)
    inside = scratch.keep(crowd.select("bucket", "node").join(ends.select("bucket").distinct(), "bucket", "left_semi"))
    return scratch.keep(first.unionByName(settle(ends, inside)).distinct())


def _dealt(ends: DataFrame, inside: DataFrame, facts: DataFrame, together: bool = True) -> DataFrame:
    """(bucket, i, j, node, end, facts, call) of both sides; a pair of pieces belongs to one call."""
    pieces = lambda df, name: df.groupBy("bucket").agg(
        F.count(F.lit(1)).alias(f"{name}_rows"), F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias(f"n_{name}"))
    # buckets of the same lines have their smallest member in common mostly, and so meet in one call
    anchors = inside.groupBy("bucket").agg(F.min("node").alias("anchor"))
    counts = pieces(ends, "ends").join(pieces(inside, "inside"), "bucket").join(anchors, "bucket")
    rows = counts.agg(F.sum(F.expr("ends_rows * n_inside + inside_rows * n_ends"))).first()[0] or 0
    calls = int(rows // (2 * PIECE)) + 1
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = ends.join(counts, "bucket").select("bucket", own("n_ends").alias("i"), upto("n_inside").alias("j"), "anchor", "node", F.lit(True).alias("end"))
    right = inside.join(counts, "bucket").select("bucket", upto("n_ends").alias("i"), own("n_inside").alias("j"), "anchor", "node", F.lit(False).alias("end"))
    call = F.pmod(F.xxhash64("anchor" if together else "bucket", "i", "j"), F.lit(calls))
    dealt = left.unionByName(right).join(facts, "node").withColumn("call", call).drop("anchor")
    if not together:
        return dealt
    # comparisons cost far more than their bytes tell, so the calls are not merged into fewer tasks
    tasks = min(calls, int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.repartition(tasks, "call")


def _hits(part: pd.DataFrame, names: list[str], near: Callable):
    """(rows of ends, rows of members, places of the near pairs in both) of a call sorted by bucket, i and j."""
    node, end = part["node"].to_numpy(), part["end"].to_numpy()
    key = part[["bucket", "i", "j"]].to_numpy()
    columns = {c: part[c].to_numpy() for c in names}
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])) if len(part) else []
    for a, b in zip(first, np.append(first[1:], len(part)), strict=True) if len(part) else []:
        side = end[a:b]
        asked, there = a + np.flatnonzero(side), a + np.flatnonzero(~side)
        for at in range(0, len(asked), 256):
            rows = asked[at:at + 256]
            hit = near({c: v[rows][:, None] for c, v in columns.items()}, {c: v[there][None, :] for c, v in columns.items()})
            hit &= node[rows][:, None] != node[there][None, :]
            yield rows, there, np.nonzero(hit)


def near_rows(ends: DataFrame, inside: DataFrame, facts: DataFrame, near: Callable) -> DataFrame:
    """(bucket, node, end): the ends and members that have a partner on the other side of their bucket.

    ``near(a, b)`` tells from the facts of two arrays of rows (as dictionaries of columns, ``a`` as a
    column and ``b`` as a row of a table) which pairs may be similar. Nothing large needs to be
    among the facts, so that only what is left must meet with its text.
    """
    dealt = _dealt(ends, inside, facts)
    names = [c for c in facts.columns if c != "node"]

    def partners(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bucket", "i", "j"], kind="stable")
        kept = np.zeros(len(part), dtype=bool)
        for asked, there, hit in _hits(part, names, near):
            kept[asked[hit[0]]] = True
            kept[there[hit[1]]] = True
        return part.loc[kept, ["bucket", "node", "end"]]

    return dealt.groupBy("call").applyInPandas(partners, "bucket long, node long, end boolean").distinct()


class Forest:
    """Links found among ``size`` members, and the pairs that wait for being confirmed many at a time."""

    def __init__(self, size: int, confirm: Callable[[np.ndarray, np.ndarray], np.ndarray]):
        self.size, self.confirm = size, confirm
        self.root = np.arange(size)
        self.asked = np.empty(0, dtype=np.int64)
        self.waiting: list[np.ndarray] = []
        self.rows = 0
        self.links: list[np.ndarray] = []

    def offer(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs of members that may be linked; those connected already need no check."""
        open_ = self.root[a] != self.root[b]
        pairs = np.unique(np.minimum(a, b)[open_] * self.size + np.maximum(a, b)[open_])
        self.waiting.append(pairs)
        self.rows += len(pairs)
        if self.rows >= WAITING:
            self.settle()

    def _join(self, pairs: np.ndarray) -> None:
        up = self.root
        for pair in pairs.tolist():
            a, b = divmod(pair, self.size)
            while up[a] != a:
                a = up[a]
            while up[b] != b:
                b = up[b]
            up[max(a, b)] = min(a, b)
        while (up[up] != up).any():
            up = up[up]
        self.root = up

    def settle(self) -> None:
        """Confirm what waits. A round takes the first pairs of each member, so that a group of copies is
        connected by the first round and few of its pairs are checked; twice as many where few are confirmed."""
        left = np.setdiff1d(np.concatenate([*self.waiting, np.empty(0, dtype=np.int64)]), self.asked)
        self.waiting, self.rows = [], 0
        most = 1
        while len(left):
            a, b = left // self.size, left % self.size
            take = np.zeros(len(left), dtype=bool)
            for side in (a, b):
                order = np.argsort(side, kind="stable")
                ranks = np.arange(len(left)) - np.searchsorted(side[order], side[order])
                take[order[ranks < most]] = True
            found = self.confirm(a[take], b[take])
            most = most * 2 if found.sum() * 8 < len(found) else 1
            self.asked = np.union1d(self.asked, left[take][~found])
            self.links.append(left[take][found])
            self._join(left[take][found])
            left = left[~take]
            left = left[self.root[left // self.size] != self.root[left % self.size]]


def links_together(
    ends: DataFrame, inside: DataFrame, facts: DataFrame, near: Callable, confirm: Callable[[pd.Series, pd.Series], np.ndarray],
) -> DataFrame:
    """As ``links_between``, for comparisons that cost far more than a bucket's row.

    Buckets of the same lines meet in one call mostly, and what one has connected or told apart is not compared
    again in another. ``near`` is as for ``near_rows``; ``confirm`` tests many pairs at once on their texts ``t``.
    """
    dealt = _dealt(ends, inside, facts)
    names = [c for c in facts.columns if c not in ("node", "t")]

    def forests(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["bucket", "i", "j"], kind="stable")
        nodes, place, member = np.unique(part["node"].to_numpy(), return_index=True, return_inverse=True)
        texts = part["t"].to_numpy()[place]
        forest = Forest(len(nodes), lambda a, b: confirm(texts[a], texts[b]))
        for a, b, hit in _hits(part, names, near):
            forest.offer(member[a][hit[0]], member[b][hit[1]])
        forest.settle()
        links = np.concatenate([*forest.links, np.empty(0, dtype=np.int64)])
        return pd.DataFrame({"a": nodes[links // len(nodes)], "b": nodes[links % len(nodes)]}) if len(links) else (
            pd.DataFrame({"a": [], "b": []}, dtype="int64"))

    return dealt.groupBy("call").applyInPandas(forests, "a long, b long").distinct()


def links_between(
    ends: DataFrame, inside: DataFrame, facts: DataFrame, lookup: Callable[[pd.DataFrame], Callable],
) -> DataFrame:
    """Links (a, b) that connect ``ends`` (bucket, node) to the similar members ``inside`` their buckets.

    Both sides of a bucket are dealt to pieces of about PIECE rows; a pair of pieces is compared
    exactly and gives a spanning forest of its similar pairs, so a group of m near copies has a few
    links per member, never its pairs. A call holds pairs of pieces with about 2 * PIECE rows in
    all, as most buckets are small. ``facts`` has what
    is compared per node; ``lookup`` turns the members of a piece into a function from an end to
    the members that may be linked to it and, if that needs confirming, a test of an end and a
    member, which is made only while the two are not connected yet.
    """
    dealt = _dealt(ends, inside, facts, together=False)

    def forest(part: pd.DataFrame) -> list[tuple[int, int]]:
        up: dict[int, int] = {}
        unlike: set[tuple[int, int]] = set()

        def root(x: int) -> int:
            while up.setdefault(x, x) != x:
                up[x] = up[up[x]]
                x = up[x]
            return x

        (similar, confirm), out = lookup(part[~part["end"]]), []
        for end in part[part["end"]].itertuples(index=False):
            for other in similar(end):
                a, b = root(int(end.node)), root(int(other))
                pair = (min(int(end.node), int(other)), max(int(end.node), int(other)))
                if a == b or pair in unlike:
                    continue
                if confirm is None or confirm(end, other):
                    up[max(a, b)] = min(a, b)
                    out.append(pair)
                else:
                    unlike.add(pair)
        return out

    def forests(parts: pd.DataFrame) -> pd.DataFrame:
        links = []
        for _, part in parts.groupby(["bucket", "i", "j"], sort=False):
            links += forest(part)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("call").applyInPandas(forests, "a long, b long").distinct()
