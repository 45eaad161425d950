"""Exact ranks and running totals over data of any size.

An unkeyed window sorts everything in one task, and a keyed window does the same to a hot key.
Here values are first collapsed to one row per distinct value (map-side combined, so ties of any
size cost nothing), then cut into value ranges; windows run inside a range and the ranges are
shifted by the totals before them. The collapsed rows are materialised once in the shared
checkpoint folder: they are read several times and their number decides between the two ways.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from targetlens.session import cut_lineage

ONE_TASK_ROWS = 500_000
#: Ranges that a range with too many rows is cut into, again and again until none has too many.
RANGES = 256
#: Cut ranges up to which their borders are sent to every executor.
BROADCAST_CUTS = 1000


def _matched(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """``left`` with the other columns of the matching rows of ``right``; NULL keys match each other."""
    names = {k: f"_key{i}" for i, k in enumerate(keys)}
    other = right.withColumnsRenamed(names)
    same = F.lit(True)
    for k, name in names.items():
        same = same & F.col(k).eqNullSafe(F.col(name))
    return left.join(other, same, how).drop(*names.values())


def _too_large(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.where(F.col("_n") > ONE_TASK_ROWS).drop("_n")


def _cuts_at_or_below(value: Column, cuts: Column) -> Column:
    """Number of the sorted ``cuts`` that are <= value, by binary search; 0 for a NULL value or no cuts."""
    steps, size = [], 1
    while size < RANGES:
        size *= 2
        steps.insert(0, size // 2)

    def advance(position: Column, step: Column) -> Column:
        probe = position + step
        inside = (probe <= F.size(cuts)) & (F.try_element_at(cuts, probe) <= value)
        return F.when(inside, probe).otherwise(position)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), advance)


def _ranged(rows: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame | None:
    """(Materialised) rows with ``_range``, which follows the order of ``value`` inside a group.

    None if every group fits one task. Otherwise groups and ranges of more than ONE_TASK_ROWS rows are
    cut into RANGES ranges at approximate quantiles of their own until none is too large, so ranges
    grow in number with the data and borders are rows of a table, which is written: a repeated task
    cuts at the same places.
    """
    keys = list(by)
    if not keys:
        if rows.count() <= ONE_TASK_ROWS:
            return None
    elif _too_large(rows, keys).isEmpty():
        return None
    probes = [i / RANGES for i in range(1, RANGES)]
    nodes = [*keys, "_range"]
    ranged = rows.withColumn("_range", F.lit(0).cast("long"))
    while True:
        large = cut_lineage(_too_large(ranged, nodes))
        n = large.count()
        if not n:
            return ranged
        few = F.broadcast if n <= BROADCAST_CUTS else lambda df: df
        inside = _matched(ranged, few(large), nodes, "inner")
        cuts = cut_lineage(inside.groupBy(*nodes).agg(F.array_distinct(F.percentile_approx(value, probes, 16 * RANGES)).alias("_cuts")))
        step = _cuts_at_or_below(F.col(value), F.col("_cuts"))
        ranged = _matched(ranged, few(cuts), nodes, "left").withColumn(
            "_range", F.col("_range") * RANGES + F.when(F.col("_cuts").isNull(), 0).otherwise(F.coalesce(step, F.lit(0)))).drop("_cuts")


def running_totals(
    df: DataFrame,
    value: str,
    sums: Mapping[str, Column],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """One row per (by, value) with every sum and its inclusive running total ``cum_<name>``."""
    keys = list(by)
    per_value = cut_lineage(
        df.groupBy(*keys, value).agg(*[c.alias(n) for n, c in sums.items()])
    )
    ranged = _ranged(per_value, value, keys)
    direction = F.col(value).desc() if descending else F.col(value).asc()
    if ranged is None:
        upto = W.partitionBy(*keys).orderBy(direction).rowsBetween(W.unboundedPreceding, 0)
        return per_value.withColumns({f"cum_{n}": F.sum(n).over(upto) for n in sums})
    range_order = F.col("_range").desc() if descending else F.col("_range").asc()
    before = W.partitionBy(*keys).orderBy(range_order).rowsBetween(W.unboundedPreceding, -1)
    shifts = (
        ranged.groupBy(*keys, "_range")
        .agg(*[F.sum(n).alias(n) for n in sums])
        .select(
            *keys, "_range",
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_before_{n}") for n in sums],
        )
    )
    inside = (
        W.partitionBy(*keys, "_range").orderBy(direction).rowsBetween(W.unboundedPreceding, 0)
    )
    joined = _matched(ranged, shifts, [*keys, "_range"], "inner")
    return joined.withColumns(
        {f"cum_{n}": F.sum(n).over(inside) + F.col(f"_before_{n}") for n in sums}
    ).drop("_range", *[f"_before_{n}" for n in sums])


def value_ranks(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Per distinct non-null value: ``n`` rows, ``avg_rank``, ``min_rank`` and group size ``n_all``.

    ``weight`` names a column of multiplicities when the rows are already counts.
    """
    present = df.where(F.col(value).isNotNull())
    size = F.sum(weight) if weight else F.count(F.lit(1))
    ranked = running_totals(present, value, {"n": size}, by)
    sizes = ranked.groupBy(*by).agg(F.sum("n").alias("n_all"))
    if by:
        ranked = ranked.join(sizes, list(by))
    else:
        ranked = ranked.withColumn("n_all", sizes.scalar())
    return ranked.select(
        *by, value, "n", "n_all",
        (F.col("cum_n") - F.col("n") + 1).alias("min_rank"),
        (F.col("cum_n") - (F.col("n") - 1) / 2.0).alias("avg_rank"),
    )


def pct_rank(
    df: DataFrame, value: str, name: str, by: Sequence[str] = (), descending: bool = False
) -> DataFrame:
    """Add ``name``: average-tie percentile rank in (0, 1]; NULL values get 0.5."""
    ranks = value_ranks(df, value, by)
    position = F.col("n_all") + 1 - F.col("avg_rank") if descending else F.col("avg_rank")
    scores = ranks.select(*by, value, (position / F.col("n_all")).alias(name))
    return df.join(scores, [*by, value], "left").withColumn(name, F.coalesce(name, F.lit(0.5)))


def row_numbers(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``name``: 1..n in the given total order, with no task seeing more than its range.

    The range-sorted rows are written once to the shared checkpoint folder, so that the row
    numbers stay the same if executors are lost.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    part = F.shiftright("_place", 33)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    shifts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(shifts), "_part")
        .withColumn(name, (within + F.col("_before") + 1).cast("long"))
        .drop("_place", "_part", "_before")
    )


def top_rows(df: DataFrame, order: Sequence[Column], n: int, name: str | None = None) -> DataFrame:
    """First ``n`` rows in the given total order (a top-k plan), optionally numbered."""
    head = df.orderBy(*order).limit(n)
    if name is None:
        return head
    return head.withColumn(name, F.row_number().over(W.orderBy(*order)).cast("long"))


def bh_adjust(
    df: DataFrame, p_value: str, name: str = "p_adjust", by: Sequence[str] = ()
) -> DataFrame:
    """Add Benjamini-Hochberg adjusted p-values; a missing p counts as 1."""
    keys = list(by)
    tests = cut_lineage(df.withColumn("_p", F.coalesce(F.col(p_value), F.lit(1.0))))
    fits = tests.count() <= ONE_TASK_ROWS if not keys else _too_large(tests, keys).isEmpty()
    if fits:
        up = W.partitionBy(*keys).orderBy("_p")
        down = W.partitionBy(*keys).orderBy(F.col("_p").desc())  # with all ties of the current p
        share = F.col("_p") * F.count(F.lit(1)).over(W.partitionBy(*keys)) / F.row_number().over(up)
        out = tests.withColumn("_raw", share).withColumn(name, F.min("_raw").over(down))
        return out.withColumn(name, F.least(F.lit(1.0), F.col(name))).drop("_p", "_raw")
    ranked = value_ranks(tests, "_p", keys).select(
        *keys, "_p",
        (F.col("_p") * F.col("n_all") / (F.col("min_rank") + F.col("n") - 1)).alias("_raw"),
    )
    adjusted = suffix_minimum(ranked, "_p", "_raw", name, keys)
    out = tests.join(adjusted, [*keys, "_p"])
    return out.withColumn(name, F.least(F.lit(1.0), F.col(name))).drop("_p")


def suffix_minimum(
    df: DataFrame, value: str, target: str, name: str, by: Sequence[str] = ()
) -> DataFrame:
    """Per (by, value): the least ``target`` at this value or any larger one."""
    keys = list(by)
    ranged = _ranged(df, value, keys)
    inside_keys = keys
    if ranged is not None:
        df = ranged
        inside_keys = [*keys, "_range"]
    down = (
        W.partitionBy(*inside_keys).orderBy(F.col(value).desc())
        .rowsBetween(W.unboundedPreceding, 0)
    )
    out = df.withColumn(name, F.min(target).over(down))
    if ranged is not None:
        after = W.partitionBy(*keys).orderBy(F.col("_range").desc()).rowsBetween(
            W.unboundedPreceding, -1
        )
        later = (
            df.groupBy(*inside_keys).agg(F.min(target).alias("_m"))
            .select(*inside_keys, F.min("_m").over(after).alias("_later"))
        )
        out = _matched(out, later, inside_keys, "inner").withColumn(name, F.least(name, "_later"))
    return out.select(*keys, value, name)


def quantiles(
    df: DataFrame, value: str, probes: Mapping[str, float], by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Exact linear-interpolation quantiles, one column per probe, from value counts."""
    keys = list(by)
    ranks = value_ranks(df, value, keys, weight)
    top = F.col("min_rank") + F.col("n") - 1
    picks = []
    for name, q in probes.items():
        place = (F.col("n_all") - 1) * F.lit(float(q)) + 1
        picks += [
            F.min(F.when(top >= F.floor(place), F.col(value))).alias(f"_lo_{name}"),
            F.min(F.when(top >= F.ceil(place), F.col(value))).alias(f"_hi_{name}"),
            F.max(place - F.floor(place)).alias(f"_w_{name}"),
        ]
    found = ranks.groupBy(*keys).agg(*picks)
    mix = lambda n: (
        F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")
    )
    return found.select(*keys, *[mix(n).alias(n) for n in probes])
