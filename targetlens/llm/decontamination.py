"""Benchmark decontamination: prefix-filtered join of shingles, then exact containment of windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from targetlens.llm.common import Scratch, bounded, boxed, let, plain_words, row_identity, same_row, unboxed

WINDOW = 10
SHINGLE = 5


def _shingles(words: Column, size: int) -> Column:
    """Array of the space-joined runs of ``size`` words."""
    last = F.size(words) - size + 1
    return F.when(
        last >= 1, F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(words, i, size), " "))
    ).otherwise(F.array().cast("array<string>"))


def benchmark_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Distinct windows with their shingles, and which item has which window.

    A window is ``WINDOW`` words of an item, or the whole item if it has fewer. Its shingles have
    ``SHINGLE`` words, or all words of the window if it has fewer. Items without words have none.
    """
    words = items.select(F.col(id_col).alias("item"), plain_words(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(WINDOW))
    last = F.size("w") - size + 1
    owned = words.select("item", F.explode(
        F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("w", i, size))
    ).alias("w")).distinct().select("item", F.array_join("w", " ").alias("window"), "w")
    tokens = owned.select("window", "w").distinct().select(
        "window", F.size("w").alias("len"),
        F.posexplode(let(F.col("w"), lambda w: F.transform(
            F.sequence(F.lit(1), F.size(w) - F.least(F.size(w), F.lit(SHINGLE)) + 1),
            lambda i: F.array_join(F.slice(w, i, F.least(F.size(w), F.lit(SHINGLE))), " "),
        ))).alias("off", "token"),
    )
    return tokens, owned.select("item", "window")


def occurrences(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(_id, _h, start, len, window) of every place where a benchmark window stands in a document,
    and the items of the windows.

    1. All document shingles that occur in the benchmark are found with their positions; their
       number is the corpus rarity of each shingle.
    2. For exact containment of a window one shingle must match, so the rarest one is its prefix:
       only prefix matches become candidates, cut by position and length.
    3. A candidate counts if every shingle of the window stands at its place.
    """
    scratch = Scratch(docs.sparkSession)
    tokens, owners = benchmark_windows(items)
    tokens = scratch.keep(tokens)
    owners = scratch.keep(owners)
    vocabulary = scratch.keep(tokens.select("token").distinct())
    lengths = [r[0] for r in tokens.select(F.least("len", F.lit(SHINGLE)).alias("k")).distinct().orderBy("k").collect()]
    number = vocabulary.count()

    def places(w: Column) -> Column:
        sized = [F.transform(_shingles(w, k), lambda s, i: F.struct(i.alias("pos"), s.alias("token"))) for k in lengths]
        return F.concat(*sized) if sized else F.array().cast("array<struct<pos:int,token:string>>")

    found = docs.select(
        *row_identity(id_col, text_col),
        F.explode(let(plain_words(F.col(text_col)), places)).alias("e"),
    ).select("_id", "_h", "e.pos", "e.token")
    hits = scratch.keep(found.join(bounded(vocabulary, number), "token", "left_semi").distinct())

    rarity = hits.groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    ranked = tokens.join(rarity, "token", "left").withColumn("df", F.coalesce("df", F.lit(0)))
    order = W.partitionBy("window").orderBy("df", "off")
    prefixes = scratch.keep(
        ranked.withColumn("rank", F.row_number().over(order)).where("rank = 1 and df > 0")
        .select("window", "len", "off", "token")
    )
    candidates = hits.join(bounded(prefixes, number), "token").select(
        "_id", "_h", (F.col("pos") - F.col("off")).alias("start"), "window", "len"
    ).where("start >= 0")
    needed = tokens.groupBy("window").agg(
        F.collect_list(F.struct("off", "token")).alias("parts"), F.count(F.lit(1)).alias("n_parts")
    )
    asked = candidates.join(bounded(needed, number), "window").select(
        "_id", "_h", "start", "len", "window", "n_parts", F.explode("parts").alias("p")
    ).select("_id", "_h", "start", "len", "window", "n_parts", (F.col("start") + F.col("p.off")).alias("pos"), F.col("p.token").alias("token"))
    there = hits.alias("t")
    verified = (
        asked.alias("a").join(
            there,
            F.col("a._id").eqNullSafe(F.col("t._id")) & (F.col("a._h") == F.col("t._h"))
            & (F.col("a.pos") == F.col("t.pos")) & (F.col("a.token") == F.col("t.token")),
        )
        .groupBy("a._id", "a._h", "a.start", "a.len", "a.window", "a.n_parts")
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n = n_parts").select("_id", "_h", "start", "len", "window")
    )
    return scratch.keep(verified), owners


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``_id``, ``_h``, n_words, n_hit, n_items, items_sha256, contaminated.

    A NULL or empty text has no words and is clean; so is every document if no item has words.
    Repeated rows get the same answer. The hash of no items is that of the empty string.
    """
    found, owners = occurrences(docs, items, id_col, text_col)
    keys = ["_id", "_h"]
    hit = (
        found.select(*keys, F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("at"))
        .distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n_hit"))
    )
    named = (
        found.select(*keys, "window").distinct().join(owners, "window")
        .select(*keys, F.col("item").cast("string").alias("item")).distinct()
        .groupBy(*keys).agg(
            F.count(F.lit(1)).alias("n_items"),
            F.sha2(F.array_join(F.sort_array(F.collect_list("item")), ","), 256).alias("items_sha256"),
        )
    )
    both = hit.alias("x").join(named.alias("y"), F.col("x._id").eqNullSafe(F.col("y._id")) & (F.col("x._h") == F.col("y._h"))).select(
        "x._id", "x._h", "n_hit", "n_items", "items_sha256"
    )
    rows = docs.select(*row_identity(id_col, text_col), F.size(plain_words(F.col(text_col))).cast("long").alias("n_words"))
    return rows.join(both, same_row(rows, both), "left").select(
        rows["_id"], rows["_h"], "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with the columns of ``docs``."""
    found, _ = occurrences(docs, items)
    tainted = found.select("_id", "_h").distinct()
    rows = boxed(docs, "doc_id", "text")
    return rows.join(tainted, same_row(rows, tainted), "left_anti").select(*unboxed(docs.columns))
