"""Substring dedup: MinHash bands over paragraphs, exact Jaccard, components, repeated passages.

Paragraphs are lines. A passage that stands inside longer lines of own text makes the lines
unlike, so passages are also sought in sentences: units that end at a line end or at ``.``, ``!`` or
``?`` before a blank, of which equal ones in several documents form stretches.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from targetlens.llm.common import Scratch, boxed, let, row_identity, unboxed, without_lines
from targetlens.llm.components import connected_components
from targetlens.llm.line_dedup import signed, wanted_lines
from targetlens.llm.linking import bucket_links, links_between
from targetlens.llm.phrases import Filter

SHINGLE = 5
MIN_SIMILARITY = 0.8
RECALL = 0.99
ROWS_PER_BAND = 4
#: Repeated paragraphs that follow each other are marked as a passage from this many words on.
MIN_WORDS = 50
#: Other paragraphs that a repeated passage may have between two repeated ones.
MAX_GAP = 1
#: Differing bits, one of each MinHash value, above which two paragraphs are not worth an exact
#: check; at MIN_SIMILARITY so many are three standard deviations away.
MAX_SKETCH_DISTANCE = 9
#: Zero-width ends of sentences, alike in Python and Java.
SENTENCE_END = r"(?<=\n)|(?<=[.!?][ \t])"
CELLS = 1 << 21
#: A document's sentences that others hold, and its paragraphs of a class.
SHARED = "array<struct<number int, n_words int, class_id bigint>>"
REPEATED = ("line", "n_words", "class_id", "kept_id", "kept_line", "kept", "across", "run_words", "passage_words")


def tuned_bands(similarity: float, rows: int, recall: float) -> int:
    """Fewest bands of ``rows`` values that let pairs of ``similarity`` collide with ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - similarity ** rows)))


BANDS = tuned_bands(MIN_SIMILARITY, ROWS_PER_BAND, RECALL)
VALUES = BANDS * ROWS_PER_BAND
#: Shorter paragraphs have too few shingles to be similar enough without being equal.
FEWEST_WORDS = int(round(MIN_SIMILARITY / (1 - MIN_SIMILARITY))) + SHINGLE - 1
_RNG = np.random.default_rng(20)
_TIMES = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(SHINGLE)], dtype=np.uint64)


def signatures(paragraphs: list[list[str]]) -> np.ndarray:
    """MinHash values (32 bits each) of the word shingles of each paragraph, all of a text together.

    A paragraph of fewer words than a shingle has one shingle: all of them.
    """
    sizes = np.array([len(p) for p in paragraphs])
    hashes = np.array([xxh64_intdigest(w) for p in paragraphs for w in p], dtype=np.uint64)
    padded = np.concatenate([hashes, np.zeros(SHINGLE, dtype=np.uint64)])
    place = np.arange(len(hashes))
    left = np.repeat(np.cumsum(sizes), sizes) - place  # words of the paragraph from here on
    shingles = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(SHINGLE):
        shingles += np.where(left > k, padded[place + k] * _POWERS[k], np.uint64(0))
    is_start = place == np.repeat(np.cumsum(sizes) - sizes, sizes)
    shingles = shingles[(left >= SHINGLE) | is_start]
    shingles ^= shingles >> np.uint64(31)
    counts = np.maximum(sizes - SHINGLE + 1, 1)
    starts = np.cumsum(counts) - counts
    out = np.empty((len(paragraphs), VALUES), dtype=np.int64)
    step = max(1, CELLS // max(1, len(shingles)))
    for at in range(0, VALUES, step):
        cells = shingles[:, None] * _TIMES[at:at + step] + _PLUS[at:at + step]
        out[:, at:at + step] = (np.minimum.reduceat(cells, starts, axis=0) >> np.uint64(33)).astype(np.int64)
    return out.astype(np.int32)


def band_keys(values: np.ndarray) -> np.ndarray:
    """One long per band and paragraph."""
    keys = np.zeros((len(values), BANDS), dtype=np.uint64)
    for k in range(ROWS_PER_BAND):
        keys = (keys ^ values[:, k::ROWS_PER_BAND].astype(np.uint32)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(32)
    return ((keys + np.arange(BANDS, dtype=np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)).view(np.int64)


def bit_sketch(values: np.ndarray) -> np.ndarray:
    """A bit of each MinHash value in one long."""
    bits = (values.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(31)
    return (bits.astype(np.int64) << np.arange(VALUES)).sum(axis=1)


def _paragraph_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, lines, places, sizes, keys, values = [], [], [], [], [], []
        for row, text in enumerate(batch.column(2)):
            found = [(i, x.lower().split()) for i, x in enumerate((text.as_py() or "").split("\n"))]
            found = [(i, w) for i, w in found if w]
            if not found:
                continue
            rows += [row] * len(found)
            lines += [i for i, _ in found]
            places += range(len(found))
            sizes += [len(w) for _, w in found]
            keys += [signed(xxh64_intdigest(" ".join(w))) for _, w in found]
            values.append(signatures([w for _, w in found]))
        take = pa.array(rows, pa.int64())
        values = np.concatenate(values) if values else np.zeros((0, VALUES), dtype=np.int32)
        long = np.array(sizes, dtype=np.int64) >= FEWEST_WORDS
        ends = np.concatenate([[0], np.cumsum(long * BANDS)])
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(take), batch.column(1).take(take), pa.array(lines, pa.int32()),
            pa.array(places, pa.int32()), pa.array(sizes, pa.int32()), pa.array(keys, pa.int64()),
            pa.array(bit_sketch(values), pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(band_keys(values[long]).ravel(), pa.int64())),
        ], names=["_id", "_h", "line", "place", "n_words", "node", "sketch", "bands"])


def paragraph_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, line, place, n_words, node, sketch, bands) of every paragraph: a line with a word.

    ``place`` counts the paragraphs of a text, ``line`` its lines, both from 0; ``node`` is the
    hash of the paragraph in lower case with single blanks. Paragraphs too short to be similar
    enough without being equal have no bands.
    """
    schema = T.StructType([
        T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_h", T.LongType()),
        T.StructField("line", T.IntegerType()), T.StructField("place", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()), T.StructField("node", T.LongType()),
        T.StructField("sketch", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
    ])
    return docs.select(*row_identity(id_col, text_col), F.col(text_col).alias("t")).mapInArrow(_paragraph_batches, schema)


def shingle_set(text: Column) -> Column:
    """Distinct hashes of the word shingles of a paragraph."""
    words = F.array_remove(F.split(F.lower(text), r"\s+"), "")
    size = lambda w: F.least(F.size(w), F.lit(SHINGLE))
    return let(words, lambda w: F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.size(w) - size(w) + 1), lambda i: F.xxhash64(F.slice(w, i, size(w)))
    )))


def jaccard(a: Column, b: Column) -> Column:
    return let(F.size(F.array_intersect(a, b)), lambda both: both / (F.size(a) + F.size(b) - both))


def _similar_members(inside: pd.DataFrame):
    """Function of a shingle set: the members that are similar enough to it."""
    names, sizes = inside["node"].to_numpy(), inside["s"].map(len).to_numpy()
    shingles = np.concatenate(list(inside["s"])) if len(inside) else np.zeros(0, dtype=np.int64)
    owner = np.repeat(np.arange(len(inside)), sizes)
    order = np.argsort(shingles, kind="stable")
    shingles, owner = shingles[order], owner[order]

    def similar(end) -> np.ndarray:
        low, high = np.searchsorted(shingles, end.s, "left"), np.searchsorted(shingles, end.s, "right")
        met = [owner[a:b] for a, b in zip(low, high) if b > a]
        if not met:
            return names[:0]
        common = np.bincount(np.concatenate(met), minlength=len(inside))
        return names[common >= MIN_SIMILARITY * (len(end.s) + sizes - common) - 1e-9]

    return similar, None


def repeated_paragraphs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """One row per paragraph that occurs again: ``_id``, ``_h``, line, place, n_words, class_id, kept_id,
    kept_line, kept, across, run_words, passage_words and in_passage.

    Paragraphs that are equal, or that share a MinHash band and have an exact Jaccard similarity of
    MIN_SIMILARITY on five-word shingles, are linked; connected ones are a class, named by one of
    its hashes. A class has two places at least, in one document or (``across``) in several. The
    first paragraph of a class by (id, text hash, line), NULL ids last, is kept, the others can be
    removed. ``run_words`` counts the words of the neighbouring paragraphs of classes across
    documents; ``passage_words`` those of all repeated paragraphs that follow each other with up to
    MAX_GAP other paragraphs between two of them, and ``in_passage`` tells if they are ``min_words``
    or more. NULL and empty texts have no paragraphs; repeated rows hold the same paragraphs and are
    reported once; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(paragraph_table(docs, id_col, text_col))
    place = F.struct(F.isnull("_id").alias("no"), F.col("_id").alias("id"), F.col("_h").alias("h"), F.col("line").alias("line"))
    nodes = scratch.keep(found.groupBy("node").agg(
        F.min("sketch").alias("sketch"), F.first("bands").alias("bands"), F.count(F.lit(1)).alias("weight"),
        F.min(place).alias("first"), F.max(place).alias("last"),
    ))
    members = nodes.select(F.explode("bands").alias("bucket"), "node")

    def near(a: Column, b: Column) -> Column:
        return F.bit_count(a.bitwiseXOR(b)) <= MAX_SKETCH_DISTANCE

    def shingle_sets(wanted_nodes: DataFrame) -> DataFrame:
        wanted = scratch.keep(nodes.join(wanted_nodes.distinct(), "node", "left_semi").select(
            F.col("first.id").alias("_id"), F.col("first.h").alias("_h"), F.col("first.line").alias("line"), "node"
        ))
        return scratch.keep(wanted_lines(docs, wanted, id_col, text_col).select("node", shingle_set(F.col("text")).alias("s")))

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = scratch.keep(pairs)
        sets = shingle_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        left, right = sets.select(F.col("node").alias("a"), F.col("s").alias("sa")), sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
        return pairs.join(left, "a").join(right, "b").where(jaccard(F.col("sa"), F.col("sb")) >= MIN_SIMILARITY).select("a", "b")

    def settle(ends: DataFrame, inside: DataFrame) -> DataFrame:
        inside = scratch.keep(inside)
        return links_between(ends, inside, shingle_sets(inside.select("node")), _similar_members)

    links = bucket_links(members, nodes, near, verify, scratch, settle)
    scratch.only(found, nodes, links)
    component = connected_components(links).withColumnRenamed("node", "n")
    placed = nodes.join(component, F.col("node") == F.col("n"), "left").select(
        "node", "first", "last", F.coalesce("component", "node").alias("class_id")
    )
    classes = placed.groupBy("class_id").agg(F.min("first").alias("head"), F.max("last").alias("tail")).where(
        F.col("head") != F.col("tail")
    ).withColumn("across", (F.col("head.h") != F.col("tail.h")) | ~F.col("head.id").eqNullSafe(F.col("tail.id")))
    named = placed.join(classes, "class_id").select(F.col("node").alias("n"), "class_id", "head", "across")
    repeated = found.drop("sketch", "bands").join(named, F.col("node") == F.col("n")).drop("n").distinct()
    in_text = W.partitionBy("_id", "_h").orderBy("place")
    of_kind = W.partitionBy("_id", "_h", "across").orderBy("place")
    runs = repeated.withColumn("run", F.col("place") - F.row_number().over(of_kind))
    new = (F.col("place") - F.lag("place").over(in_text) > MAX_GAP + 1).cast("int")
    runs = runs.withColumn("passage", F.sum(F.coalesce(new, F.lit(0))).over(in_text))
    total = lambda *keys: F.sum("n_words").over(W.partitionBy("_id", "_h", *keys))
    runs = runs.withColumn("run_words", F.when(F.col("across"), total("across", "run")).otherwise(F.lit(0)))
    return runs.withColumn("passage_words", total("passage")).select(
        "_id", "_h", "line", "place", "n_words", "class_id", F.col("head.id").alias("kept_id"), F.col("head.line").alias("kept_line"),
        (F.col("_id").eqNullSafe(F.col("head.id")) & (F.col("_h") == F.col("head.h")) & (F.col("line") == F.col("head.line"))).alias("kept"),
        "across", "run_words", "passage_words", (F.col("passage_words") >= min_words).alias("in_passage"),
    )


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """The repeated paragraphs in unbroken runs of ``min_words`` words that other documents hold as well."""
    return repeated_paragraphs(docs, id_col, text_col, min_words).where(F.col("run_words") >= min_words).drop(
        "across", "run_words", "passage_words", "in_passage"
    )


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 0) -> DataFrame:
    """``docs`` without the paragraphs that are kept at another place; rows stay.

    With ``min_words``, only those in passages of that many words go.
    """
    gone = repeated_paragraphs(docs, id_col, text_col, min_words).where("in_passage and not kept").groupBy("_id", "_h").agg(
        F.sort_array(F.collect_set("line")).alias("gone")
    ).withColumnsRenamed({"_id": "r_id", "_h": "r_h"})
    rows = boxed(docs, id_col, text_col)
    joined = rows.join(gone, F.col("_id").eqNullSafe(F.col("r_id")) & (F.col("_h") == F.col("r_h")), "left")
    return joined.select(*unboxed(docs.columns, {text_col: without_lines(F.col("_row")[text_col], F.col("gone"))}))


def sentence_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, units): per distinct row the hash and number of words of each sentence in order.

    A hash is that of the words in lower case; units without a word are left out.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = re.compile(SENTENCE_END).split
        for part in parts:
            keys, sizes, ends = [], [], [0]
            for text in part.column(2):
                for unit in split((text.as_py() or "").lower()):
                    words = unit.split()
                    if words:
                        keys.append(signed(xxh64_intdigest(" ".join(words))))
                        sizes.append(len(words))
                ends.append(len(keys))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays([
                part.column(0), part.column(1), pa.ListArray.from_arrays(ends, pa.array(keys, pa.int64())),
                pa.ListArray.from_arrays(ends, pa.array(sizes, pa.int32())),
            ], names=["_id", "_h", "units", "sizes"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(*row_identity(id_col, text_col), F.col(text_col).alias("t")).mapInArrow(
        batches, f"_id {kind}, _h long, units array<long>, sizes array<int>")


def shared_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(_id, _h, n_sentences, n_shared, shared_words, longest, shared): per row its sentences that other rows hold as well.

    A stretch is a sequence of shared sentences with up to MAX_GAP others between two of them.
    ``shared_words`` are the words of the shared sentences in stretches of ``min_words`` or more,
    ``longest`` those of the longest stretch; ``shared`` lists every shared sentence (number, n_words,
    class_id: the hash that all its rows have) in order, whatever its stretch. Repeated rows are copies and share all of their
    sentences; NULL and empty texts have none. Sentences are counted once per text before the
    shuffle; a Bloom filter of bounded size thins out the texts' sentences before the exact join.
    """
    scratch = Scratch(docs.sparkSession)
    texts = scratch.keep(sentence_table(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()))
    once = texts.select(F.explode(F.array_distinct("units")).alias("fp"))
    shared = scratch.keep(once.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp"))
    may = Filter(shared, shared.count())

    def thinned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            units, sizes = part.column(1), part.column(2)
            fps = units.flatten().to_numpy(zero_copy_only=False)
            at = np.flatnonzero(may.holds(fps.view(np.uint64))) if len(fps) else np.zeros(0, dtype=np.int64)
            ends = np.cumsum(np.asarray(units.value_lengths().fill_null(0)))
            row = np.searchsorted(ends, at, side="right")
            first = np.concatenate([[0], ends])
            yield pa.RecordBatch.from_pydict({
                "row": part.column(0).take(pa.array(row)), "fp": pa.array(fps[at], pa.int64()), "place": pa.array((at - first[row]).astype(np.int32)),
                "size": sizes.flatten().take(pa.array(at))})

    maybe = texts.select("row", "units", "sizes").mapInArrow(thinned, "row long, fp long, place int, size int")
    # places of a text's shared sentences, in one row per text
    hits = maybe.join(shared, "fp", "left_semi").groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "size", "fp"))).alias("hits"))
    start = F.struct(F.lit(-MAX_GAP - 2).alias("last"), F.lit(0).alias("words"), F.lit(0).alias("total"), F.lit(0).alias("longest"))

    def step(state: Column, hit: Column) -> Column:
        new = hit["place"] - state["last"] > MAX_GAP + 1
        words = hit["size"] + F.when(new, 0).otherwise(state["words"])
        # a stretch counts from the sentence on with which it is long enough
        gain = F.when(words < min_words, 0).when(words - hit["size"] < min_words, words).otherwise(hit["size"])
        return F.struct(
            hit["place"].alias("last"), words.alias("words"), (state["total"] + gain).alias("total"), F.greatest(state["longest"], words).alias("longest"))

    found = hits.select("row", F.size("hits").alias("n"), F.aggregate("hits", start, step).alias("s"), F.col("hits").cast(SHARED).alias("shared"))
    rows = texts.select("row", "_id", "_h", F.size("units").alias("n_sentences"))
    zero = lambda c, name: F.coalesce(c, F.lit(0)).cast("long").alias(name)
    return rows.join(found, "row", "left").select(
        "_id", "_h", F.col("n_sentences").cast("long").alias("n_sentences"), zero(F.col("n"), "n_shared"), zero(F.col("s.total"), "shared_words"),
        zero(F.col("s.longest"), "longest"), F.coalesce("shared", F.array().cast(SHARED)).alias("shared"))


def passage_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per row of ``docs``: ``_id``, n_sentences, n_shared, longest, n_repeated, n_removable, removable_words,
    near_words, n_passage_words, repeated_words, n_shared_words, repeated, shared.

    Nothing is left out for being short: ``repeated`` lists every paragraph of a class with its class
    id, kept place and runs (see :func:`repeated_paragraphs`, columns REPEATED) and ``shared`` every
    sentence that others hold (see :func:`shared_stretches`), both in order; empty lists if none.
    ``n_repeated`` and ``repeated_words`` count the first, ``n_shared`` and ``n_shared_words`` the
    second, ``n_removable`` and ``removable_words`` the paragraphs kept at another place. Two flags
    ask for ``min_words``: ``near_words`` are the words of unbroken runs of so many of paragraphs that
    other documents repeat, equal or similar, and ``n_passage_words`` is the larger of these and the
    words of shared stretches of sentences. Repeated rows and NULLs as in the two parts.
    """
    run = F.when(F.col("run_words") >= min_words, F.col("n_words")).otherwise(0)
    lines = repeated_paragraphs(docs, id_col, text_col, min_words).groupBy("_id", "_h").agg(
        F.count(F.lit(1)).alias("n_repeated"), F.count_if(~F.col("kept")).alias("n_removable"),
        F.sum(F.when(~F.col("kept"), F.col("n_words")).otherwise(0)).alias("removable_words"), F.sum(run).alias("near_words"),
        F.sum("n_words").alias("repeated_words"), F.sort_array(F.collect_list(F.struct(*REPEATED))).alias("repeated"),
    ).withColumnsRenamed({"_id": "l_id", "_h": "l_h"})
    rows = shared_stretches(docs, id_col, text_col, min_words)
    joined = rows.join(lines, F.col("_id").eqNullSafe(F.col("l_id")) & (F.col("_h") == F.col("l_h")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_repeated", "n_removable", "removable_words", "near_words")]
    return joined.select(
        "_id", "n_sentences", "n_shared", "longest", *counts,
        F.greatest(F.coalesce("near_words", F.lit(0)), F.col("shared_words")).cast("long").alias("n_passage_words"),
        F.coalesce("repeated_words", F.lit(0)).cast("long").alias("repeated_words"),
        F.aggregate("shared", F.lit(0).cast("long"), lambda n, x: n + x["n_words"]).alias("n_shared_words"),
        F.coalesce("repeated", F.array().cast(lines.schema["repeated"].dataType)).alias("repeated"), "shared")
