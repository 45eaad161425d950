"""Fuzzy line dedup: SimHash and pigeonhole blocks of normalised lines, edit similarity, components.

Three forms of fingerprint: ``segments`` (the registered one, see ``line_blocks``), block choices of a
64-bit SimHash of words, and MinHash bands over character n-grams (``grams``).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from targetlens.llm import line_blocks
from targetlens.llm.common import Scratch, bounded, boxed, row_identity, unboxed, without_lines
from targetlens.llm.components import connected_components
from targetlens.llm.edit_distances import edit_distances
from targetlens.llm.linking import bucket_links, crowded, links_between, links_inside, links_together, near_rows
from targetlens.llm.simhash_dedup import block_keys, close_members, hamming_near

Similar = Callable[[str, str], bool]

MIN_SIMILARITY = 0.8
MAX_DISTANCE = 3
BLOCKS = 6
#: Characters of an n-gram, MinHash values of a line, and how many of 64 low bits of them may
#: differ in a pair that is worth an edit check; see the recall in the README and in the tests.
GRAM = 5
VALUES = 72
MAX_SKETCH_DISTANCE = 26
#: Characters up to which a line has bands of two values: a typo changes most n-grams of a short line.
SHORT = 32
#: N-grams that are counted in one call.
GRAMS_TOGETHER = 1 << 16
_RNG = np.random.default_rng(31)
_TIMES = _RNG.integers(0, 1 << 31, VALUES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(GRAM)], dtype=np.uint64)
WORD = re.compile(r"[^\W_]+")
MARK = re.compile(r"[^\w\s\x00-\x7f]+")
ASCII_MARKS = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
ASCII_MARKS_IN_LINES = ASCII_MARKS[:10] + b"\n" + ASCII_MARKS[11:]
#: Total weight of a line up to which four counters fit in one 64-bit number.
LANE = (1 << 16) - 1
#: Words of the texts that are counted in one call, at least.
WORDS_TOGETHER = 30_000


def line_words(line: str) -> list[str]:
    """Lower-case runs of letters and digits; a line without any gives its stretches between blanks."""
    return WORD.findall(line.lower()) or line.split()


def normalised(line: str) -> str:
    """The words of a line in lower case with single blanks, as ``line_words`` finds them."""
    low = line.lower()
    if not low.isascii() and MARK.search(low):
        low = MARK.sub(" ", low)
    # the other marks are single bytes of UTF-8
    plain = low.encode("utf-8", "surrogatepass").translate(ASCII_MARKS).decode("utf-8", "surrogatepass")
    return " ".join(plain.split()) or " ".join(line.split())


def normal_lines(text: str) -> Iterator[tuple[int, str]]:
    """(place, normal form) of the lines of a text that hold a character that is not blank."""
    lines, low = text.split("\n"), text.lower()
    if not low.isascii():
        low = MARK.sub(" ", low)
    plain = low.encode("utf-8", "surrogatepass").translate(ASCII_MARKS_IN_LINES).decode("utf-8", "surrogatepass").split("\n")
    for i, line in enumerate(plain):
        words = line.split()
        if words:
            yield i, " ".join(words)
        elif lines[i] and not lines[i].isspace():
            yield i, " ".join(lines[i].split())


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def line_fingerprints(lines: list[list[str]]) -> np.ndarray:
    """64-bit SimHash of each line's words, all lines of a text together.

    A word weighs its length, as the short words of a language are in most lines: without weights
    unlike lines would meet by chance. Counters of 16 bits are summed four to a number; a line too
    heavy for them is counted bit by bit.
    """
    sizes = np.array([len(w) for w in lines])
    words = [w for ws in lines for w in ws]
    hashes = np.fromiter(map(xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    weights = np.fromiter(map(len, words), dtype=np.uint64, count=len(words))
    starts = np.cumsum(sizes) - sizes
    totals = np.add.reduceat(weights, starts)
    set_bits = np.zeros((len(lines), 64), dtype=bool)
    for shift in range(16):
        lanes = (hashes >> np.uint64(shift) & np.uint64(0x0001_0001_0001_0001)) * np.minimum(weights, LANE)
        sums = np.add.reduceat(lanes, starts).astype("<u8").view("<u2").reshape(-1, 4)
        set_bits[:, shift::16] = 2 * sums.astype(np.int64) > totals.astype(np.int64)[:, None]
    for line in np.flatnonzero(totals > LANE):
        part = slice(starts[line], starts[line] + sizes[line])
        for bit in range(64):
            held = weights[part][(hashes[part] >> np.uint64(bit) & np.uint64(1)).astype(bool)].sum()
            set_bits[line, bit] = 2 * int(held) > int(totals[line])
    return np.packbits(set_bits, axis=1, bitorder="little").view("<i8").ravel()


def gram_sketches(lines: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """64 low bits of MinHash values of each normalised line's n-grams, and its band keys.

    Lines of up to SHORT characters have keys of two values, lines that can be similar to longer
    ones have keys of three; those in between have both, so any two similar lines share a kind.
    """
    sizes = np.array([len(x) for x in lines])
    codes = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    padded = np.concatenate([codes, np.zeros(GRAM, dtype=np.uint64)])
    place = np.arange(len(codes))
    left = np.repeat(np.cumsum(sizes), sizes) - place  # characters of the line from here on
    grams = np.zeros(len(codes), dtype=np.uint64)
    for k in range(GRAM):
        grams += np.where(left > k, padded[place + k] * _POWERS[k], np.uint64(0))
    is_start = place == np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams = grams[(left >= GRAM) | is_start]
    grams ^= grams >> np.uint64(29)
    short = (grams * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)).astype(np.uint32)
    counts = np.maximum(sizes - GRAM + 1, 1)
    ends = np.cumsum(counts)
    values = np.empty((len(lines), VALUES), dtype=np.uint32)
    first = 0
    while first < len(lines):  # a bounded number of grams together, a line at least
        last = max(first + 1, int(np.searchsorted(ends, ends[first] - counts[first] + GRAMS_TOGETHER, "right")))
        base = ends[first] - counts[first]
        part, starts = short[base:ends[last - 1]], ends[first:last] - counts[first:last] - base
        for i in range(VALUES):
            values[first:last, i] = np.minimum.reduceat(part * _TIMES[i] + _PLUS[i], starts)
        first = last
    # low bits of a product are poor: mix before one is taken
    mixed = (values * np.uint32(0x9E3779B1)) >> np.uint32(31)
    sketch = np.packbits(mixed[:, :64].astype(bool), axis=1, bitorder="little").view("<i8").ravel()

    def keys(width: int) -> np.ndarray:
        key = np.zeros((len(lines), VALUES // width), dtype=np.uint64)
        for k in range(width):
            key = (key ^ values[:, k::width][:, :VALUES // width]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(32)
        return ((key + np.arange(VALUES // width, dtype=np.uint64)) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(width)).view(np.int64)

    two, three = keys(2), keys(3)
    wide = sizes >= MIN_SIMILARITY * (SHORT + 1) - 1e-9
    return sketch, [
        np.concatenate([two[i] if sizes[i] <= SHORT else two[i, :0], three[i] if wide[i] else three[i, :0]])
        for i in range(len(lines))
    ]


def _gram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, sketch, bands) of (node, text)."""
    for batch in batches:
        lines = [normalised(t) for t in batch.column(1).to_pylist()]
        if lines:
            sketch, bands = gram_sketches(lines)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sketch, pa.int64()),
                pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *map(len, bands)]), pa.int32()), pa.array(np.concatenate(bands), pa.int64())),
            ], names=["node", "sketch", "bands"])


def _line_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of many texts are counted together: a call per text would cost more than its words."""
    for batch in batches:
        rows, places, keys, totals, prints, held, n_words = [], [], [], [], [], [], 0
        for row, text in enumerate(batch.column(2)):
            first = len(rows)
            for i, line in enumerate((text.as_py() or "").split("\n")):
                if line and not line.isspace():
                    words = line_words(line)
                    rows.append(row)
                    places.append(i)
                    keys.append(signed(xxh64_intdigest(" ".join(words))))
                    held.append(words)
                    n_words += len(words)
            totals += [len(rows) - first] * (len(rows) > first) + [None] * (len(rows) - first - 1)
            if n_words >= WORDS_TOGETHER:
                prints.append(line_fingerprints(held))
                held, n_words = [], 0
        if held:
            prints.append(line_fingerprints(held))
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([
            batch.column(0).take(take), batch.column(1).take(take), pa.array(places, pa.int32()),
            pa.array(totals, pa.int32()), pa.array(keys, pa.int64()), pa.array(np.concatenate(prints) if prints else [], pa.int64()),
        ], names=["_id", "_h", "line", "n", "node", "fp"])


def line_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, line, n, node, fp) of every line with a character that is not blank.

    ``line`` counts from 0; ``n`` is as in ``line_blocks.line_table``; ``node`` is the hash of the normalised line: equal lines are one node.
    """
    schema = T.StructType([
        T.StructField("_id", docs.schema[id_col].dataType), T.StructField("_h", T.LongType()),
        T.StructField("line", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("node", T.LongType()), T.StructField("fp", T.LongType()),
    ])
    return docs.select(*row_identity(id_col, text_col), F.col(text_col).alias("t")).mapInArrow(_line_batches, schema)


def wanted_lines(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, text) of the lines at the places (_id, _h, line, node) of ``wanted``, a written table."""
    lines = docs.select(
        *row_identity(id_col, text_col), F.posexplode(F.split(F.coalesce(text_col, F.lit("")), "\n")).alias("line", "text")
    ).where(F.col("text").rlike(r"\S"))
    places = wanted.select(
        F.col("_id").alias("w_id"), F.col("_h").alias("w_h"), F.col("line").alias("w_line"), "node"
    )
    at = (F.col("_h") == F.col("w_h")) & (F.col("line") == F.col("w_line")) & F.col("_id").eqNullSafe(F.col("w_id"))
    return lines.join(bounded(places, places.count()), at).select("node", "text").dropDuplicates(["node"])


def edit_distance(a: Sequence[str], b: Sequence[str], most: int | None = None) -> int:
    """Words (or characters) to insert, delete or replace: bit-parallel, a column of the table is one integer.

    With ``most``, a larger distance may come out as ``most + 1``, as soon as it is sure.
    """
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[start:len(a) - end], b[start:len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    full, last, distance = (1 << len(a)) - 1, 1 << (len(a) - 1), len(a)
    where: dict[str, int] = {}
    for i, word in enumerate(a):
        where[word] = where.get(word, 0) | 1 << i
    up, down = full, 0  # places where the column grows, shrinks by one
    for left_over, word in zip(range(len(b) - 1, -1, -1), b):
        same = where.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        right, left = down | (full & ~(diagonal | up)), up & diagonal
        distance += bool(right & last) - bool(left & last)
        if most is not None and distance - left_over > most:
            return most + 1
        right, left = (right << 1 | 1) & full, left << 1 & full
        same |= down
        up, down = left | (full & ~(same | right)), right & same
    return distance


def similar_words(a: str, b: str, least: float = MIN_SIMILARITY) -> bool:
    """1 - edit distance in words / words of the longer line >= ``least``."""
    x, y = line_words(a), line_words(b)
    allowed = int((1 - least) * max(len(x), len(y)) + 1e-9)
    return abs(len(x) - len(y)) <= allowed and edit_distance(x, y) <= allowed


def similar_characters(a: str, b: str, least: float = MIN_SIMILARITY) -> bool:
    """1 - edit distance / length of the longer line >= ``least``, on the normalised lines."""
    x, y = normalised(a), normalised(b)
    allowed = int((1 - least) * max(len(x), len(y)) + 1e-9)
    return abs(len(x) - len(y)) <= allowed and edit_distance(x, y, allowed) <= allowed


def similar_normal(x: str, y: str, least: float = MIN_SIMILARITY) -> bool:
    """As ``similar_characters``, for lines that are in normal form already."""
    allowed = int((1 - least) * max(len(x), len(y)) + 1e-9)
    return abs(len(x) - len(y)) <= allowed and edit_distance(x, y, allowed) <= allowed


def similar_members(distance: int, similar: Similar):
    """Lookup for ``links_between``: members with a close fingerprint and a similar line."""

    def lookup(inside: pd.DataFrame):
        close, _ = close_members(distance)(inside)
        texts = dict(zip(inside["node"], inside["t"]))
        return close, lambda end, other: similar(end.t, texts[other])

    return lookup


def common_start(a: str, b: str) -> int:
    """Number of characters at the beginning in which two texts agree, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def differing(a: str, b: str) -> tuple[str, str]:
    """Two texts without their common beginning and end."""
    start = common_start(a, b)
    a, b = a[start:], b[start:]
    end = common_start(a[::-1], b[::-1])
    return a[:len(a) - end], b[:len(b) - end]


def similar_pairs(similar: Similar) -> Callable[[Sequence[str], Sequence[str]], np.ndarray]:
    """``similar`` for many pairs; pairs of lines in normal form are compared together."""
    normal = similar is similar_normal

    def tested(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
        if not normal:
            return np.array([similar(x, y) for x, y in zip(a, b)], dtype=bool)
        allowed = np.array([int((1 - MIN_SIMILARITY) * max(len(x), len(y)) + 1e-9) for x, y in zip(a, b)], dtype=np.int64)
        # a common beginning and end change no distance; most copies differ in a short stretch between them
        inner = [differing(x, y) for x, y in zip(a, b)]
        alike = np.array([max(len(x), len(y)) for x, y in inner], dtype=np.int64) <= allowed
        left = np.flatnonzero(~alike)
        alike[left] = edit_distances([inner[i][0] for i in left], [inner[i][1] for i in left], allowed[left]) <= allowed[left]
        return alike

    return tested


def edit_similar(similar: Similar):
    """Column test of two lines: the pairs of a batch are compared together."""
    together = similar_pairs(similar)

    @F.pandas_udf(T.BooleanType())
    def tested(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(together(a.tolist(), b.tolist()), dtype=bool)

    return tested


def gone_lines(lines: DataFrame, links: DataFrame, scratch: Scratch) -> DataFrame:
    """(_id, _h, line) of the lines of ``lines`` that repeat or resemble another one of their group.

    The first line of each group by (id, text hash, line), NULL ids last, is not among them. A line that is alone
    meets neither a join nor an order of places.
    """
    repeated = lines.groupBy("node").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    grouped = repeated.select("node", F.lit(None).cast("long").alias("component")).unionByName(connected_components(links))
    grouped = scratch.keep(grouped.groupBy("node").agg(F.coalesce(F.max("component"), "node").alias("root")))
    place = F.struct(F.isnull("_id").alias("no"), F.col("_id").alias("id"), F.col("_h").alias("h"), F.col("line").alias("line"))
    placed = scratch.keep(lines.select("_id", "_h", "line", "node").join(grouped.withColumnRenamed("node", "g"), F.col("node") == F.col("g"))
                          .select("root", place.alias("place")))
    heads = placed.groupBy("root").agg(F.min("place").alias("head"))
    return placed.join(heads, "root").where(F.col("place") != F.col("head")).select(
        F.col("place.id").alias("_id"), F.col("place.h").alias("_h"), F.col("place.line").alias("line"))


def line_links(
    docs: DataFrame, id_col: str, text_col: str, scratch: Scratch, similar: Similar = similar_words, grams: bool = False,
    segments: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """The table of the lines with text, and the links (a, b) of similar ones between their nodes."""
    lines = scratch.keep(line_blocks.line_table(docs, id_col, text_col, normal_lines) if segments else line_table(docs, id_col, text_col))
    place = F.struct(F.isnull("_id").alias("no"), F.col("_id").alias("id"), F.col("_h").alias("h"), F.col("line").alias("line"))
    if segments:
        # most lines are alone in their buckets: only the others are made nodes
        twos, inside = crowded(lines.select(F.explode("blocks").alias("bucket"), "node"), scratch)
        inside = scratch.keep(inside)
        wanted = inside.select("node").unionByName(twos.select(F.explode(F.array("a", "b")).alias("node"))).distinct()
        rows = lines.where(F.col("blocks").isNotNull()).join(wanted, "node", "left_semi")
        sketch = F.struct(F.min("fp").alias("fp"), F.min("size").alias("size"))
    else:
        rows, sketch = lines, F.min("fp")
    nodes = scratch.keep(rows.groupBy("node").agg(sketch.alias("sketch"), F.count(F.lit(1)).alias("weight"), F.min(place).alias("first")))
    distance = line_blocks.MAX_DISTANCE if segments else MAX_SKETCH_DISTANCE if grams else MAX_DISTANCE
    if segments:
        texts_at = lambda *which: line_blocks.wanted_texts(*which, normalised)
        similar = similar_normal if similar is similar_characters else similar
    else:
        texts_at = wanted_lines

    def line_texts(wanted_nodes: DataFrame) -> DataFrame:
        wanted = scratch.keep(nodes.join(wanted_nodes.distinct(), "node", "left_semi").select(
            F.col("first.id").alias("_id"), F.col("first.h").alias("_h"), F.col("first.line").alias("line"), "node"
        ))
        return scratch.keep(texts_at(docs, wanted, id_col, text_col).withColumnRenamed("text", "t"))

    if grams:
        sketched = scratch.keep(line_texts(nodes.select("node")).select("node", "t").mapInArrow(
            _gram_batches, "node long, sketch long, bands array<long>"))
        members = sketched.select(F.explode("bands").alias("bucket"), "node")
        nodes = scratch.keep(nodes.drop("sketch").join(sketched.drop("bands"), "node"))
    elif not segments:
        members = nodes.select(F.explode(block_keys(F.col("sketch"), BLOCKS, MAX_DISTANCE)).alias("bucket"), "node")

    def verify(pairs: DataFrame) -> DataFrame:
        pairs = scratch.keep(pairs)
        texts = line_texts(pairs.select(F.explode(F.array("a", "b")).alias("node")))
        left = texts.select(F.col("node").alias("a"), F.col("t").alias("ta"))
        right = texts.select(F.col("node").alias("b"), F.col("t").alias("tb"))
        return pairs.join(left, "a").join(right, "b").where(edit_similar(similar)(F.col("ta"), F.col("tb"))).select("a", "b")

    def settle(ends: DataFrame, inside: DataFrame) -> DataFrame:
        known = nodes.select("node", "sketch.fp", "sketch.size") if segments else nodes.select("node", "sketch")
        if segments:
            left = scratch.keep(near_rows(ends, inside, known, near_arrays))
            ends, inside = left.where("end").select("bucket", "node"), left.select("bucket", "node").distinct()
        facts = line_texts(inside.select("node")).join(known, "node")
        if segments:
            return links_together(ends, inside, facts, near_arrays, similar_pairs(similar))
        return links_between(ends, inside, facts, similar_members(distance, similar))

    near_columns, near_arrays = line_blocks.may_be_similar(MIN_SIMILARITY)
    near = near_columns if segments else hamming_near(distance)
    if segments:
        links = links_inside(twos, inside, nodes, near, verify, scratch, settle)
    else:
        links = bucket_links(members, nodes, near, verify, scratch, settle)
    scratch.only(lines, links)
    return lines, links


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: Similar = similar_words,
    grams: bool = False, segments: bool = False,
) -> DataFrame:
    """``docs`` with the text of ``text_col`` less its repeated lines, and n_lines, n_kept added as
    ``_n_lines`` and ``_n_kept``.

    Lines are split at line ends; blank ones always stay and are not counted. Lines whose
    normalised forms are equal, or whose fingerprints differ in at most MAX_DISTANCE bits (with
    ``grams``: that share a MinHash band of their character n-grams and differ in at most
    MAX_SKETCH_DISTANCE bits of the sketch; with ``segments``: that share a stretch of words and differ
    in at most ``line_blocks.MAX_DISTANCE`` bits) and that are ``similar``, form groups (the queries
    take ``segments`` and ``similar_characters``); the rest of a group goes wherever it stands, in the same text
    too. A NULL text stays NULL. Repeated rows: the same places are kept in each of them. A text
    that loses all of its lines becomes empty, its row stays. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    lines, links = line_links(docs, id_col, text_col, scratch, similar, grams, segments)
    of_rows = lines.where("n IS NOT NULL").select("_id", "_h", "n", F.lit(None).cast("int").alias("line")).unionByName(
        gone_lines(lines, links, scratch).select("_id", "_h", F.lit(None).cast("int").alias("n"), "line"))
    per_row = of_rows.groupBy("_id", "_h").agg(F.max("n").cast("long").alias("_n_lines"), F.sort_array(F.collect_set("line")).alias("gone"))
    per_row = per_row.select(
        F.col("_id").alias("r_id"), F.col("_h").alias("r_h"), "_n_lines", (F.col("_n_lines") - F.size("gone")).alias("_n_kept"), "gone")
    rows = boxed(docs, id_col, text_col)
    # the texts are not sorted for it: their side of the join is by far the wider one
    joined = rows.join(per_row.hint("shuffle_hash"), F.col("_id").eqNullSafe(F.col("r_id")) & (F.col("_h") == F.col("r_h")), "left")
    text = without_lines(F.col("_row")[text_col], F.col("gone"))
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("_n_lines", "_n_kept")]
    return joined.select(*unboxed([c for c in docs.columns if c not in ("_n_lines", "_n_kept")], {text_col: text}), *counts)
