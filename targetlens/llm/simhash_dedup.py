"""SimHash near duplicates: fingerprints, pigeonhole blocks, Hamming check, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from targetlens.llm.common import Scratch, boxed, row_identity, same_row, unboxed
from targetlens.llm.components import connected_components
from targetlens.llm.linking import bucket_links, links_between

SHINGLE = 3
SEED = 42
BITS = 64
MAX_DISTANCE = 3
BLOCKS = 6
CHUNK = 1 << 16


def fingerprint(text: str | None) -> int:
    """Signed 64-bit SimHash: a bit is 1 if it is set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = [xxh64_intdigest(b" ".join(words), SEED)]
    else:
        columns = zip(*(words[i:] for i in range(SHINGLE)))
        hashes = [xxh64_intdigest(s, SEED) for s in map(b" ".join, columns)]
    values = np.array(hashes, dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(values), CHUNK):
        part = values[at:at + CHUNK].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(2 * counts > len(values), bitorder="little")
    return int(majority.view("<i8")[0])


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [fingerprint(t.as_py()) for t in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(values, pa.int64())],
            names=["_id", "_h", "fp"],
        )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, _h, fp) per row; _h is the hash of the text."""
    schema = T.StructType([
        T.StructField("_id", docs.schema[id_col].dataType),
        T.StructField("_h", T.LongType()), T.StructField("fp", T.LongType()),
    ])
    return docs.select(*row_identity(id_col, text_col), F.col(text_col).alias("t")).mapInArrow(
        _fingerprint_batches, schema
    )


def block_keys(fp: Column, blocks: int = BLOCKS, distance: int = MAX_DISTANCE) -> Column:
    """Array of one long per choice of blocks: a hash of the choice and the bits of its blocks.

    At most ``distance`` of the blocks can differ in a close pair, so the pair agrees in the key of
    at least one choice of ``blocks - distance`` blocks. More blocks make longer keys, and so fewer
    chance meetings, for more rows.
    """
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = []
    for chosen in combinations(range(blocks), blocks - distance):
        mask = sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in chosen)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return F.array(*[F.xxhash64(F.lit(i), fp.bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])


def hamming_near(distance: int):
    return lambda a, b: F.bit_count(a.bitwiseXOR(b)) <= distance


def close_members(distance: int):
    """Lookup for ``links_between``: members whose fingerprints are close to that of an end."""

    def lookup(inside):
        names, prints = inside["node"].to_numpy(), inside["sketch"].to_numpy().astype(np.uint64)

        def close(end) -> np.ndarray:
            bits = np.bitwise_count(prints ^ np.uint64(end.sketch & (1 << 64) - 1))
            return names[bits <= distance]

        return close, None

    return lookup


def close_links(nodes: DataFrame, scratch: Scratch, distance: int = MAX_DISTANCE) -> DataFrame:
    """Pairs (a, b) of fingerprints at most ``distance`` bits apart that connect all such pairs.

    ``nodes`` has the distinct fingerprints ``fp`` and their numbers of copies ``weight``.
    """
    known = nodes.select(F.col("fp").alias("node"), "weight", F.col("fp").alias("sketch"))
    members = nodes.select(F.explode(block_keys(F.col("fp"), BLOCKS, distance)).alias("bucket"), F.col("fp").alias("node"))
    settle = lambda ends, inside: links_between(
        ends, inside, known.select("node", "sketch"), close_members(distance))
    return bucket_links(members, known, hamming_near(distance), lambda pairs: pairs, scratch, settle)


def simhash_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = MAX_DISTANCE
) -> DataFrame:
    """One row per row of ``docs``: ``_id``, ``_h`` (text hash), ``fp``, ``component_id`` and ``chosen``.

    ``component_id`` is the smallest id reachable and ``chosen`` marks the rows that stand for
    their group: those of the smallest (id, text hash), NULL ids last. Copies collapse to one
    fingerprint before the join, so a group of copies of any size is one row there. A NULL or
    empty text has fingerprint zero and is linked like any other. Repeated rows each keep their
    row. A group whose ids are all NULL has a NULL component. An empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    fps = scratch.keep(fingerprints(docs, id_col, text_col))
    first = F.struct(F.isnull("_id").alias("no"), F.col("_id").alias("id"), F.col("_h").alias("h"))
    nodes = scratch.keep(fps.groupBy("fp").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("weight")))
    component = connected_components(close_links(nodes.select("fp", "weight"), scratch, distance))
    placed = nodes.join(component, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    heads = placed.groupBy("root").agg(F.min("first").alias("head"))
    named = placed.join(heads, "root").select("fp", "head")
    return fps.join(named, "fp").select(
        "_id", "_h", "fp", F.col("head.id").alias("component_id"),
        (F.col("_id").eqNullSafe(F.col("head.id")) & (F.col("_h") == F.col("head.h"))).alias("chosen"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each near-duplicate group, with the columns of ``docs``.

    It is the row of the smallest (id, text hash), NULL ids last; of rows that agree in both but not in
    other columns, the one whose whole content has the smallest hash. NULL and empty texts form
    groups like any other; an empty table gives no rows.
    """
    groups = simhash_near_duplicates(docs, id_col, text_col)
    chosen = groups.where("chosen").select("_id", "_h").distinct()
    rows = boxed(docs, id_col, text_col)
    left = rows.join(chosen, same_row(rows, chosen), "left_semi")
    one = left.groupBy("_id", "_h").agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row"))
    return one.select(*unboxed(docs.columns))
