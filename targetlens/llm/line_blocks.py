"""Fingerprints of normalised lines: a SimHash of the words, and one block per stretch of words.

A line's fingerprint is the row of hashes of its stretches, which end behind words chosen by their
hash, so that an insertion moves no other end. Pigeonhole: a pair of lines with fewer edits than
stretches agrees in one stretch at least. Equal 16-bit pieces of a 64-bit SimHash would need pairs
within three bits, and of similar lines most are further apart; the SimHash of the whole line
decides which pairs that share a block are worth an edit check.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from targetlens.llm.common import row_identity
from targetlens.llm.phrases import Filter, Polynomial, mixed

#: Lines of up to SHORT words have stretches of two words and more, about 4; longer ones of three and more, about 7.
SHORT = 28
#: Bits of the SimHash in which a pair may differ: at 0.9 similar lines are 9 bits apart, at 0.8 13, unlike ones about 26 to 32.
MAX_DISTANCE = 17
#: Total weight of a line up to which four counters fit in one 64-bit number.
LANE = (1 << 16) - 1
#: Bytes of normalised lines that are hashed in one call.
TOGETHER = 1 << 18
#: Lines that a task knows as printed before it begins anew.
REMEMBERED = 1 << 19
_LETTERS, _WORDS = Polynomial(0x5851F42D4C957F2D), Polynomial(0x14057B7EF767814F)


def majority(hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit SimHash of each group of weighted hashes; groups begin at ``starts`` and have a member at least."""
    totals = np.add.reduceat(weights, starts)
    bits = np.zeros((len(starts), 64), dtype=bool)
    light = np.minimum(weights, LANE)
    for shift in range(16):
        lanes = (hashes >> np.uint64(shift) & np.uint64(0x0001_0001_0001_0001)) * light
        sums = np.add.reduceat(lanes, starts).astype("<u8").view("<u2").reshape(-1, 4)
        bits[:, shift::16] = 2 * sums.astype(np.int64) > totals.astype(np.int64)[:, None]
    ends = np.append(starts[1:], len(hashes))
    for line in np.flatnonzero(totals > LANE):
        part = slice(starts[line], ends[line])
        for bit in range(64):
            held = weights[part][(hashes[part] >> np.uint64(bit) & np.uint64(1)).astype(bool)].sum()
            bits[line, bit] = 2 * int(held) > int(totals[line])
    return np.packbits(bits, axis=1, bitorder="little").view("<i8").ravel()


def line_prints(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(SimHash of each normalised line, number of its blocks, the blocks of all lines in order)."""
    data = np.frombuffer("\n".join(lines).encode("utf-8", "surrogatepass"), dtype=np.uint8)
    gap = (data == 32) | (data == 10)
    starts = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    ends = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]])) + 1
    line = np.searchsorted(np.flatnonzero(data == 10), starts)
    hashes = mixed(_LETTERS.ranges(data.astype(np.uint64) + np.uint64(1), starts, ends) ^ (ends - starts).astype(np.uint64))
    first = np.flatnonzero(np.concatenate([[True], line[1:] != line[:-1]]))
    prints = majority(hashes, (ends - starts).astype(np.uint64), first)
    sizes = np.diff(np.append(first, len(hashes)))
    brief = (sizes <= SHORT)[line]
    wish = mixed(hashes + np.uint64(77)) % np.where(brief, 2, 3).astype(np.uint64) == 0
    # no end right behind another one: known from the words before, so that an edit moves near ends only
    place = np.arange(len(hashes)) - np.repeat(first, sizes)
    after = np.concatenate([[False], wish[:-1]]) & (place >= 1)
    again = np.concatenate([[False, False], wish[:-2]])[:len(wish)] & (place >= 2) & ~brief
    cut = wish & ~after & ~again
    cut[np.append(first[1:], len(hashes)) - 1] = True  # a stretch ends with its line
    stop = np.flatnonzero(cut) + 1
    begin = np.concatenate([[0], stop[:-1]])
    owner = line[begin]
    blocks = mixed(_WORDS.ranges(hashes, begin, stop)).view(np.int64)
    # what is left at a line's end may be a word or two: no block, but in lines that have no other
    good = stop - begin >= np.where(brief[begin], 2, 3)
    lone = np.bincount(owner, weights=good, minlength=len(lines)) == 0
    good |= lone[owner]
    return prints, np.bincount(owner[good], minlength=len(lines)), blocks[good]


def line_table(docs: DataFrame, id_col: str, text_col: str, normal) -> DataFrame:
    """(_id, _h, line, n, node, size, fp, blocks) of every line with a character that is not blank.

    ``line`` counts from 0; ``n`` is the number of such lines of the text, in the row of its first one only; ``node``
    and ``size`` are hash and length of its normal form; ``normal`` gives the places and these forms of a text. ``size``, ``fp`` and ``blocks`` are NULL
    where the task has given them for an equal line before; each node has them in a row at least.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows, places, keys, fresh, totals, held, size, parts, sizes = [], [], [], [], [], [], 0, [], []
            for row, text in enumerate(batch.column(2)):
                first = len(rows)
                for i, line in normal(text.as_py() or ""):
                    key = xxh64_intdigest(line)
                    rows.append(row)
                    places.append(i)
                    keys.append(key)
                    fresh.append(key not in seen)
                    if fresh[-1]:
                        seen.add(key)
                        held.append(line)
                        sizes.append(len(line))
                        size += len(line)
                totals += [len(rows) - first] * (len(rows) > first) + [None] * (len(rows) - first - 1)
                if size >= TOGETHER:
                    parts.append(line_prints(held))
                    held, size = [], 0
                if len(seen) > REMEMBERED:
                    seen.clear()
            if held:
                parts.append(line_prints(held))
            if not rows:
                continue
            none = np.empty(0, dtype=np.int64)
            prints, counts, blocks = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (none,) * 3
            take, fresh = pa.array(rows, pa.int64()), np.array(fresh, dtype=bool)
            # the place among the fresh lines, NULL for the others
            at = pa.array(np.cumsum(fresh) - 1, mask=~fresh)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(blocks))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(take), batch.column(1).take(take), pa.array(places, pa.int32()), pa.array(totals, pa.int32()),
                pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), pa.array(sizes, pa.int32()).take(at), pa.array(prints).take(at),
                lists.take(at),
            ], names=["_id", "_h", "line", "n", "node", "size", "fp", "blocks"])

    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    return docs.select(*row_identity(id_col, text_col), F.col(text_col).alias("t")).mapInArrow(
        run, f"_id {kind}, _h long, line int, n int, node long, size int, fp long, blocks array<long>")


def may_be_similar(least: float) -> tuple[Callable, Callable]:
    """Test of two sketches (fp, size) by distance and length, for columns and for arrays."""
    def columns(a: Column, b: Column) -> Column:
        fits = F.least(a["size"], b["size"]) >= least * F.greatest(a["size"], b["size"]) - 1e-9
        return fits & (F.bit_count(a["fp"].bitwiseXOR(b["fp"])) <= MAX_DISTANCE)

    def arrays(a: dict, b: dict) -> np.ndarray:
        fits = np.minimum(a["size"], b["size"]) >= least * np.maximum(a["size"], b["size"]) - 1e-9
        return fits & (np.bitwise_count((a["fp"] ^ b["fp"]).view(np.uint64)) <= MAX_DISTANCE)

    return columns, arrays


def wanted_texts(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, normal) -> DataFrame:
    """(node, text) of the lines at the places (_id, _h, line, node) of ``wanted``, a written table, in normal form.

    A Bloom filter of bounded size over the places leaves out nearly all other lines before they are
    split off; the join after it is exact.
    """
    line = F.col("line").cast("long")
    spots = wanted.select(F.col("_h").bitwiseXOR(F.shiftleft(line, 5)).bitwiseXOR(F.shiftleft(line, 41)).alias("fp"))
    may = Filter(spots, wanted.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = pc.add(pc.fill_null(pc.count_substring(batch.column(2), "\n"), 0), 1).to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(keys)), sizes)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            hit = may.holds((keys[owner] ^ (place << 5) ^ (place << 41)).view(np.uint64))
            owner, place = owner[hit], place[hit]
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
            lines = []
            for a, b in zip(first, np.append(first[1:], len(owner)), strict=True) if len(owner) else []:
                held = (batch.column(2)[int(owner[a])].as_py() or "").split("\n")
                lines += [normal(held[i]) for i in place[a:b]]
            take = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(place.astype(np.int32)), pa.array(lines, pa.string())],
                names=["l_id", "l_h", "l_line", "text"])

    kind = docs.select(F.col(f"`{id_col}`")).schema[0].dataType.simpleString()
    found = docs.select(*row_identity(id_col, text_col), F.col(text_col).alias("t")).mapInArrow(
        run, f"l_id {kind}, l_h long, l_line int, text string")
    at = (F.col("_h") == F.col("l_h")) & (F.col("line") == F.col("l_line")) & F.col("_id").eqNullSafe(F.col("l_id"))
    return found.join(wanted.select("_id", "_h", "line", "node"), at).select("node", "text").dropDuplicates(["node"])
