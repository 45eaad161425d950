"""Periodic runs of words by string synchronising sets.

A run of smallest period q in [t, 2t), t a power of two, and at least four periods long holds a
position s of the synchronising set of scale t such that s + q is the next position of the set with
the same context of 2t words. The set takes the positions whose block of t words has the least hash
among the t + 1 blocks from there on, blocks of period t / 4 or less left out. Those highly periodic
blocks lie in runs that smaller scales have found; periods under SMALL are found by comparing the
text with itself moved by the period. Every proposed period is verified on the words and extended
both ways, so hashes only decide where to look.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Periods of a run at least, and words at least.
EXPONENT, SHORTEST = 4, 6
#: Periods from 1 to SMALL - 1 are compared directly; SMALL is a power of two.
SMALL = 4
#: Words of the texts that are searched in one call; a longer text is a call of its own.
WORDS_TOGETHER = 1 << 17
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring blocks from those of the blocks."""
    return _mixed(first * np.uint64(0x9E3779B97F4A7C15) + _mixed(second ^ np.uint64(0xD1B54A32D192ED03)))


def _smallest(codes: np.ndarray, start: int, period: int) -> bool:
    """Whether the repeated block at ``start`` is no power of a shorter one."""
    block = codes[start:start + period]
    return not any(period % p == 0 and np.array_equal(block[p:], block[:-p]) for p in range(1, period // 2 + 1))


def _first_difference(codes: np.ndarray, start: int, period: int) -> int:
    """Smallest i >= start with codes[i] != codes[i + period]; the text's end counts as different."""
    stop, step = len(codes) - period, 64
    while start < stop:
        end = min(start + step, stop)
        other = codes[start:end] != codes[start + period:end + period]
        k = int(other.argmax())
        if other[k]:
            return start + k
        start, step = end, 4 * step
    return max(start, stop)


def _last_difference(codes: np.ndarray, start: int, period: int) -> int:
    """Largest i < start with codes[i] != codes[i + period], or -1."""
    step = 64
    while start > 0:
        begin = max(start - step, 0)
        other = codes[begin:start] != codes[begin + period:start + period]
        if other.any():
            return begin + int(np.flatnonzero(other)[-1])
        start, step = begin, 4 * step
    return -1


def _direct(codes: np.ndarray, period: int) -> Iterator[tuple[int, int, int]]:
    """Runs of a small period: stretches in which the text agrees with itself moved by it."""
    if len(codes) <= period:
        return
    same = np.concatenate([[False], codes[period:] == codes[:-period], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1])
    starts, ends = edges[0::2], edges[1::2] + period
    for i in np.flatnonzero(ends - starts >= EXPONENT * period):
        if _smallest(codes, int(starts[i]), period):
            yield int(starts[i]), int(ends[i]), period


def synchronising_set(blocks: np.ndarray, skipped: np.ndarray, scale: int) -> np.ndarray:
    """Positions i with least(blocks[i .. i + scale]) at one of the two ends, ``skipped`` blocks left out."""
    ids = np.where(skipped, _TOP, blocks)
    low, width = ids, 1
    while width < scale:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    n = len(ids) - scale
    first, last = ids[:n], ids[scale:]
    least = np.minimum(low[:n], last)
    return np.flatnonzero((least != _TOP) & ((least == first) | (least == last)))


def _proposed(blocks: np.ndarray, chosen: np.ndarray, scale: int) -> np.ndarray:
    """(position, period) of neighbouring equal contexts less than two scales apart."""
    contexts = _joined(blocks[chosen], blocks[chosen + scale])
    order = np.argsort(contexts, kind="stable")
    contexts, places = contexts[order], chosen[order]
    apart = np.diff(places)
    near = np.flatnonzero((contexts[1:] == contexts[:-1]) & (apart >= scale) & (apart < 2 * scale))
    found = np.stack([apart[near], places[near]], axis=1)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def runs_of(codes: np.ndarray, longest: int | None = None) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs with at least EXPONENT periods, by start and period.

    ``codes`` has one number per word, equal for equal words; ``longest`` bounds the length of a
    run if it is known to be less than the sequence (of several texts with unique numbers between).
    """
    longest = len(codes) if longest is None else longest
    found = [run for period in range(1, SMALL) for run in _direct(codes, period)]
    blocks, scale = _mixed(codes.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), 1
    while EXPONENT * 2 * scale <= longest:  # blocks of twice the words
        blocks, scale = _joined(blocks[:-scale], blocks[scale:]), 2 * scale
        if scale < SMALL or len(blocks) <= scale:
            continue
        skipped = np.zeros(len(blocks) + 1, dtype=np.int64)
        for start, end, period in found:
            if EXPONENT * period <= scale <= end - start:
                skipped[start] += 1
                skipped[end - scale + 1] -= 1
        chosen = synchronising_set(blocks, np.cumsum(skipped[:-1]) > 0, scale)
        done: dict[int, int] = {}
        for period, place in _proposed(blocks, chosen, scale).tolist():
            if place + period < done.get(period, 0):
                continue  # inside a stretch of this period that is known
            start = _last_difference(codes, place, period) + 1
            end = _first_difference(codes, place, period) + period
            done[period] = end
            if end - start >= EXPONENT * period and _smallest(codes, start, period):
                found.append((start, end, period))
    return sorted(found, key=lambda run: (run[0], run[2]))


Edit = Callable[[object, list[bytes]], list[bytes]]


def planted(doc_id: object, words: list[bytes]) -> list[bytes]:
    """The words of a document with a repeated tail in every tenth one, by the CRC of its id; none without an id."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    block = words[a:a + p]
    return words[:a] + (block * ((n - a) // p + 1))[:n - a]


def _searched(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of every text, all texts searched as one sequence."""
    codes: dict[bytes, int] = {}
    line = np.empty(sum(map(len, texts)) + len(texts), dtype=np.int64)
    starts, at = [], 0
    for i, words in enumerate(texts):
        starts.append(at)
        line[at:at + len(words)] = [codes.setdefault(w, len(codes)) for w in words]
        at += len(words)
        line[at] = -1 - i  # occurs once, so that no run leaves its text
        at += 1
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    owners = np.array(starts)
    for start, end, period in runs_of(line, max(map(len, texts), default=0)):
        if end - start >= SHORTEST:
            i = int(np.searchsorted(owners, start, side="right")) - 1
            out[i].append((start - starts[i], end - start, period))
    return out


def _kept(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words less those that any run holds after its first period."""
    if not runs:
        return words
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Edit | None = None) -> DataFrame:
    """(_id, runs, collapsed): the periodic runs of each text and the text without their repetitions.

    ``runs`` is an array of (start, length, period) in words from 0, by start and period: stretches
    with smallest period q of at least max(6, 4 q) words that no neighbouring word extends.
    ``collapsed`` joins the words by one space that no run holds after its first q words. Words are
    split at blanks and ASCII line ends. A NULL text is empty: no runs, an empty text. One row per
    row of ``docs``, repeated rows and NULL ids included; other columns are ignored. ``edit`` may
    change the words of a text first.
    """
    schema = "runs array<struct<start:long,length:long,period:long>>, collapsed string"
    docs = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = docs.schema["_id"].dataType.simpleString()
    struct = pa.struct([(k, pa.int64()) for k in ("start", "length", "period")])

    def found(ids: list, texts: list[list[bytes]], id_type: pa.DataType) -> pa.RecordBatch:
        runs = _searched(texts)
        rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs] for rs in runs]
        left = [b" ".join(_kept(w, rs)).decode("utf-8", "replace") for w, rs in zip(texts, runs, strict=True)]
        return pa.RecordBatch.from_pydict({
            "_id": pa.array(ids, id_type), "runs": pa.array(rows, pa.list_(struct)), "collapsed": pa.array(left, pa.string())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, size = [], [], 0
            for _id, text in zip(batch.column("_id"), batch.column("text").cast(pa.binary()), strict=True):
                # bytes.split() without an argument splits at exactly these blanks
                words = (text.as_py() or b"").split()
                words = edit(_id.as_py(), words) if edit else words
                if texts and size + len(words) > WORDS_TOGETHER:
                    yield found(ids, texts, batch.column("_id").type)
                    ids, texts, size = [], [], 0
                ids.append(_id.as_py())
                texts.append(words)
                size += len(words) + 1
            if texts:
                yield found(ids, texts, batch.column("_id").type)

    return docs.mapInArrow(run, f"_id {kind}, {schema}")


def best_run(runs: Column) -> Column:
    """The run of the greatest length / period, compared exactly; of equals the first by start, then period."""
    beats = lambda r, b: (r["length"] * b["period"] > b["length"] * r["period"])
    return F.when(F.size(runs) > 0, F.aggregate(runs, runs[0], lambda b, r: F.when(beats(r, b), r).otherwise(b)))


def run_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edit: Edit | None = planted) -> DataFrame:
    """One row per document: number of runs, the best one and digests of all runs and of the collapsed text."""
    found = periodic_runs(docs, id_col, text_col, edit).withColumn("best", best_run(F.col("runs")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = [F.col("best")[k].alias(k) for k in ("start", "length", "period")]
    return found.select(
        F.col("_id").alias(id_col), F.size("runs").cast("long").alias("n_runs"), *best,
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
