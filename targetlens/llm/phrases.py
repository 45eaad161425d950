"""Phrase collocations: Rabin-Karp fingerprints of all n-grams, counted by shuffles, verified against the text.

Fingerprints come from numpy prefix polynomials over bytes (words) and over words (n-grams). A
phrase can be frequent only if its parts are, so words are counted first, then pairs of frequent
words, then longer phrases of frequent parts: nothing frequent is lost and rare n-grams, nearly all
of a corpus, are shuffled at most once. What tasks need to know of the level before is a Bloom
filter of bounded size, whose false hits only cost rows. Counted fingerprints carry a document as
pointer and the range of a second fingerprint; the phrase is read at its pointer, and where
occurrences differ from it they are counted again by their text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from targetlens.llm.common import Scratch, bounded

MAX_WORDS = 4
MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
#: A part goes if a longer candidate with at least this percentage of its occurrences holds it.
COVERED_PERCENT = 80
UNKNOWN_LANG = "und"
#: Bytes of text that are hashed in one call; a longer text is a call of its own.
SLAB_BYTES = 1 << 20
#: Most bits of a Bloom filter (16 MB): beyond some ten million members it lets more rows pass.
MOST_BITS = 1 << 27
BITS_PER_MEMBER = 16
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(BREAKS)] = 2


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Polynomial:
    """Fingerprints of ranges of a sequence from its prefix sums of value * base**place modulo 2**64."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.full(size, b, dtype=np.uint64) for b in (self.base, self.inverse))
            for powers in (self.up, self.down):
                powers[0] = 1
                np.multiply.accumulate(powers, out=powers)

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[:len(values)], out=sums[1:])
        return (sums[ends] - sums[starts]) * self.down[starts]


class Hasher:
    """Word and n-gram fingerprints; another seed gives independent ones. ``bits`` keeps only so many of them."""

    def __init__(self, seed: int, bits: int = 64):
        rng = np.random.default_rng(seed)
        bases = [int(b) | 5 for b in rng.integers(0, 1 << 63, 2)]
        self.letters, self.words = Polynomial(bases[0]), Polynomial(bases[1])
        self.seed, self.kept = np.uint64(seed), np.uint64((1 << bits) - 1)

    def of_words(self, slab: Slab) -> np.ndarray:
        plain = self.letters.ranges(slab.data.astype(np.uint64) + np.uint64(1), slab.starts, slab.ends)
        return mixed(plain ^ ((slab.ends - slab.starts).astype(np.uint64) << np.uint64(40)) ^ self.seed)

    def of_phrases(self, slab: Slab, words: np.ndarray, n: int) -> np.ndarray:
        """Fingerprint of the n words from each word on, also of those that leave their piece."""
        first = np.arange(max(len(words) - n + 1, 0))
        plain = self.words.ranges(words, first, first + n)
        return mixed(plain + slab.langs[first] + np.uint64(n)) & self.kept


class Slab:
    """Words of some consecutive texts as byte ranges of their lower-cased UTF-8."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, langs: np.ndarray):
        inner = _KIND[data]
        breaks = np.flatnonzero(inner == 2)
        inner = inner == 0
        before, after = np.zeros(len(data) + 1, dtype=bool), np.zeros(len(data) + 1, dtype=bool)
        before[1:], after[:-1] = inner, inner
        before[bounds] = False
        after[bounds] = False  # a word ends with its text
        self.starts = np.flatnonzero(inner & ~before[:-1])
        self.ends = np.flatnonzero(inner & ~after[1:]) + 1
        self.rows = np.searchsorted(bounds, self.starts, side="right") - 1
        #: equal for words of one piece of one text only, as both terms never fall
        self.pieces = np.searchsorted(breaks, self.starts) + self.rows
        self.data, self.langs = _LOWER[data], langs[self.rows] if len(langs) else langs

    def whole(self, n: int) -> np.ndarray:
        """Whether the n words from each word on lie in one piece."""
        return self.pieces[n - 1:] == self.pieces[:len(self.pieces) - n + 1] if len(self.pieces) >= n else np.zeros(0, dtype=bool)

    def phrase(self, first: int, n: int) -> str:
        return b" ".join(self.data[self.starts[i]:self.ends[i]].tobytes() for i in range(first, first + n)).decode("utf-8", "replace")


def slabs(texts: pa.Array, langs: list[str]) -> Iterator[tuple[int, Slab]]:
    """(first row, slab) over the texts, about SLAB_BYTES of them at a time; NULL is an empty text."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    codes = {x: np.uint64(xxh64_intdigest(x)) for x in set(langs)}
    codes = np.array([codes[x] for x in langs], dtype=np.uint64)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + SLAB_BYTES, side="right")) - 1)
        last = min(last, len(texts))
        yield first, Slab(data[at[first]:at[last]], at[first:last + 1] - at[first], codes[first:last])
        first = last


class Filter:
    """Bloom filter over fingerprints, built by Spark and sent to the tasks."""

    def __init__(self, found: DataFrame, rows: int):
        size = 1 << 10
        while size < min(MOST_BITS, BITS_PER_MEMBER * rows):
            size *= 2
        spot = F.explode(F.array(F.col("fp").bitwiseAND(F.lit(size - 1)), F.shiftrightunsigned("fp", 36).bitwiseAND(F.lit(size - 1))))
        # as many rows as the filter has longs, however many fingerprints there are
        longs = found.select(spot.alias("i")).groupBy(F.shiftright("i", 6).alias("at")).agg(
            F.expr("bit_or(shiftleft(1L, CAST(i & 63 AS INT)))").alias("bits")).toArrow()
        table = np.zeros(size // 64, dtype=np.int64)
        table[longs["at"].to_numpy()] = longs["bits"].to_numpy()
        self.sent = found.sparkSession.sparkContext.broadcast(table.view(np.uint64))
        self.mask = np.uint64(size - 1)

    def __getstate__(self):
        return {"sent": self.sent, "mask": self.mask}

    def holds(self, fps: np.ndarray) -> np.ndarray:
        table, low = self.sent.value, np.uint64(63)
        hit = lambda i: (table[i >> np.uint64(6)] >> (i & low)) & np.uint64(1)
        return (hit(fps & self.mask) & hit((fps >> np.uint64(36)) & self.mask)).astype(bool)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _scan(docs: DataFrame, rows_of: Callable[[Slab, np.ndarray], dict], schema: str) -> DataFrame:
    """The rows that ``rows_of(slab, keys of its texts)`` gives over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, keys = batch.column("lang").to_pylist(), batch.column("doc").to_numpy(zero_copy_only=False)
            for first, slab in slabs(batch.column("text"), langs):
                found = rows_of(slab, keys[first:])
                if len(next(iter(found.values()))):
                    yield pa.RecordBatch.from_pydict(found)

    return docs.mapInArrow(run, schema)


def _counted(fps: np.ndarray) -> dict:
    values, counts = np.unique(fps, return_counts=True)
    return {"fp": _signed(values), "c": pa.array(counts.astype(np.int64))}


def _frequent(rows: DataFrame, least: int, scratch: Scratch) -> DataFrame:
    return scratch.keep(rows.groupBy("fp").agg(F.sum("c").alias("c")).where(F.col("c") >= least).select("fp"))


def _candidates(slab: Slab, words: np.ndarray, hasher: Hasher, filters: list[Filter], longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, fingerprints, places): the phrases in one piece whose parts the filters of the levels below hold."""
    below = None
    for n in range(1, longest + 1):
        fps = hasher.of_phrases(slab, words, n)
        if not len(fps):
            return
        ok = np.ones(len(fps), dtype=bool) if n == 1 else slab.whole(n) & below[:-1] & below[1:]
        if n <= len(filters):
            ok[ok] = filters[n - 1].holds(fps[ok])
        yield n, fps, np.flatnonzero(ok)
        below = ok


def _level_counts(
    docs: DataFrame, hasher: Hasher, other: Hasher, filters: list[Filter], least: int, longest: int, scratch: Scratch
) -> DataFrame:
    """(n, fp, c, doc, lo, hi) of the phrases whose count may reach ``least``."""

    def rows_of(slab: Slab, keys: np.ndarray) -> dict:
        words, seconds = hasher.of_words(slab), other.of_words(slab)
        parts = {k: [] for k in ("n", "fp", "c", "doc", "lo", "hi")}
        for n, prints, at in _candidates(slab, words, hasher, filters, longest):
            if not len(at):
                continue
            fps, twins = prints[at], other.of_phrases(slab, seconds, n)[at]
            order = np.argsort(fps, kind="stable")
            fps, twins, at = fps[order], twins[order].view(np.int64), at[order]
            first = np.flatnonzero(np.concatenate([[True], fps[1:] != fps[:-1]]))
            parts["n"].append(np.full(len(first), n, dtype=np.int64))
            parts["fp"].append(fps[first].view(np.int64))
            parts["c"].append(np.diff(np.append(first, len(fps))))
            parts["doc"].append(keys[slab.rows[at[first]]])
            parts["lo"].append(np.minimum.reduceat(twins, first))
            parts["hi"].append(np.maximum.reduceat(twins, first))
        return {k: pa.array(np.concatenate(v) if v else np.zeros(0, dtype=np.int64)) for k, v in parts.items()}

    found = _scan(docs, rows_of, "n long, fp long, c long, doc long, lo long, hi long")
    return scratch.keep(found.groupBy("n", "fp").agg(
        F.sum("c").alias("c"), F.min("doc").alias("doc"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    ).where(F.col("c") >= least))


def _read_phrases(docs: DataFrame, found: DataFrame, hasher: Hasher, other: Hasher, scratch: Scratch) -> DataFrame:
    """(n, fp, lang, phrase, twin): every counted fingerprint read at its pointer."""
    wanted = scratch.keep(found.groupBy("doc").agg(F.collect_list(F.struct("n", "fp")).alias("wanted")))
    keys = wanted.select("doc")
    texts = docs.join(bounded(keys, keys.count()), "doc", "left_semi").dropDuplicates(["doc"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, wish in enumerate(batch.column("wanted").to_pylist()):
                lang = batch.column("lang")[i].as_py()
                out = []
                slab = next(slabs(batch.column("text").slice(i, 1), [lang]))[1]
                words, seconds = hasher.of_words(slab), other.of_words(slab)
                for n in sorted({w["n"] for w in wish}):
                    fps, twins = hasher.of_phrases(slab, words, n).view(np.int64), other.of_phrases(slab, seconds, n).view(np.int64)
                    at = np.flatnonzero(slab.whole(n))
                    values, first = np.unique(fps[at], return_index=True)
                    goals = np.array([w["fp"] for w in wish if w["n"] == n], dtype=np.int64)
                    spots = at[first[np.searchsorted(values, goals)]]
                    out += [(n, int(fp), lang, slab.phrase(int(p), n), int(twins[p])) for fp, p in zip(goals, spots, strict=True)]
                yield pa.RecordBatch.from_pydict(dict(zip(("n", "fp", "lang", "phrase", "twin"), map(pa.array, zip(*out, strict=True)), strict=True)))

    return texts.join(wanted, "doc").select("text", "lang", "wanted").mapInArrow(read, "n long, fp long, lang string, phrase string, twin long")


def _by_text(docs: DataFrame, doubtful: DataFrame, rows: int, hasher: Hasher, scratch: Scratch) -> DataFrame:
    """(n, lang, phrase, a): occurrences of the doubtful fingerprints, counted by their text."""
    may = Filter(doubtful, rows)

    def rows_of(slab: Slab, keys: np.ndarray) -> dict:
        words, langs, out = hasher.of_words(slab), {}, []
        for n in range(1, MAX_WORDS + 1):
            fps = hasher.of_phrases(slab, words, n)
            at = np.flatnonzero(slab.whole(n) & may.holds(fps))
            out += [(n, int(fps[i].view(np.int64)), int(keys[slab.rows[i]]), slab.phrase(int(i), n)) for i in at]
        columns = zip(*out, strict=True) if out else ([], [], [], [])
        return dict(zip(("n", "fp", "doc", "phrase"), (pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)), strict=True))

    found = _scan(docs, rows_of, "n long, fp long, doc long, phrase string").groupBy("n", "fp", "doc", "phrase").agg(F.count(F.lit(1)).alias("c"))
    langs = docs.select("doc", "lang").distinct()
    found = found.join(doubtful, ["n", "fp"], "left_semi").join(langs, "doc")
    return scratch.keep(found.groupBy("n", "lang", "phrase").agg(F.sum("c").alias("a")))


def phrase_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, longest: int = MAX_WORDS, bits: int = 64,
    scratch: Scratch | None = None,
) -> DataFrame:
    """(lang, n, phrase, a): every phrase of up to ``longest`` words with ``least`` occurrences or more per language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends and into words at blanks
    and tabs. A NULL text is empty, a NULL language is 'und'; repeated rows count as often as they
    stand there; columns other than the two are ignored; no rows give no phrases. ``bits`` shortens
    the fingerprints (for tests of colliding ones).
    """
    scratch = scratch or Scratch(docs.sparkSession)
    text, lang = F.col(f"`{text_col}`"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN_LANG))
    docs = docs.select(text.alias("text"), lang.alias("lang"), F.xxhash64(lang, text).alias("doc"))
    hasher, other = Hasher(17, bits), Hasher(71)
    plain = docs.select("text", "lang", F.lit(0).cast("long").alias("doc"))

    filters: list[Filter] = []
    for _ in range(max(1, longest - 1)):
        def level_of(slab: Slab, keys: np.ndarray, filters: list[Filter] = filters, n: int = len(filters) + 1) -> dict:
            found = [fps[at] for k, fps, at in _candidates(slab, hasher.of_words(slab), hasher, filters, n) if k == n]
            return _counted(found[0] if found else np.zeros(0, dtype=np.uint64))

        level = _frequent(_scan(plain, level_of, "fp long, c long"), least, scratch)
        filters.append(Filter(level, level.count()))
    found = _level_counts(docs, hasher, other, filters, least, longest, scratch)
    texts = scratch.keep(_read_phrases(docs, found, hasher, other, scratch))
    both = found.join(texts, ["n", "fp"])
    same = (F.col("lo") == F.col("twin")) & (F.col("hi") == F.col("twin"))
    sure = both.where(same).select("lang", "n", "phrase", F.col("c").alias("a"))
    doubtful = both.where(~same).select("n", "fp")
    rows = doubtful.count()
    if rows:
        again = _by_text(docs, doubtful, rows, hasher, scratch).where(F.col("a") >= least)
        sure = sure.unionByName(again.where(F.col("n") <= longest).select(*sure.columns))
    return sure


def word_totals(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, n): words of all texts per language, counted as in :func:`phrase_counts`."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(UNKNOWN_LANG))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            kinds = sorted(set(langs))
            code, totals = {x: i for i, x in enumerate(kinds)}, np.zeros(len(kinds), dtype=np.int64)
            codes = np.array([code[x] for x in langs], dtype=np.int64)
            for first, slab in slabs(batch.column("text"), langs):
                totals += np.bincount(codes[first:][slab.rows], minlength=len(kinds))
            yield pa.RecordBatch.from_pydict({"lang": pa.array(kinds, pa.string()), "n": pa.array(totals)})

    found = docs.select(F.col(f"`{text_col}`").alias("text"), lang.alias("lang")).mapInArrow(run, "lang string, n long")
    return found.groupBy("lang").agg(F.sum("n").alias("n"))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, longest: int = MAX_WORDS, top: int = TOP, bits: int = 64
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    A phrase scores ``floor(2000000 * a / (l + r))`` at the cut into two parts where that is least
    (the first of equal cuts). One that lies in a longer candidate with at least 80 percent of its
    occurrences is left out. Ranks go by score, occurrences (both falling) and phrase in byte order,
    so there are no ties. NULLs, repeated rows and other columns as in :func:`phrase_counts`.
    """
    scratch = Scratch(docs.sparkSession)
    counts = scratch.keep(phrase_counts(docs, text_col, lang_col, least, longest, bits, scratch))
    scratch.drop(keep_last=1)
    candidates = counts.where("n > 1").withColumn("w", F.split("phrase", " "))
    join = lambda start, size: F.array_join(F.slice("w", start, size), " ")
    cuts = candidates.select(
        "lang", "phrase", "n", "a", "w", F.explode(F.sequence(F.lit(1), F.col("n").cast("int") - 1)).alias("k")
    ).withColumns({"head": join(F.lit(1), F.col("k")), "tail": join(F.col("k") + 1, F.col("n").cast("int") - F.col("k"))})
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("a").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).withColumn(
        "score", F.expr(f"CAST(a AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(9, 0)) div CAST(l + r AS DECIMAL(20, 0))"))
    best = scored.groupBy("lang", "phrase", "n", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = candidates.where("n > 2").select("lang", "a", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("n").cast("int") - 1), lambda size: F.transform(
            F.sequence(F.lit(1), F.col("n").cast("int") - size + 1), lambda start: F.array_join(F.slice("w", start, size), " "))))).alias("phrase"))
    covers = inner.groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    left = best.join(covers, ["lang", "phrase"], "left").where(F.expr(f"cover IS NULL OR 100 * cover < {COVERED_PERCENT} * a"))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = word_totals(docs, text_col, lang_col).withColumnRenamed("n", "total")
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        F.col("total").alias("n"), F.col("cut.score").cast("long").alias("score"))
