"""Quality rules with thresholds learned per language and source from quantile sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from targetlens.llm.common import Scratch, bounded, let, space_words, unboxed

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SKETCH_K = 1024
#: Rows at which a group's own quantiles count as much as those of its language, and a language's as much as all.
HALF_WEIGHT = 200
#: Inner and tail quantile of a rate, how many of their distances a limit lies outside the tail, and the
#: distance that counts if a group has less spread. Most rates are zero in most texts, so those that good
#: texts have as well look at the last hundredth; symbols and word lengths, of which a twentieth of all
#: texts is junk, at the last tenth. Calibrated on labels.quality, see the README.
TAILS = {
    "symbol_rate": (0.5, 0.9, 2.0, 0.005), "dup_line_rate": (0.9, 0.99, 1.0, 0.05), "repeat_rate": (0.9, 0.99, 1.0, 0.02),
    "mean_word": (0.5, 0.9, 2.0, 0.05), "shout_rate": (0.9, 0.99, 1.0, 0.01),
}
UPPER_SIDE_ONLY = ("symbol_rate", "dup_line_rate", "repeat_rate", "shout_rate")


def _covered(hashes: Column) -> Column:
    """Number of words inside windows whose hash occurs twice or more."""
    def spread(found: Column) -> Column:
        steps = F.transform(
            found, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(found, j + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)

    def repeated(ordered: Column) -> Column:
        twin = lambda x, j: (
            ((j > 0) & (F.get(ordered, j - 1)["h"] == x["h"]))
            | F.coalesce(F.get(ordered, j + 1)["h"] == x["h"], F.lit(False))
        )
        places = F.transform(F.filter(ordered, twin), lambda x: x["p"])
        return let(F.sort_array(places), spread)

    pairs = F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    return let(F.sort_array(pairs), repeated)


def _repeat_words(words: Column) -> Column:
    last = F.size(words) - WINDOW + 1
    windows = F.when(
        last >= 2, F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    )
    count = lambda hashes: F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes), _covered(hashes)
    ).otherwise(F.lit(0).cast("long"))
    return F.coalesce(let(windows, count), F.lit(0).cast("long"))


def text_statistics(text: Column) -> Column:
    """Struct of counts over the whole text: words, their characters, symbols, repeated lines and words."""
    text = F.coalesce(text, F.lit(""))
    word_part = let(space_words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeat_words(w).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.rlike(r"\p{Lu}") & ~x.rlike(r"\p{Ll}"))).cast("long").alias("n_shout"),
    ))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    line_part = let(lines, lambda l: F.struct(
        F.size(l).cast("long").alias("n_lines"),
        (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
    ))
    symbols = F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long")
    return let(word_part, lambda w: let(line_part, lambda l: F.struct(
        w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"), symbols.alias("n_symbols"),
        l["n_dup_lines"].alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words"),
        l["n_lines"].alias("n_lines"), w["n_shout"].alias("n_shout"),
    )))


def _rates(s: str) -> dict[str, Column]:
    part = lambda a, b: F.coalesce(F.try_divide(F.col(f"{s}.{a}"), F.col(f"{s}.{b}")), F.lit(0.0))
    return {
        "symbol_rate": part("n_symbols", "word_chars"), "dup_line_rate": part("n_dup_lines", "n_lines"),
        "repeat_rate": part("n_repeat_words", "n_words"), "mean_word": part("word_chars", "n_words"),
        "shout_rate": part("n_shout", "n_words"),
    }


def base_failed(s: str) -> Column:
    words = F.col(f"{s}.n_words")
    return (words < MIN_WORDS) | (100 * F.col(f"{s}.n_repeat_words") > MAX_REPEAT_PERCENT * words)


def learned_limits(rates: DataFrame) -> DataFrame:
    """(lang, source, low_<rate>, high_<rate>) from mergeable quantile sketches.

    ``rates`` holds lang, source and the rates of the documents that pass the base rules. Each
    (lang, source) has its own sketch; its quantiles are blended by row count with those of the merged
    sketches of its language, and these with those of all languages, so no size is a switch. A limit
    lies outside a tail quantile, by a multiple of its distance from an inner one (``TAILS``).
    """
    names = list(TAILS)
    group = rates.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"), *[F.kll_sketch_agg_double(n, F.lit(SKETCH_K)).alias(n) for n in names]
    )
    merged = lambda df, *keys: df.groupBy(*keys).agg(
        F.sum("n").alias("n"), *[F.kll_merge_agg_double(n).alias(n) for n in names]
    )
    scratch = Scratch(rates.sparkSession)
    group = scratch.keep(group)
    lang = merged(group, "lang").select(
        F.col("lang").alias("_lang"), F.col("n").alias("n_lang"), *[F.col(n).alias(f"lang_{n}") for n in names]
    )
    everything = merged(group).select(*[F.col(n).alias(f"all_{n}") for n in names])
    wide = group.join(lang, F.col("lang").eqNullSafe(F.col("_lang"))).join(F.broadcast(everything))
    own, lang_own = (F.col(c) / (F.col(c) + HALF_WEIGHT) for c in ("n", "n_lang"))

    def at(name: str, q: float) -> Column:
        group, lang, overall = (F.kll_sketch_get_quantile_double(s + name, F.lit(q)) for s in ("", "lang_", "all_"))
        return own * group + (1 - own) * (lang_own * lang + (1 - lang_own) * overall)

    limits = []
    for n, (inner, tail, fence, least) in TAILS.items():
        width = lambda x, y: F.lit(fence) * F.greatest(y - x, F.lit(least))
        limits.append((at(n, tail) + width(at(n, inner), at(n, tail))).alias(f"high_{n}"))
        low = at(n, 1 - tail) - width(at(n, 1 - tail), at(n, 1 - inner))
        limits.append((F.lit(float("-inf")) if n in UPPER_SIDE_ONLY else low).alias(f"low_{n}"))
    return scratch.keep(wide.select("lang", "source", *limits))


def judged(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(_row, _stats, _base_failed, _kept): each row of ``docs`` as a struct, its counts and verdicts.

    A NULL or empty text has no words and fails the base rules. NULL languages and sources form
    groups of their own. Repeated rows each keep their row; an empty table gives no rows. The
    thresholds are one small row per (lang, source), joined on both; the counts are computed once
    for the thresholds and once for the verdicts, so that no text is ever shuffled.
    """
    counted = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"), text_statistics(F.col(text_col)).alias("_stats"),
    )
    measured = counted.where(~base_failed("_stats")).select(
        "lang", "source", *[c.alias(n) for n, c in _rates("_stats").items()]
    )
    return _with_verdict(counted, learned_limits(measured), "lang", "source").select(
        "_row", "_stats", "_base_failed", "_kept"
    )


def _with_verdict(counted: DataFrame, limits: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    limits = limits.withColumnsRenamed({c: f"_limit_{c}" for c in limits.columns})
    joined = counted.join(
        limits,
        F.col(lang_col).eqNullSafe(F.col("_limit_lang")) & F.col(source_col).eqNullSafe(F.col("_limit_source")),
        "left",
    )
    inside = F.lit(True)
    for name, rate in _rates("_stats").items():
        inside = inside & rate.between(F.col(f"_limit_low_{name}"), F.col(f"_limit_high_{name}"))
    verdict = joined.withColumn("_base_failed", base_failed("_stats")).withColumn(
        "_kept", ~F.col("_base_failed") & F.coalesce(inside, F.lit(True))
    )
    return verdict.drop(*limits.columns)


def quality_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: id, counts and both verdicts, from one pass over the texts."""
    scratch = Scratch(docs.sparkSession)
    counted = scratch.keep(docs.select(
        "doc_id", "lang", "source", text_statistics(F.col("text")).alias("_stats")
    ))
    measured = counted.where(~base_failed("_stats")).select(
        "lang", "source", *[c.alias(n) for n, c in _rates("_stats").items()]
    )
    return _with_verdict(counted, learned_limits(measured), "lang", "source").select(
        "doc_id", "_stats.n_words", "_stats.word_chars", "_stats.n_symbols", "_stats.n_dup_lines",
        "_stats.n_repeat_words", F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
    )


def keep_good(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs``.

    The verdict depends on text, language and source only; rows that agree in them share it, repeated
    rows and NULLs included. The counts are made in one pass and kept beside a 64-bit hash of the
    three; rejected hashes are joined back. NULL and empty texts fail; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession)
    lang, source = F.col(f"`{lang_col}`"), F.col(f"`{source_col}`")
    named = lambda c: [F.isnull(c), F.coalesce(c.cast("string"), F.lit(""))]
    key = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), *named(lang), *named(source))
    counted = scratch.keep(docs.select(
        key.alias("_key"), lang.alias("lang"), source.alias("source"), text_statistics(F.col(f"`{text_col}`")).alias("_stats")))
    measured = counted.where(~base_failed("_stats")).select("lang", "source", *[c.alias(n) for n, c in _rates("_stats").items()])
    judged_rows = _with_verdict(counted, learned_limits(measured), "lang", "source")
    bad = scratch.keep(judged_rows.where(~F.col("_kept")).select("_key").distinct())
    scratch.only(bad)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), key.alias("_key"))
    return rows.join(bounded(bad, bad.count()), "_key", "left_anti").select(*unboxed(docs.columns))
