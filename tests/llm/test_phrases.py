"""Collocations against a plain count of all n-grams."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from targetlens.llm.phrases import Hasher, Slab, collocations, phrase_counts

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def plain_counts(rows, longest=4):
    """{lang: Counter of word tuples} by slicing every piece."""
    found = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            words = re.findall(r"[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                found[lang or "und"].update(tuple(words[i:i + n]) for i in range(len(words) - n + 1))
    return found


def plain_collocations(rows, least=30, top=2000):
    out = []
    for lang, f in plain_counts(rows).items():
        total = sum(c for w, c in f.items() if len(w) == 1)
        cands = {w: c for w, c in f.items() if len(w) > 1 and c >= least}
        inside = defaultdict(int)
        for w, c in cands.items():
            for size in range(2, len(w)):
                for i in range(len(w) - size + 1):
                    inside[w[i:i + size]] = max(inside[w[i:i + size]], c)
        rows_ = []
        for w, a in cands.items():
            if 100 * inside.get(w, 0) >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[w[:k]] + f[w[k:]]), k) for k in range(1, len(w)))
            rows_.append((-score, -a, " ".join(w).encode(), f[w[:k]], f[w[k:]]))
        rows_.sort()
        out += [(lang, i + 1, p.decode(), -a, l, r, total, -s) for i, (s, a, p, l, r) in enumerate(rows_[:top])]
    return sorted(out)


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_collocations_equal_a_plain_count(documents):
    rows = [(r["lang"], r["text"]) for r in documents.select("lang", "text").collect()]
    expected = plain_collocations(rows)
    assert len(expected) > 40
    assert as_rows(collocations(documents)) == expected


def test_top_of_each_language(documents):
    rows = [(r["lang"], r["text"]) for r in documents.select("lang", "text").collect()]
    assert as_rows(collocations(documents, least=5, top=7)) == plain_collocations(rows, 5, 7)


@pytest.mark.parametrize("bits", [8, 13])
def test_colliding_fingerprints_are_counted_by_text(spark, documents, bits):
    docs = documents.orderBy("doc_id").limit(40)
    rows = [(r["lang"], r["text"]) for r in docs.select("lang", "text").collect()]
    assert as_rows(collocations(docs, least=10, bits=bits)) == plain_collocations(rows, 10)


def test_messy_rows(spark, messy, nothing):
    rows = [(r["lang"], r["text"]) for r in messy.select("lang", "text").collect()]
    assert as_rows(collocations(messy, least=2)) == plain_collocations(rows, 2)
    assert collocations(nothing).count() == 0
    assert collocations(messy.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_pieces_blanks_and_covered_phrases(spark):
    texts = ["Of  the\tNew York; Times of, the"] * 3 + ["new york city.new york\x0bcity", "of the of the", "É é É é ÉA éa"]
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string")
    assert as_rows(collocations(docs, least=2)) == plain_collocations([("en", t) for t in texts], 2)
    counts = {r["phrase"]: r["a"] for r in phrase_counts(docs, least=1).collect()}
    assert counts["of the"] == 5 and "times of" in counts and "york times" not in counts and counts["of the new york"] == 3


def test_scores_past_64_bits(spark):
    counts = spark.createDataFrame([(9_300_000_000_000, 10_000_000_000_000)], "a long, s long")
    got = counts.selectExpr("CAST(a AS DECIMAL(20, 0)) * CAST(2000000 AS DECIMAL(9, 0)) div CAST(s AS DECIMAL(20, 0)) AS v").first()["v"]
    assert got == 2_000_000 * 9_300_000_000_000 // 10_000_000_000_000


def test_fingerprints_depend_on_words_and_language_only():
    import numpy as np

    data = np.frombuffer("ab  Cd ab\tcd".encode(), dtype=np.uint8)
    slab = Slab(data, np.array([0, len(data)]), np.array([5], dtype=np.uint64))
    hasher = Hasher(17)
    words = hasher.of_words(slab)
    assert words[0] == words[2] and words[1] == words[3] != words[0]
    pairs = hasher.of_phrases(slab, words, 2)
    assert pairs[0] == pairs[2] != pairs[1]
