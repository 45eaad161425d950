"""Quality rules, decontamination and licence scan against plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from targetlens.llm.decontamination import contamination, keep_clean
from targetlens.llm.license_scan import PHRASES, license_report, license_spans
from targetlens.llm.quality_rules import keep_good, judged, quality_report

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered), failed)


def reported(rows):
    return Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
        for r in rows
    )


def test_quality_counts(documents, texts):
    rows = quality_report(documents).collect()
    assert reported(rows) == Counter((i, *counts(t)) for i, t in texts.items())
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_quality_on_messy_rows(messy, nothing):
    rows = quality_report(messy).collect()
    assert reported(rows) == Counter((r["doc_id"], *counts(r["text"])) for r in messy.collect())
    kept = keep_good(messy)
    assert kept.columns == messy.columns
    assert kept.count() == sum(r["kept"] for r in rows)
    assert quality_report(nothing).count() == 0
    assert keep_good(nothing).count() == 0


def test_limits_follow_their_group(spark):
    prose = "plain words of an honest text that goes on for more than ten words number"
    rows = [(i, f"{prose} {i}", "en", "clean") for i in range(300)]
    rows += [(1000 + i, " ".join(f"{w}#*$ ##" for w in f"{prose} {i}".split()), "en", "clean") for i in range(20)]
    rows += [(2000 + i, " ".join(f"{w} | <{w}>" for w in f"{prose} {i}".split()), "en", "tables") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"] for r in quality_report(docs).where("kept").collect()}
    assert set(range(300)) <= kept  # the clean ones stay
    assert not kept & set(range(1000, 1020))  # outliers of a clean source go
    assert set(range(2000, 2300)) <= kept  # what is usual in its source stays
    assert judged(docs).count() == len(rows)


def windows_of(items):
    found = defaultdict(set)
    for item, text in items:
        words = plain(text)
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            found[tuple(words[i:i + size])].add(str(item))
    return found


def leaked(text, windows):
    words, hit, items = plain(text), set(), set()
    for size in {len(w) for w in windows}:
        for i in range(len(words) - size + 1):
            key = tuple(words[i:i + size])
            if key in windows:
                hit.update(range(i, i + size))
                items |= windows[key]
    digest = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
    return (len(words), len(hit), len(items), digest, bool(hit))


def leaks(rows):
    return Counter((r["_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows)


ITEMS = [
    (10, "Brown fox jumps over the lazy dog while twelve small birds sing in the old garden"), (2, "brown FOX jumps"),
    (3, None), (4, "..."), (5, "word word word word word word word word word word word"), (2, "brown FOX jumps"), (None, "Straße"),
]


@pytest.mark.parametrize("items", [ITEMS, []])
def test_contamination(spark, messy, nothing, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    windows = windows_of([i for i in items if i[0] is not None])
    extra = windows_of([i for i in items if i[0] is None])
    rows = contamination(messy, bench).collect()
    docs = messy.select("doc_id", "text").collect()
    assert Counter((r["_id"], r["n_words"], r["n_hit"]) for r in rows) == Counter(
        (d["doc_id"], *leaked(d["text"], {**windows, **extra})[:2]) for d in docs
    )
    clean = keep_clean(messy, bench)
    assert clean.columns == messy.columns
    assert clean.count() == sum(not r["contaminated"] for r in rows)
    assert contamination(nothing, bench).count() == 0


def test_contamination_of_documents(spark, documents, texts):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    windows = windows_of([(r["item_id"], r["text"]) for r in bench.collect()])
    expected = Counter((i, *leaked(t, windows)) for i, t in texts.items())
    assert leaks(contamination(documents, bench).collect()) == expected


def phrases(text):
    words = plain(text)
    places = [
        (i, label) for phrase, label in PHRASES.items() for i in range(len(words))
        if words[i:i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))


def test_licences(spark, documents, messy, nothing):
    shape = lambda rows: Counter((r["_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in rows)
    for docs in (documents, messy):
        expected = Counter((r["doc_id"], *phrases(r["text"])) for r in docs.select("doc_id", "text").collect())
        assert shape(license_report(docs).collect()) == expected
    assert license_report(nothing).count() == 0


def test_licence_wording_with_changes(spark):
    notice = (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this (excellent) software and "
        "associated documentation files, to deal in the software without any restriction including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense and or sell copies of the software"
    )
    rows = [
        (1, "intro words " + notice + " outro"), (2, "the rights to use and copy of this software"),
        (3, "CC BY cc by, All rights reserved; GNU General Public License"), (4, "cc\nby general public"),
        (5, "Licensed under CC BY-NC 4.0. Released under the MIT license."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["_id"]: r for r in license_report(docs).collect()}
    assert got[1]["labels"] == "mit" and 0.8 <= got[1]["score"] <= 1 and got[1]["n_base"] == 0
    assert got[2]["labels"] == "" and got[2]["score"] == 0
    assert got[3]["n_base"] == 4 and got[3]["base_labels"] == "cc-by,gpl,reserved"
    assert got[3]["first_word"] == 0 and got[3]["last_word"] == 8
    assert got[4]["base_labels"] == "cc-by"
    assert set(got[5]["labels"].split(",")) == {"cc-by", "cc-by-nc", "mit"}
    span = license_spans(docs).where(F.col("label") == "mit").where("_id = 1").first()
    assert span["first"] == 2
