"""Passages inside longer lines are found by their sentences; one row per document."""

import re
from collections import defaultdict

import numpy as np

from targetlens.llm.substring_dedup import SENTENCE_END, passage_report, repeated_paragraphs, shared_stretches


def plain_stretches(docs, least=50, gap=1):
    units = {}
    for key, text in docs.items():
        units[key] = [tuple(u.split()) for u in re.split(SENTENCE_END, (text or "").lower()) if u.split()]
    held = defaultdict(set)
    for key, us in units.items():
        for u in us:
            held[u].add(key)
    out = {}
    for key, us in units.items():
        stretches, last = [], None
        for k, u in enumerate(us):
            if len(held[u]) > 1:
                if last is None or k - last > gap + 1:
                    stretches.append(0)
                stretches[-1] += len(u)
                last = k
        n = sum(len(held[u]) > 1 for u in us)
        out[key] = (len(us), n, sum(s for s in stretches if s >= least), max(stretches, default=0))
    return out


def test_stretches_equal_a_plain_search(documents, texts):
    got = {r["_id"]: (r["n_sentences"], r["n_shared"], r["shared_words"], r["longest"]) for r in shared_stretches(documents).collect()}
    assert got == plain_stretches(texts)
    assert sum(v[2] > 0 for v in got.values()) > 5


def test_documents_that_share_fifty_words(documents, texts):
    seen = defaultdict(set)
    for i, t in texts.items():
        words = (t or "").lower().split()
        for k in range(len(words) - 49):
            seen[tuple(words[k:k + 50])].add(i)
    planted = {i for s in seen.values() if len(s) > 1 for i in s}
    found = {r["_id"] for r in passage_report(documents).collect() if r["n_passage_words"] > 0}
    assert len(planted & found) >= 0.9 * len(planted) > 0
    assert len(found - planted) <= 0.1 * (len(texts) - len(planted))


def test_passage_inside_lines_of_own_text(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage = ". ".join(prose(12) for _ in range(8))
    rows = [(i, f"{prose(30)}. {prose(5)} {passage} {prose(9)}. {prose(30)}.") for i in range(6)]
    rows += [(10 + i, f"{prose(60)}. Short and common! {prose(50)}") for i in range(6)] + [(None, passage), (20, None), (21, "")]
    report = {r["_id"]: r for r in passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, r in report.items() if r["n_passage_words"] >= 60} == set(range(6)) | {None}
    assert report[10]["n_shared"] == 1 and report[10]["n_passage_words"] == 0 and report[20]["n_sentences"] == report[21]["n_sentences"] == 0


def test_report_on_messy_rows(messy, nothing):
    docs = messy.select("doc_id", "text", "lang", "node", "line", "kept")
    assert passage_report(docs).count() == docs.count() and passage_report(nothing).count() == 0


def test_report_lists_what_is_under_fifty_words(spark):
    rng = np.random.default_rng(5)
    prose = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))
    line, sentence = prose(20), prose(12) + "!"
    rows = [(1, f"{prose(30)}\n{line}"), (2, f"{line}\n{prose(30)}"), (3, f"{prose(9)}. {sentence} {prose(9)}"), (4, f"{sentence} {prose(40)}")]
    rows += [(5, prose(60)), (6, None)]
    report = {r["_id"]: r for r in passage_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [report[i]["n_passage_words"] for i in range(1, 7)] == [0] * 6
    at = {i: [(x["line"], x["n_words"], x["kept_id"], x["kept_line"], x["kept"]) for x in report[i]["repeated"]] for i in report}
    assert at == {1: [(1, 20, 1, 1, True)], 2: [(0, 20, 1, 1, False)], 3: [], 4: [], 5: [], 6: []}
    assert report[1]["repeated"][0]["class_id"] == report[2]["repeated"][0]["class_id"] and report[2]["repeated_words"] == 20
    assert [[(x["number"], x["n_words"]) for x in report[i]["shared"]] for i in range(1, 7)] == [[(1, 20)], [(0, 20)], [(1, 12)], [(0, 12)], [], []]
    assert report[3]["shared"][0]["class_id"] == report[4]["shared"][0]["class_id"] and report[3]["n_shared_words"] == 12


def test_report_holds_every_place(documents):
    listed = {(r["_id"], x["line"], x["class_id"]) for r in passage_report(documents).collect() for x in r["repeated"]}
    assert listed == {(r["_id"], r["line"], r["class_id"]) for r in repeated_paragraphs(documents).collect()} != set()
