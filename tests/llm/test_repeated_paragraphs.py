"""Every paragraph of a class is reported, whatever the length of its run."""

from collections import defaultdict

import numpy as np

from targetlens.llm.substring_dedup import remove_passages, repeated_paragraphs, repeated_passages
from test_duplicates import passages


def test_all_equal_paragraphs(documents, texts):
    places = defaultdict(set)
    for i, t in texts.items():
        for k, line in enumerate((t or "").split("\n")):
            if line.split():
                places[tuple(line.lower().split())].add((i, k))
    equal = {p for ps in places.values() if len(ps) > 1 for p in ps}
    rows = repeated_paragraphs(documents).collect()
    assert {(r["_id"], r["line"]) for r in rows} >= equal
    assert any(r["run_words"] < 50 for r in rows) and any(not r["across"] for r in rows)
    assert {(r["_id"], r["line"], r["kept_id"], r["kept"]) for r in rows if r["run_words"] >= 1} == passages(list(texts.items()), 1)
    per_class = defaultdict(list)
    for r in rows:
        per_class[r["class_id"]].append(r)
    assert all(len(c) > 1 and sum(r["kept"] for r in c) == 1 for c in per_class.values())


def test_short_lines_gaps_and_copies_inside(spark):
    rng = np.random.default_rng(12)
    prose = lambda n: " ".join("".join(rng.choice(list("abcdefghij"), 6)) for _ in range(n))
    parts, inside, short = [prose(20) for _ in range(4)], prose(30), "a short shared line"
    rows = [(i, "\n".join([prose(9), parts[0], parts[1], prose(20), parts[2], prose(9), prose(9), parts[3]])) for i in range(3)]
    rows += [(10, "\n".join([inside, prose(9), inside])), (11, f"{prose(60)}\n{short}"), (12, f"{prose(60)}\n{short}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {(r["_id"], r["line"]): r for r in repeated_paragraphs(docs).collect()}
    assert set(found) == {(i, k) for i in range(3) for k in (1, 2, 4, 7)} | {(10, 0), (10, 2), (11, 1), (12, 1)}
    assert [(found[0, k]["run_words"], found[0, k]["passage_words"], found[0, k]["in_passage"]) for k in (1, 2, 4, 7)] == [
        (40, 60, True), (40, 60, True), (20, 60, True), (20, 20, False)]
    assert [found[10, k]["across"] for k in (0, 2)] == [False, False] and found[10, 0]["kept"] and not found[10, 2]["kept"]
    assert found[12, 1]["kept_id"] == 11 and found[12, 1]["passage_words"] == 4
    assert repeated_passages(docs).count() == 0
    left = {r["doc_id"]: r["text"] for r in remove_passages(docs).collect()}
    assert short in left[11] and short not in left[12] and left[10].count(inside) == 1
    assert all(p in left[0] and p not in left[1] for p in parts)
