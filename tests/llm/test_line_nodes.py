"""What line dedup makes once: blocks of equal lines, nodes of shared buckets, distances of differing stretches."""

from collections import Counter

import numpy as np

from targetlens.llm.common import Scratch
from targetlens.llm.edit_distances import edit_distances
from targetlens.llm.line_blocks import line_table
from targetlens.llm.line_dedup import differing, gone_lines, normal_lines, normalised, similar_normal, similar_pairs
from targetlens.llm.linking import crowded
from test_edit_distances import made_pairs

ODD = ["", "\n\n", "a\r\nb\r", "Σ\nΑΣ\nΑΣ b\n### ***\n \n x\x85y\nÜnï-çødé ßtraße 😀 日本語\nİI\x0bq\x1cr\n"]


def test_normal_lines_of_a_text():
    for text in ODD:
        assert list(normal_lines(text)) == [(i, normalised(x)) for i, x in enumerate(text.split("\n")) if x and not x.isspace()]


def test_equal_lines_have_blocks_once(spark):
    texts = ["one two three four five six\n\nseven eight nine", "One two, three four five six", None, "### ***", ODD[-1]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    rows = line_table(docs, "doc_id", "text", normal_lines).collect()
    assert Counter(r["node"] for r in rows if r["blocks"] is not None) == {r["node"]: 1 for r in rows}
    assert all((r["blocks"] is None) == (r["fp"] is None) == (r["size"] is None) for r in rows)
    assert sorted((r["_id"], r["n"]) for r in rows if r["n"] is not None) == [(0, 2), (1, 1), (3, 1), (4, 7)]
    assert max(Counter(r["node"] for r in rows).values()) == 2


def test_repeated_members(spark):
    members = spark.createDataFrame([(1, 5), (1, 5), (2, 5), (2, 6), (3, 5), (3, 6), (3, 6), (4, 1), (4, 2), (4, 3)], "bucket long, node long")
    twos, inside = crowded(members, Scratch(spark))
    assert [tuple(r) for r in twos.collect()] == [(5, 6)]
    assert {tuple(r) for r in inside.collect()} == {(3, 5), (3, 6), (4, 1), (4, 2), (4, 3)}


def test_gone_lines(spark):
    rows = [(2, 9, 0, 1), (1, 9, 0, 1), (1, 9, 3, 1), (None, 8, 0, 2), (5, 9, 0, 2), (4, 9, 0, 3), (6, 9, 0, 4)]
    lines = spark.createDataFrame([r for r in rows for _ in range(1 + (r[0] == 2))], "_id long, _h long, line int, node long")
    links = spark.createDataFrame([(2, 3)], "a long, b long")
    got = {(r["_id"], r["line"]) for r in gone_lines(lines, links, Scratch(spark)).collect()}
    assert got == {(2, 0), (1, 3), (None, 0), (5, 0)}


def test_differing_stretch():
    a, b = zip(*made_pairs(np.random.default_rng(9)))
    inner = [differing(x, y) for x, y in zip(a, b)]
    assert (edit_distances(*zip(*inner)) == edit_distances(a, b)).all()
    assert all(not x or not y or (x[0] != y[0] and x[-1] != y[-1]) for x, y in inner)
    assert differing("abcab", "abcabcab")[0] == "" and differing("same", "same") == ("", "")
    assert (similar_pairs(similar_normal)(a, b) == [similar_normal(x, y) for x, y in zip(a, b)]).all()
