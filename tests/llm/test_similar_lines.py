"""Lines that are similar in characters: the edit check, and what of it the dedup finds."""

import numpy as np

from targetlens.llm.line_dedup import MAX_SKETCH_DISTANCE, dedup_lines, gram_sketches, similar_characters
from test_duplicates import slow_distance


def test_edit_similarity():
    rng = np.random.default_rng(2)
    for size in (1, 5, 30, 200, 900):
        for change in (0, 0.05, 0.15, 0.19, 0.21, 0.3):
            a = " ".join("".join(rng.choice(list("abcdef "), size)).split())
            b = "".join(c if rng.random() > change else "z" for c in a) + "y" * int(size * change / 4)
            want = slow_distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9)
            assert similar_characters(a, b) == want == similar_characters(b, a)


def test_a_letter_is_not_a_word(spark):
    """A changed letter in a line of three words is within 0.8, though a word of three is not."""
    assert similar_characters("alpha beta gamma delta", "alpha beta gamma delte")
    word = "incomprehensibilities" * 6
    docs = spark.createDataFrame([(1, f"{word} of it"), (2, f"{word} of its")], "doc_id long, text string")
    left = {r["doc_id"]: r["text"] for r in dedup_lines(docs, similar=similar_characters).collect()}
    assert left == {1: f"{word} of it", 2: ""}


def prose(rng, n):
    return " ".join("".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(n))


def typos(rng, line, n):
    out = list(line)
    for k in rng.choice([i for i, c in enumerate(line) if c != " "], n, replace=False):
        out[k] = "z"
    return "".join(out)


def other_words(rng, line, share):
    """``line`` with as many of its words replaced as ``share`` of its characters allows."""
    words, left = line.split(), int(share * len(line))
    for k in rng.permutation(len(words)):
        if len(words[k]) <= left:
            left -= len(words[k])
            words[k] = "z" * len(words[k])
    return " ".join(words)


def met(pairs):
    """Share of the pairs that have a band in common and near sketches."""
    (a, one), (b, two) = (gram_sketches(list(x)) for x in zip(*pairs))
    near = np.bitwise_count((a ^ b).view(np.uint64)) <= MAX_SKETCH_DISTANCE
    return np.mean([bool(n and set(x) & set(y)) for n, x, y in zip(near, one, two)])


def test_recall_of_grams():
    rng = np.random.default_rng(4)
    for words, edit, least in [
        (3, lambda x: typos(rng, x, 1), 0.85), (6, lambda x: typos(rng, x, 1), 0.98), (27, lambda x: typos(rng, x, 1), 0.999),
        (14, lambda x: typos(rng, x, 2), 0.99), (27, lambda x: typos(rng, x, 2), 0.999), (60, lambda x: typos(rng, x, 4), 0.999),
        (14, lambda x: other_words(rng, x, 0.2), 0.9), (27, lambda x: other_words(rng, x, 0.2), 0.9), (60, lambda x: other_words(rng, x, 0.1), 0.99),
    ]:
        pairs = [(x, edit(x)) for x in (prose(rng, words) for _ in range(300))]
        pairs = [p for p in pairs if similar_characters(*p)]
        assert met(pairs) >= least, (words, met(pairs))
    assert met([(prose(rng, 27), prose(rng, 27)) for _ in range(300)]) < 0.02


def test_dedup_finds_typos(spark):
    """Every second document repeats the line of the one before with one or two letters changed."""
    rng = np.random.default_rng(6)
    lines = [prose(rng, int(n)) for n in rng.integers(5, 40, 100)]
    rows = [r for i, x in enumerate(lines) for r in ((2 * i, x), (2 * i + 1, typos(rng, x, 1 + i % 2)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"] for r in dedup_lines(docs, similar=similar_characters, grams=True).collect() if r["_n_kept"]}
    assert kept >= set(range(0, 200, 2))
    assert len(kept) <= 102
