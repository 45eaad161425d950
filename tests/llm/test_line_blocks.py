"""The registered form of line dedup against all pairs, and how many similar pairs its blocks find."""

from collections import Counter

import numpy as np

from targetlens.llm.line_blocks import MAX_DISTANCE, line_prints, majority
from targetlens.llm.line_dedup import dedup_lines, line_words, normalised, similar_characters
from test_duplicates import Groups, hash_of, slow_distance
from test_similar_lines import other_words, prose, typos


def test_normal_form():
    for line in ["A b_c  d", "Ünï-çødé ßtraße 😀 日本語", "### ***", "_ _", "x", "a b c ’d’", "Ⅻ ² ½_½"]:
        assert normalised(line) == " ".join(line_words(line))


def test_majority():
    rng = np.random.default_rng(8)
    sizes = [1, 5, 300, 3]
    hashes, weights = rng.integers(0, 1 << 63, sum(sizes), dtype=np.uint64), rng.integers(1, 30, sum(sizes)).astype(np.uint64)
    weights[-1] = 70000
    starts = np.cumsum([0, *sizes[:-1]])
    for got, a, n in zip(majority(hashes, weights, starts), starts, sizes):
        want = sum(1 << b for b in range(64) if 2 * sum(int(w) for h, w in zip(hashes[a:a + n], weights[a:a + n]) if int(h) >> b & 1) > int(weights[a:a + n].sum()))
        assert int(got) % (1 << 64) == want


def blocks_of(lines):
    prints, counts, blocks = line_prints(lines)
    ends = np.cumsum(counts)
    return prints.view(np.uint64), [set(blocks[e - n:e].tolist()) for e, n in zip(ends, counts)]


def test_prints_do_not_depend_on_company():
    rng = np.random.default_rng(1)
    lines = [prose(rng, int(n)) for n in rng.integers(1, 60, 50)]
    prints, blocks = blocks_of(lines)
    for line, p, b in zip(lines, prints, blocks):
        one, own = blocks_of([line])
        assert one[0] == p and own == [b] and b


def met(pairs):
    (a, one), (b, two) = (blocks_of([normalised(x) for x in side]) for side in zip(*pairs))
    return np.mean((np.bitwise_count(a ^ b) <= MAX_DISTANCE) & [bool(x & y) for x, y in zip(one, two)])


def test_recall():
    rng = np.random.default_rng(4)
    for words, edit, least in [
        (27, lambda x: typos(rng, x, 1), 0.97), (27, lambda x: typos(rng, x, 2), 0.93), (60, lambda x: typos(rng, x, 3), 0.97),
        (60, lambda x: other_words(rng, x, 0.05), 0.97), (60, lambda x: other_words(rng, x, 0.1), 0.9),
    ]:
        pairs = [(x, edit(x)) for x in (prose(rng, words) for _ in range(300))]
        assert met([p for p in pairs if similar_characters(*p)]) >= least, words
    assert met([(prose(rng, 27), prose(rng, 27)) for _ in range(300)]) < 0.02


def expected(rows):
    """(id, text, n_lines, n_kept) by union-find over all pairs of lines that share a block, are near and similar."""
    texts = sorted({(i is None, i or 0, t or "") for i, t in rows}, key=lambda r: (*r[:2], hash_of(r[2])))
    places = [(no, i, hash_of(t), k, normalised(x)) for no, i, t in texts for k, x in enumerate(t.split("\n")) if x and not x.isspace()]
    names = sorted({p[4] for p in places})
    prints, blocks = blocks_of(names)
    groups = Groups()
    for a, x in enumerate(names):
        for b in range(a + 1, len(names)):
            y = names[b]
            if blocks[a] & blocks[b] and int(prints[a] ^ prints[b]).bit_count() <= MAX_DISTANCE:
                if slow_distance(x, y) <= int(0.2 * max(len(x), len(y)) + 1e-9):
                    groups.join(x, y)
    first = {}
    for p in sorted(places):
        first.setdefault(groups.find(p[4]), p[:4])
    kept = {p[:4] for p in places if first[groups.find(p[4])] == p[:4]}
    out = Counter()
    for i, t in rows:
        key, lines = (i is None, i or 0, hash_of(t or "")), (t or "").split("\n")
        real = [k for k, x in enumerate(lines) if x and not x.isspace()]
        stay = [k for k in range(len(lines)) if k not in real or (*key, k) in kept]
        out[(i, None if t is None else "\n".join(lines[k] for k in stay), len(real), sum((*key, k) in kept for k in real))] += 1
    return out


def test_registered_form(spark, documents, messy, nothing):
    rng = np.random.default_rng(6)
    lines = [prose(rng, int(n)) for n in rng.integers(5, 40, 60)]
    edited = [r for i, x in enumerate(lines) for r in ((1000 + 2 * i, x), (1001 + 2 * i, typos(rng, x, 1 + i % 2)))]
    few = [(r["doc_id"], r["text"]) for r in documents.where("n_chars < 1500").collect()]
    for rows in (edited + few, [(r["doc_id"], r["text"]) for r in messy.where("text IS NULL OR length(text) < 40000").collect()]):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        got = dedup_lines(docs, similar=similar_characters, segments=True).collect()
        assert Counter((r["doc_id"], r["text"], r["_n_lines"], r["_n_kept"]) for r in got) == expected(rows)
    whole = dedup_lines(messy, similar=similar_characters, segments=True)
    assert whole.count() == messy.count() and whole.columns == [*messy.columns, "_n_lines", "_n_kept"]
    assert dedup_lines(nothing, segments=True).count() == 0
