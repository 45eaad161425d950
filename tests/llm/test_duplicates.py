"""Line, passage and document duplicates against plain union-find; the pipeline end to end."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
from xxhash import xxh64_intdigest

import corpus_pipeline
from targetlens.llm.components import connected_components
from targetlens.llm.line_dedup import dedup_lines, edit_distance, line_fingerprints, line_words, normalised, similar_words
from targetlens.llm.simhash_dedup import fingerprint, keep_one, simhash_near_duplicates
from targetlens.llm.substring_dedup import BANDS, remove_passages, repeated_passages, tuned_bands


class Groups:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[max(self.find(a), self.find(b))] = min(self.find(a), self.find(b))


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    pairs += [(5000, 6000 + i) for i in range(200)] + [(7, 7), (None, 3)]
    groups = Groups()
    for a, b in pairs:
        if a is not None and a != b:
            groups.join(a, b)
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: groups.find(n) for n in groups.up}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(texts):
    for text in [None, "", "one", "One two", "a b c", "É É É é", *list(texts.values())[:40]]:
        assert fingerprint(text) % (1 << 64) == slow_fingerprint(text)


def test_simhash_groups(spark, documents, texts, messy, nothing):
    for docs in (documents, messy):
        rows = docs.select("doc_id", "text").collect()
        prints = sorted({fingerprint(r["text"]) % (1 << 64) for r in rows})
        groups = Groups()
        for i, a in enumerate(prints):
            for b in prints[i:]:
                if (a ^ b).bit_count() <= 3:
                    groups.join(a, b)
        least = {}
        for r in rows:
            root = groups.find(fingerprint(r["text"]) % (1 << 64))
            if r["doc_id"] is not None:
                least[root] = min(least.get(root, r["doc_id"]), r["doc_id"])
        expected = Counter((r["doc_id"], least.get(groups.find(fingerprint(r["text"]) % (1 << 64)))) for r in rows)
        got = simhash_near_duplicates(docs).collect()
        assert Counter((r["_id"], r["component_id"]) for r in got) == expected
        kept = keep_one(docs)
        assert kept.columns == docs.columns
        assert kept.count() == len({groups.find(fingerprint(r["text"]) % (1 << 64)) for r in rows})
    assert simhash_near_duplicates(nothing).count() == 0
    assert keep_one(nothing).count() == 0


def test_many_close_fingerprints(spark):
    """A group in which everything is near everything stays one group, without its pairs."""
    from targetlens.llm.common import Scratch
    from targetlens.llm.simhash_dedup import close_links

    center = 0x0F0F_1234_5678_9ABC
    prints = {center} | {center ^ (1 << a) ^ (1 << b) for a in range(40) for b in range(a)}
    links = close_links(spark.createDataFrame([(p, 1) for p in prints], "fp long, weight long"), Scratch(spark)).collect()
    groups = Groups()
    for r in links:
        assert bin((r["a"] ^ r["b"]) % (1 << 64)).count("1") <= 3
        groups.join(r["a"], r["b"])
    expected = Groups()
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 3:
                expected.join(a, b)
    assert {groups.find(p) for p in prints} == {expected.find(p) for p in prints}


def slow_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def slow_similar(a, b):
    a, b = a.split(), b.split()
    return slow_distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9)


def expected_lines(rows):
    """(id, text, n_lines, n_kept) of the rows after line dedup, by union-find over all pairs."""
    texts = sorted({(i is None, i or 0, i, t or "") for i, t in rows}, key=lambda r: (*r[:2], hash_of(r[3])))
    places = [(no, i or 0, hash_of(t), k, normalised(x), i, t) for no, _, i, t in texts for k, x in enumerate(t.split("\n")) if x and not x.isspace()]
    names = sorted({p[4] for p in places})
    prints = np.array([line_fingerprints([line_words(n)])[0] for n in names], dtype=np.int64).view(np.uint64)
    groups = Groups()
    for a in range(len(names)):
        for b in np.flatnonzero(np.bitwise_count(prints[a + 1:] ^ prints[a]) <= 3) + a + 1:
            if slow_similar(names[a], names[b]):
                groups.join(names[a], names[b])
    first = {}
    for p in sorted(places):
        first.setdefault(groups.find(p[4]), p[:4])
    kept = {p[:4] for p in places if first[groups.find(p[4])] == p[:4]}
    out = Counter()
    for i, t in rows:
        key = (i is None, i or 0, hash_of(t or ""))
        lines = (t or "").split("\n")
        real = [k for k, x in enumerate(lines) if x and not x.isspace()]
        stay = [k for k in range(len(lines)) if k not in real or (*key, k) in kept]
        text = None if t is None else "\n".join(lines[k] for k in stay)
        out[(i, text, len(real), sum((*key, k) in kept for k in real))] += 1
    return out


def hash_of(text):
    value = xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def test_line_dedup(documents, messy, nothing):
    few = documents.where("n_chars < 1500")
    for docs in (few, messy):
        rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        got = dedup_lines(docs)
        assert Counter((r["doc_id"], r["text"], r["_n_lines"], r["_n_kept"]) for r in got.collect()) == expected_lines(rows)
        assert got.columns == [*docs.columns, "_n_lines", "_n_kept"]
    assert dedup_lines(nothing).count() == 0


def test_line_fingerprints():
    rng = np.random.default_rng(8)
    lines = [["word"], ["a", "bb", "a"], [f"w{x}" for x in rng.integers(0, 50, 300)], ["x" * 70000, "y", "z"], ["é" * 300] * 300]
    for got, words in zip(line_fingerprints(lines), lines):
        want = sum(1 << b for b in range(64) if 2 * sum(len(w) for w in words if xxh64_intdigest(w) >> b & 1) > sum(map(len, words)))
        assert int(got) % (1 << 64) == want


def test_edit_distance():
    rng = np.random.default_rng(2)
    for size in (0, 1, 2, 5, 30, 90):
        for change in (0, 0.05, 0.15, 0.19, 0.21, 0.3, 0.9):
            a = [str(x) for x in rng.integers(0, 6, size)]
            b = [x if rng.random() > change else "z" for x in a] + ["y"] * int(size * change / 4)
            rng.random() < 0.3 and b and b.pop(rng.integers(0, len(b)))
            assert edit_distance(a, b) == slow_distance(a, b) == edit_distance(b, a)
            assert similar_words(" ".join(a), " ".join(b)) == slow_similar(" ".join(a), " ".join(b))


def passages(rows, least=50):
    """(id, line, kept id, kept) by union-find over all similar pairs."""
    found, names = [], {}
    for i, t in sorted(set(rows)):
        place = 0
        for k, line in enumerate((t or "").split("\n")):
            words = tuple(line.lower().split())
            if words:
                found.append((i, k, place, words))
                names.setdefault(words, frozenset(words[j:j + 5] for j in range(max(1, len(words) - 4))))
                place += 1
    owners = defaultdict(list)
    for words, shingles in names.items():
        for s in shingles:
            owners[s].append(words)
    groups = Groups()
    for words, shingles in names.items():
        common = Counter(o for s in shingles for o in owners[s])
        for other, n in common.items():
            if n / (len(shingles) + len(names[other]) - n) >= 0.8:
                groups.join(words, other)
    classes = defaultdict(list)
    for p in found:
        classes[groups.find(p[3])].append(p)
    shared = {(p[0], p[2]): (p, min(ps)[:2]) for ps in classes.values() if len({p[0] for p in ps}) > 1 for p in ps}
    out = set()
    for (i, place), (p, head) in shared.items():
        low = high = place
        while (i, low - 1) in shared:
            low -= 1
        while (i, high + 1) in shared:
            high += 1
        if sum(len(shared[i, q][0][3]) for q in range(low, high + 1)) >= least:
            out.add((i, p[1], head[0], p[:2] == head))
    return out


def test_passages(spark, documents, texts, messy, nothing):
    got = {(r["_id"], r["line"], r["kept_id"], r["kept"]) for r in repeated_passages(documents).collect()}
    assert got == passages(list(texts.items()))
    assert {r["_id"] for r in repeated_passages(messy, min_words=20).collect()} >= {1, 2, 7, 9}
    assert remove_passages(messy).columns == messy.columns and remove_passages(messy).count() == messy.count()
    assert repeated_passages(nothing).count() == 0


def test_planted_passages(spark):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 6))
    prose = lambda n: " ".join(word() for _ in range(n))
    passage, near = prose(60), None
    near = " ".join("changed" if k == 30 else w for k, w in enumerate(passage.split()))
    rows = [(i, f"{prose(30)}\n{passage if i % 2 else near}\n{prose(40)}") for i in range(12)]
    rows += [(100 + i, f"{prose(80)}\nshort shared line\n{prose(60)}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = repeated_passages(docs).collect()
    assert {r["_id"] for r in found} == set(range(12)) and {r["line"] for r in found} == {1}
    assert len({r["class_id"] for r in found}) == 1 and sum(r["kept"] for r in found) == 1
    assert {r["doc_id"] for r in remove_passages(docs).collect() if near in r["text"] or passage in r["text"]} == {0}


def test_bands_reach_the_recall():
    assert BANDS == tuned_bands(0.8, 4, 0.99)
    assert 1 - (1 - 0.8 ** 4) ** BANDS >= 0.99 > 1 - (1 - 0.8 ** 4) ** (BANDS - 1)


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    rows = out.collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) > 0
    assert all(r["round_trip"] and r["n_pieces"] == len(r["piece_ids"]) for r in rows)


def test_stages_on_messy_rows(spark, messy, nothing):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (messy, nothing):
            out = stage(spark, docs, "/root/testdata/sf0.001")
            assert out.count() <= docs.count()
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns


def test_hash_helper_is_the_row_hash(spark):
    from pyspark.sql import functions as F

    text = "é text"
    assert spark.range(1).select(F.xxhash64(F.lit(text))).first()[0] == hash_of(text)
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def test_near_copies_of_one_passage(spark, monkeypatch):
    """Many edited copies: classes as by union-find, also when buckets are compared piece by piece."""
    from targetlens.llm import linking

    monkeypatch.setattr(linking, "PIECE", 16)
    rng = np.random.default_rng(11)
    words = ["".join(rng.choice(list("abcdefghij"), 6)) for _ in range(70)]
    rows = []
    for i in range(150):
        copy = list(words)
        for k in rng.choice(70, rng.integers(0, 4), replace=False):
            copy[k] = f"edit{rng.integers(0, 40)}"
        rows.append((i, "head line\n" + " ".join(copy)))
    found = repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = defaultdict(set)
    for r in found:
        got[r["class_id"]].add((r["_id"], r["line"]))
    expected = defaultdict(set)
    for i, line, head, _ in passages(rows):
        expected[head, line].add((i, line))
    found_pairs = {frozenset(v) for v in got.values()}
    wanted = {frozenset(v) for v in expected.values()}
    missed = sum(len(w) for w in wanted - found_pairs)
    assert missed <= 0.05 * sum(map(len, wanted))  # the bands' recall
