"""Periodic runs against a search of every start and period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from targetlens.llm.periodic_runs import periodic_runs, planted, run_digest, runs_of, synchronising_set


def plain_runs(words, exponent=4):
    """(start, end, period) by comparing the words with themselves for every period."""
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            block = words[start:start + q]
            primitive = not any(q % p == 0 and block == block[:p] * (q // p) for p in range(1, q))
            if end - start >= exponent * q and primitive:
                out.append((start, end, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def samples():
    rng = random.Random(5)
    yield []
    yield [7]
    yield [1] * 300
    yield [1, 2] * 40 + [1] * 9 + [2, 1] * 20
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 500:
        fib.append(fib[-1] + fib[-2])
    yield fib[-1]
    yield [bin(i).count("1") % 2 for i in range(700)]  # Thue-Morse: no cubes
    for letters in (1, 2, 3, 8, 1000):
        for _ in range(25):
            words = []
            while len(words) < rng.randint(20, 500):
                block = [rng.randrange(letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 64, 70]))]
                words += (block * 9)[:int(len(block) * rng.choice([1, 1, 2, 3.4, 4, 4.2, 5, 8.5]))]
                if rng.random() < 0.3:  # periodic blocks inside a period
                    words += (words[-rng.randint(1, 120):] * 5)[:rng.randint(0, 500)]
            yield words


def test_runs_equal_a_plain_search():
    found = 0
    for words in samples():
        expected = plain_runs(words)
        found += len(expected)
        assert runs_of(np.array(words, dtype=np.int64)) == expected
    assert found > 500


def test_synchronising_set_is_consistent_and_dense():
    rng = np.random.default_rng(3)
    words = np.concatenate([rng.integers(0, 4, 400), np.tile(rng.integers(0, 4, 37), 9), rng.integers(0, 4, 100)]).astype(np.uint64)
    t = 8
    blocks = np.array([hash(tuple(words[i:i + t])) & (2**63 - 1) for i in range(len(words) - t + 1)], dtype=np.uint64)
    chosen = set(synchronising_set(blocks, np.zeros(len(blocks), dtype=bool), t).tolist())
    by_context = {}
    for i in range(len(words) - 2 * t + 1):
        by_context.setdefault(tuple(words[i:i + 2 * t]), set()).add(i in chosen)
    assert all(len(v) == 1 for v in by_context.values())
    assert all(chosen & set(range(i, i + t)) for i in range(len(words) - 3 * t + 2))


def plain_digest(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = [(s, e - s, q) for s, e, q in plain_runs(words) if e - s >= max(6, 4 * q)]
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(left))


def digests(df):
    return sorted((tuple(r) for r in run_digest(df).collect()), key=repr)


def test_digest_of_documents(documents):
    docs = documents.where(F.length("text") < 8000)
    expected = sorted((plain_digest(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    assert digests(docs) == expected
    assert sum(r[1] > 0 for r in expected) >= 5


def test_digest_of_messy_rows(messy, nothing):
    docs = messy.where("text IS NULL OR length(text) < 60000")
    assert digests(docs) == sorted((plain_digest(r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
    long = digests(messy.where("length(text) > 60000"))
    assert [r[:6] for r in long] == [(6, 1, 0, 30000, 1, 30_000_000)] if zlib.crc32(b"6") % 10 else len(long) == 1
    assert digests(nothing) == []


def test_runs_and_collapsed_text(spark):
    text = "a b a b a b a b c\x1cd " + "x y z " * 4 + "x q"
    docs = spark.createDataFrame([("k", text), (None, None)], "name string, text string")
    rows = {r["_id"]: (r["collapsed"], [tuple(x) for x in r["runs"]]) for r in periodic_runs(docs, "name").collect()}
    assert rows == {"k": ("a b c\x1cd x y z q", [(0, 8, 2), (9, 13, 3)]), None: ("", [])}


@pytest.mark.parametrize("doc_id", [None, 3])
def test_planting_needs_an_id_and_words(doc_id):
    assert planted(doc_id, []) == []
    assert planted(None, [b"a"]) == [b"a"]
