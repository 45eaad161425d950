"""Edit distances of many pairs at once, and links that are confirmed many at a time."""

import numpy as np

from targetlens.llm.edit_distances import edit_distances
from targetlens.llm.linking import Forest
from targetlens.llm.line_dedup import similar_normal, similar_pairs
from test_duplicates import Groups, slow_distance


def made_pairs(rng):
    for size in (0, 1, 2, 63, 64, 65, 130, 200):
        for change in (0, 0.1, 0.3, 1):
            for letters in ("ab", "abcdefgh ", "aé日😀z"):
                x = "".join(rng.choice(list(letters), size))
                y = "".join(c if rng.random() > change else rng.choice(list(letters)) for c in x)
                cut = int(size * rng.random() * change)
                yield x, y[cut:] + y[:cut // 2]


def test_distances():
    a, b = zip(*made_pairs(np.random.default_rng(3)))
    want = np.array([slow_distance(x, y) for x, y in zip(a, b)])
    assert (edit_distances(a, b) == want).all() and (edit_distances(b, a) == want).all()
    for share in (0, 0.05, 0.2, 0.6):
        most = np.array([int(share * max(len(x), len(y))) for x, y in zip(a, b)])
        got = edit_distances(a, b, most)
        assert (np.where(want <= most, got == want, got > most)).all()
    assert (similar_pairs(similar_normal)(a, b) == [similar_normal(x, y) for x, y in zip(a, b)]).all()
    assert edit_distances([], []).tolist() == []


def test_forest_connects_as_all_pairs_do():
    """Few calls confirm many pairs, no pair twice, and copies need few of their pairs."""
    rng = np.random.default_rng(5)
    value = np.concatenate([rng.integers(0, 40, 300), np.full(200, 77)])
    asked, calls = [], 0

    def confirm(a, b):
        nonlocal calls
        calls += 1
        asked.extend(zip(a.tolist(), b.tolist()))
        return value[a] == value[b]

    forest = Forest(len(value), confirm)
    for _ in range(2):
        a, b = np.nonzero(np.ones((len(value), len(value)), dtype=bool))
        forest.offer(a[a != b], b[a != b])
        forest.settle()
    groups = Groups()
    for link in np.concatenate(forest.links).tolist():
        groups.join(*divmod(link, len(value)))
    roots = [groups.find(i) for i in range(len(value))]
    assert all((roots[i] == roots[j]) == (value[i] == value[j]) for i in range(500) for j in range(500))
    assert len(asked) == len(set(asked)) and calls < 40
    assert sum(value[i] == value[j] for i, j in asked) < 6 * len(value)
