"""Edit distances of many pairs of lines at once: bit-parallel columns, 64 rows of the table to a number."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Pairs, and numbers of the table of character places, that one call of ``_together`` holds at most.
PAIRS, NUMBERS = 1024, 1 << 20
#: Blocks of all pairs of a call up to which much shorter pairs join it: they are treated as if they were as long.
FEW = 512
_ONE, _TOP, _ALL = np.uint64(1), np.uint64(63), ~np.uint64(0)


def _points(texts: Sequence[str], width: int, fill: int) -> np.ndarray:
    """Code points + 2 of each text as a row, ``fill`` behind its end."""
    out = np.full((len(texts), width), fill, dtype=np.int64)
    sizes = np.array([len(t) for t in texts])
    out[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64) + 2
    return out


def _together(short: Sequence[str], long: Sequence[str], most: int) -> np.ndarray:
    """Distances of the pairs, those over ``most`` perhaps too large; no text of ``long`` is empty or shorter than its partner.

    Both texts of a pair get the same end, which changes no distance, so that all texts of ``long`` are of one
    length. The rows of the table are those of ``short``, in blocks of 64; a block works on the column that the
    one above has left a step before, so a step treats a column of each block of each pair. A block sees the
    columns within ``most`` of its rows only: above and before them the table counts as growing by one a place,
    which holds for no smaller distance.
    """
    width, pairs = max(map(len, long)), len(short)
    sizes = np.array([len(s) + width - len(t) for s, t in zip(short, long)])
    blocks = -(-int(sizes.max()) // 64)
    down = _points(short, 64 * blocks, 1)
    down[np.arange(64 * blocks) >= sizes[:, None]] = 0  # rows that are not looked at
    across = _points(long, width, 1)
    held = np.zeros(int(max(down.max(), across.max())) + 1, dtype=bool)
    held[down] = held[across] = held[0] = True
    codes = np.cumsum(held) - 1  # 0: no character, equal to none
    letters = int(codes[-1]) + 1
    down = codes[down].reshape(pairs, blocks, 64).transpose(2, 1, 0)
    places = np.zeros(pairs * letters * blocks, dtype=np.uint64)
    own = np.arange(pairs * blocks).reshape(blocks, pairs) * letters
    for bit in range(64):
        places[own + down[bit]] |= _ONE << np.uint64(bit)
    places[own] = 0
    # the texts backwards, as block b is at column t - b in step t
    back = np.zeros((width + 2 * blocks, pairs), dtype=np.int64)
    back[blocks:blocks + width] = codes[across[:, ::-1]].T
    looked = np.clip(sizes - 64 * np.arange(blocks)[:, None], 0, 64)
    mask = np.where(looked == 64, _ALL, (_ONE << np.minimum(looked, 63).astype(np.uint64)) - _ONE)
    grows, falls = np.full((blocks, pairs), _ALL), np.zeros((blocks, pairs), dtype=np.uint64)
    more, less = np.zeros((blocks + 1, pairs), dtype=np.uint64), np.zeros((blocks + 1, pairs), dtype=np.uint64)
    more[0] = 1
    at = np.empty((blocks, pairs), dtype=np.int64)
    same, upright, level, right, left = (np.empty((blocks, pairs), dtype=np.uint64) for _ in range(5))
    out = np.full(pairs, width, dtype=np.int64)
    starts = [max(0, 64 * b - most) + b for b in range(blocks)]
    ends = [min(width - 1, 64 * b + 63 + most) + b for b in range(blocks)]
    lo = hi = 0
    for step in range(ends[-1] + 1):
        while hi < blocks and starts[hi] <= step:
            hi += 1
        if ends[lo] < step:
            lo += 1
        now, first = slice(lo, hi), blocks + width - 1 - step + lo
        s, u, e, r, f, g, x, m, n = same[now], upright[now], level[now], right[now], left[now], grows[now], falls[now], more[now], less[now]
        np.add(back[first:first + hi - lo], own[now], out=at[now])
        np.take(places, at[now], out=s, mode="clip")
        np.bitwise_or(s, x, out=u)
        np.bitwise_or(s, n, out=s)
        np.bitwise_and(s, g, out=e)
        e += g
        e ^= g
        e |= s
        np.bitwise_or(e, g, out=r)
        np.invert(r, out=r)
        r |= x
        np.bitwise_and(g, e, out=f)
        # what leaves a block at its foot enters the next one in the next step
        np.right_shift(r, _TOP, out=s)
        np.right_shift(f, _TOP, out=e)
        r <<= _ONE
        r |= m
        f <<= _ONE
        f |= n
        np.bitwise_or(u, r, out=g)
        np.invert(g, out=g)
        g |= f
        np.bitwise_and(r, u, out=x)
        more[lo + 1:hi + 1], less[lo + 1:hi + 1] = s, e
        more[lo], less[lo] = 1, 0
        if step == ends[lo]:  # down this block, whose last column this was, and on along its foot
            out += np.bitwise_count(grows[lo] & mask[lo]).astype(np.int64) - np.bitwise_count(falls[lo] & mask[lo])
    return out


def edit_distances(a: Sequence[str], b: Sequence[str], most: Sequence[int] | None = None) -> np.ndarray:
    """Characters to insert, delete or replace in each pair of texts; with ``most``, more than that may come out as any larger number."""
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b)]
    long = [y if len(x) <= len(y) else x for x, y in zip(a, b)]
    limits = np.array([len(t) for t in long] if most is None else most, dtype=np.int64)
    gaps = np.array([len(t) - len(s) for s, t in zip(short, long)], dtype=np.int64)
    out = np.where(gaps > limits, gaps, 0)
    order = sorted(np.flatnonzero((gaps <= limits) & np.array([t != s for s, t in zip(short, long)], dtype=bool)).tolist(), key=lambda i: len(long[i]))
    while order:
        # pairs of like length go together, the longest first
        blocks = -(-len(long[order[-1]]) // 64)
        part = order[-max(1, min(PAIRS, NUMBERS // (blocks * 64))):]
        alike = sum(len(long[i]) * 5 >= len(long[part[-1]]) * 4 for i in part)
        part = part[-max(alike, FEW // blocks):]
        del order[-len(part):]
        out[part] = _together([short[i] for i in part], [long[i] for i in part], max(1, int(limits[part].max())))
    return out
