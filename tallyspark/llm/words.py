"""Words and word shingles of a whole Arrow text column, as 64-bit hashes.

The hash of a byte range comes from prefix sums of byte * P**place modulo
2**64; words and shingles are then mixed, so equal hashes mean equal text but
for chances of about n**2 / 2**65 among n shingles.
"""

from __future__ import annotations

import numpy as np

P = np.uint64(0x9E3779B97F4A7C55)
P_INVERSE = np.uint64(pow(int(P), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """P**i and P**-i for i up to n."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((P, P_INVERSE)):
            x = np.full(n + 1, base)
            x[0] = 1
            _powers[k] = np.cumprod(x, dtype=np.uint64)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up = powers(len(data))[0]
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each text (n + 1)."""
    word = ~space[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    before[inner] = False
    after[inner - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = prefix_sums(data)
    down = powers(len(data))[1]
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int = 5, lower: bool = True) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer words than ``size`` has its whole sequence as one; a text
    without words has none.
    """
    if lower:
        data = LOWER[data]
    starts, ends, first = word_spans(data, offsets)
    h = word_hashes(data, starts, ends)
    steps = [mix(np.array([i + 1], np.uint64))[0] | np.uint64(1) for i in range(size)]
    n = len(h)
    shingle = np.zeros(max(0, n - size + 1), np.uint64)
    for i, k in enumerate(steps):
        shingle += h[i : i + len(shingle)] * k
    shingle = mix(shingle)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            s = np.sort(shingle[a : b - size + 1])
            out.append(s[np.r_[True, s[1:] != s[:-1]]])
        elif b > a:
            with np.errstate(over="ignore"):
                short = sum((h[a + i] * steps[i] for i in range(b - a)), np.uint64(b - a))
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
