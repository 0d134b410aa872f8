"""Hashes of words and byte strings for whole batches of texts at once.

A byte's value is replaced by a random 64-bit number; the hash of a string is the sum of these
numbers times ascending powers of an odd factor, so that every substring's hash follows from two
prefix sums. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

import numpy as np

#: Words are hashed in pieces of about that many bytes, which bounds the memory of a long text.
PIECE_BYTES = 1 << 20

FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(7).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)

_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """1, base, base^2, ..."""
    if len(_POWERS.get(base, ())) < count:
        steps = np.full(max(count, PIECE_BYTES), base, np.uint64)
        steps[0] = 1
        _POWERS[base] = np.cumprod(steps)
    return _POWERS[base][:count]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all (the finalizer of splitmix64)."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """``out[i]`` is the hash of the first i bytes, in the powers of their places."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(FACTOR, len(data)), out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans, the same wherever a span lies."""
    return mixed((sums[ends] - sums[starts]) * powers(INVERSE, len(sums))[starts])


def words_of(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Words of consecutive texts: (text, start, end, hash) of each.

    ``classes`` maps a byte to 0 if it separates words, else to the byte that stands for it in
    the hash. ``offsets`` are the texts' ends within ``data``; no word crosses one.
    """
    parts = []
    first = int(offsets[0])
    end = int(offsets[-1])
    while first < end:
        last = min(first + PIECE_BYTES, end)
        piece = classes[data[first:last]]
        if last < end:
            # cut behind the last separator; a longer word makes a longer piece
            gaps = np.flatnonzero(piece == 0)
            while not len(gaps) and last < end:
                last = min(last + PIECE_BYTES, end)
                piece = classes[data[first:last]]
                gaps = np.flatnonzero(piece == 0)
            if len(gaps) and last < end:
                last = first + int(gaps[-1]) + 1
                piece = piece[: last - first]
        inner = piece != 0
        breaks = offsets[(offsets >= first) & (offsets < last)] - first
        begins = inner.copy()
        begins[1:] &= ~inner[:-1]
        begins[breaks] = inner[breaks]
        stops = inner.copy()
        stops[:-1] &= ~inner[1:]
        before = breaks[breaks > 0] - 1
        stops[before] = inner[before]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        sums = prefix_sums(piece)
        parts.append((starts + first, ends + first, span_hashes(sums, starts, ends)))
        first = last
    if not parts:
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64)
    starts, ends, hashes = (np.concatenate(x) for x in zip(*parts))
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends, hashes


def run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of each run of ``size`` consecutive values."""
    n = max(len(hashes) - size + 1, 0)
    total = np.full(n, size, np.uint64)
    for k, factor in enumerate(powers(FACTOR, size + 1)[1:]):
        total += hashes[k : k + n] * factor
    return mixed(total)
