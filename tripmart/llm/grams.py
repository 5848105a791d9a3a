"""Word hashes and word n-grams of blocks of texts, in numpy.

Words are what stands between bytes 20 and 09 to 0D, with A to Z in lower case.
A word's hash is a polynomial in random byte values, taken for all words of a
block from one running sum; hashes are equal for equal words in any block,
task and run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 2**64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True
_STRETCH = 1 << 19
_powers: dict[int, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h`` (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(factor: int, count: int) -> np.ndarray:
    held = _powers.get(factor)
    if held is None or len(held) < count:
        steps = np.full(max(count, _STRETCH + 1), factor, np.uint64)
        steps[0] = 1
        held = np.multiply.accumulate(steps)
        if count <= _STRETCH + 1:  # what a single longer word needs is not kept
            _powers[factor] = held
    return held[:count]


def byte_values(seed: int) -> np.ndarray:
    """Random values of bytes; A to Z have those of a to z."""
    return np.random.default_rng(seed).integers(1, 2**63, 256, np.uint64)[_LOWER]


_VALUES = byte_values(20)


def word_spans(texts: pa.Array, white: np.ndarray = _WHITE, values: np.ndarray = _VALUES) -> tuple[np.ndarray, ...]:
    """All words of binary or string ``texts``: their hashes, first and last bytes, the bytes, and where each text ends in them.

    ``white`` marks the byte values between words, ``values`` choose the hash function.  Null texts have no words.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if not len(raw):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, raw, offsets
    inside = ~white[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    begins, ends = np.flatnonzero(begins), np.flatnonzero(ends)
    hashes = np.empty(len(begins), np.uint64)
    first = 0
    while first < len(begins):
        # A stretch of whole words at a time, so that the sums stay small.
        stop = max(first + 1, int(np.searchsorted(ends, begins[first] + _STRETCH)))
        low, high = begins[first], ends[stop - 1] + 1
        running = np.cumsum(values[raw[low:high]] * _power(_FACTOR, high - low), dtype=np.uint64)
        head, tail = begins[first:stop] - low, ends[first:stop] - low
        part = running[tail]
        part[1:] -= running[head[1:] - 1]
        hashes[first:stop] = part * _power(_INVERSE, high - low)[head]
        first = stop
    hashes += (ends - begins).astype(np.uint64)
    return mixed(hashes), begins, ends, raw, offsets


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of ``texts``, and where each text's words end."""
    hashes, begins, _, _, offsets = word_spans(texts)
    return hashes, np.searchsorted(begins, offsets[1:])


def chained(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-grams that start at each place but the last ``n - 1``."""
    count = max(0, len(hashes) - n + 1)
    out = mixed(hashes[:count] + np.uint64(n))
    for i in range(1, n):
        out = mixed(out * np.uint64(_FACTOR) + hashes[i : i + count])
    return out
