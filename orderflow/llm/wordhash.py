"""Words of a text as 64-bit numbers, many at a time."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240501))
#: A random number for each byte, and an odd factor for each place in a word.
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 3
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SLICE = 1 << 17


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    out[1:] = np.uint64(base)
    return np.multiply.accumulate(out, dtype=np.uint64)


_UP = _powers(2 * _SLICE, _BASE)
_DOWN = _powers(2 * _SLICE, pow(_BASE, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _slice_hashes(data: np.ndarray) -> np.ndarray:
    space = _IS_SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(data)
    up, down = (_UP, _DOWN) if n <= len(_UP) else (_powers(n, _BASE), _powers(n, pow(_BASE, -1, 1 << 64)))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: bytes) -> np.ndarray:
    """A number for each word of an UTF-8 text; words are parted by ``[\\x20\\x09-\\x0D]+``.

    Long texts go in slices that end at a space.
    """
    array = np.frombuffer(data, np.uint8)
    if len(array) <= 2 * _SLICE:
        return _slice_hashes(array)
    out, begin = [], 0
    while begin < len(array):
        end = min(begin + _SLICE, len(array))
        while end < len(array):
            gaps = np.flatnonzero(_IS_SPACE[array[end : end + _SLICE]])
            if len(gaps):
                end += int(gaps[0])
                break
            end = min(end + _SLICE, len(array))
        out.append(_slice_hashes(array[begin:end]))
        begin = end
    return np.concatenate(out)


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` words, by doubling."""
    if len(words) < size:
        return np.zeros(0, np.uint64)
    done, out, block, length = 0, None, words, 1
    while True:
        if size & length:
            n = len(words) - (done + length) + 1
            part = block[done : done + n]
            out = part if out is None else mix(out[:n] * np.uint64(0xD6E8FEB86659FD93) + part)
            done += length
        length *= 2
        if length > size:
            return out
        half = length // 2
        block = mix(block[: len(block) - half] * np.uint64(0xA24BAED4963EE407) + block[half:])
