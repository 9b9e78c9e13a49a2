"""Hashes of words and word sequences of whole texts, in numpy."""

from __future__ import annotations

import numpy as np

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BYTES = np.random.default_rng(20).integers(0, 1 << 64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grown(size: int) -> list[np.ndarray]:
    if len(_powers[0]) < size:
        size = 1 << (size - 1).bit_length()
        for i, base in enumerate((_BASE, _BACK)):
            x = np.full(size, base)
            x[0] = 1
            _powers[i] = np.cumprod(x)
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over the whole number."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xCA5A826395121157)
    return x ^ (x >> np.uint64(32))


def word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash for each word ``[^\\x20\\x09-\\x0D]+`` of ``text``."""
    data = np.frombuffer(text, np.uint8)
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_BLANK[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers, back = _grown(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def runs(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of each ``size`` consecutive words; each seed has a multiplier of its own.

    So words that collide under one seed do not for that reason collide under another.
    """
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    step = mixed(np.array([seed], np.uint64)) | np.uint64(1) if seed else _STEP
    found = np.full(n, seed, np.uint64)
    for i in range(size):
        found *= step
        found += words[i : i + n]
    return mixed(found)


def stretches(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, kinds) -> np.ndarray:
    """Hash of the words from each start to before each end, and of the stretch's kind."""
    powers, back = _grown(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * powers[: len(words)], out=sums[1:])
    return mixed(
        (sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _STEP
        + np.asarray(kinds, np.uint64) * _BASE
    )


def hash_words(data: np.ndarray, inside: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of ``data``, whose bytes are those ``inside``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edges[::2], edges[1::2]
    values = np.random.default_rng((21, seed)).integers(0, 1 << 64, 256, np.uint64)
    powers, back = _grown(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values[data] * powers[: len(data)], out=sums[1:])
    return starts, mixed(
        (sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))
