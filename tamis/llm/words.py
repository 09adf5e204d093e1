"""Vectorised word hashes and shingle sets of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_M = np.uint64(0xFFFFFFFFFFFFFFFF)
_rng = np.random.default_rng(7)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
#: The separators of words: space, and 0x09 to 0x0D.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
_BYTE[list(SPACES)] = 0
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 1 << 63, 5, dtype=np.uint64) | np.uint64(1)
_powers = np.ones(1, np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    global _powers
    while len(_powers) < n:
        _powers = np.concatenate([_powers, _powers * (_powers[-1:] * _BASE)])
    return _powers


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, length) of every maximal run of bytes that are no separators."""
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1), append=np.int8(1)))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start, start
    size = end - start
    place = np.arange(len(data)) - np.repeat(start, np.diff(start, append=len(data))) if start[0] == 0 else np.concatenate([np.zeros(start[0], np.int64), np.arange(start[0], len(data)) - np.repeat(start, np.diff(start, append=len(data)))])
    # separators after a word hold no value, so any power will do for them
    h = np.add.reduceat(_BYTE[data] * powers(int(size.max()) + 1)[np.minimum(place, size.max())], start)
    return mix(h + size.astype(np.uint64)), start, size


def texts_in_blocks(texts: list[str | None], block: int = 1 << 17) -> Iterator[tuple[int, int, bytes, np.ndarray]]:
    """(first, last + 1, bytes, text starts) of runs of texts of about `block` bytes, in UTF-8, A-Z in lower case, each followed by a newline."""
    a, size, parts = 0, 0, []
    for k, t in enumerate(texts):
        parts.append((t or "").encode("utf-8", "surrogatepass").lower() + b"\n")
        size += len(parts[-1])
        if size >= block or k == len(texts) - 1:
            yield a, k + 1, b"".join(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            a, size, parts = k + 1, 0, []


def shingle_sets(texts: list[str | None], width: int = 5) -> Iterator[np.ndarray]:
    """For each text its sorted distinct 64-bit shingle hashes: every `width` words, or the whole sequence if it is shorter."""
    place = np.resize(_PLACE, width) * powers(width)[:width]
    for _, _, data, at in texts_in_blocks(texts):
        h, start, _ = word_hashes(np.frombuffer(data, np.uint8))
        bound = np.searchsorted(start, at)
        n = len(h) - width + 1
        full = mix(sum((h[k : n + k] * place[k] for k in range(width)), np.zeros(max(n, 0), np.uint64))) if n > 0 else np.zeros(0, np.uint64)
        for a, b in zip(bound[:-1].tolist(), bound[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(full[a : b - width + 1])
            elif b > a:
                yield mix(np.array([(h[a:b] * place[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)], np.uint64) ^ _BASE)
            else:
                yield np.zeros(0, np.uint64)
