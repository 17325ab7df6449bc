"""Hashed word shingles of whole texts, computed on UTF-8 buffers with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CHUNK = 1 << 20
_SEPARATORS = (9, 10, 11, 12, 13, 32)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_VALUE[65:91] = _VALUE[97:123]  # A-Z count as a-z
_IS_WORD = np.ones(256, bool)
_IS_WORD[list(_SEPARATORS)] = False
_STEP = np.uint64(0xD1342543DE82EF95)
_power = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _power
    if len(_power) < n:
        _power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(2 * n, _STEP)]), dtype=np.uint64)
    return _power


def _hash_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words in some bytes, and where each begins."""
    data = np.frombuffer(raw, np.uint8)
    inside = _IS_WORD[data]
    edge = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return np.zeros(0, np.uint64), begin
    size = end - begin
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(first, size)
    value = _VALUE[data[inside]] * _powers(int(size.max()))[place]
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64)), begin


def _parts(raw: bytes) -> Iterator[bytes]:
    """A very long text in parts, cut at separators."""
    at = 0
    while len(raw) - at > CHUNK:
        cuts = np.flatnonzero(~_IS_WORD[np.frombuffer(raw, np.uint8, CHUNK, at)])
        if not len(cuts):  # a word longer than a part
            rest = np.frombuffer(raw, np.uint8, offset=at)
            far = int(np.argmin(_IS_WORD[rest]))
            cut = far if not _IS_WORD[rest[far]] else len(rest)
        else:
            cut = int(cuts[-1]) + 1
        yield raw[at : at + cut]
        at += max(1, cut)
    yield raw[at:]


def word_hashes(texts: list[str | None]) -> Iterator[np.ndarray]:
    """The hashes of the words of each text, in order."""
    pending: list[bytes] = []

    def flush() -> Iterator[np.ndarray]:
        if pending:
            hashes, begin = _hash_words(b" ".join(pending))
            ends = np.cumsum([len(x) + 1 for x in pending])
            cut = np.searchsorted(begin, ends)
            for a, b in zip([0, *cut[:-1]], cut, strict=True):
                yield hashes[a:b]
            pending.clear()

    held = 0
    for t in texts:
        raw = (t or "").encode("utf-8", "surrogatepass")
        if len(raw) > CHUNK:
            yield from flush()
            held = 0
            yield np.concatenate([_hash_words(p)[0] for p in _parts(raw)])
            continue
        pending.append(raw)
        held += len(raw)
        if held > CHUNK:
            yield from flush()
            held = 0
    yield from flush()


def shingle_sets(texts: list[str | None], words: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingles as sorted signed 64-bit hashes; a shorter text's whole sequence is its one shingle."""
    for h in word_hashes(texts):
        n = len(h)
        if n == 0:
            yield np.zeros(0, np.int64)
            continue
        k = min(words, n)
        s = np.full(n - k + 1, np.uint64(k))
        for i in range(k):
            s = mix(s + h[i : n - k + 1 + i])
        yield np.unique(s.view(np.int64))
