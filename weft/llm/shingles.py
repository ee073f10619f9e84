"""Word shingles of whole texts as sorted 64-bit hashes, many texts at a time on their bytes.

Words are runs of ASCII letters and digits, in lower case, and of bytes beyond ASCII.
"""

from __future__ import annotations

import numpy as np

WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C55)
_BACK = np.uint64(pow(0x9E3779B97F4A7C55, -1, 1 << 64))


def _word_bytes() -> np.ndarray:
    """Each byte's lower-case value, 0 for bytes that end a word."""
    kind = np.zeros(256, np.uint64)
    for lo, hi in (("0", "9"), ("a", "z")):
        kind[ord(lo) : ord(hi) + 1] = np.arange(ord(lo), ord(hi) + 1)
    kind[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    kind[128:] = np.arange(128, 256)
    return kind


KIND = _word_bytes()
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _BACK)):
            p = np.full(max(n, 1 << 16), base, np.uint64)
            p[0] = 1
            _POWERS[k] = np.multiply.accumulate(p)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words has one shingle of them, if it has any."""
    x = KIND[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    length = np.array([len(t) + 1 for t in texts])
    text_end = np.cumsum(length)
    inside = x > 0
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    forth, back = _powers(len(x) + 1)
    total = np.concatenate([[np.uint64(0)], np.cumsum(x * forth[: len(x)], dtype=np.uint64)])
    word = mix((total[end] - total[start]) * back[start] + (end - start).astype(np.uint64))
    first = np.searchsorted(start, np.concatenate([[0], text_end]))
    grams = np.zeros(max(0, len(word) - words + 1), np.uint64)
    for k in range(words):
        grams = (grams + word[k : k + len(grams)]) * _BASE
    grams = mix(grams)
    out = []
    for s, e in zip(first[:-1], first[1:], strict=True):
        if e - s >= words:
            out.append(np.unique(grams[s : e - words + 1]))
        elif e > s:
            h = np.uint64(e - s)
            with np.errstate(over="ignore"):
                for w in word[s:e]:
                    h = (h + w) * _BASE
            out.append(mix(np.array([h])))
        else:
            out.append(np.empty(0, np.uint64))
    return out
