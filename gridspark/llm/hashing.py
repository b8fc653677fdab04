"""64-bit hashes of the words of many texts at once, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    n = 1 << bits
    one = np.ones(1, np.uint64)
    return tuple(np.concatenate([one, np.cumprod(np.full(n, p, np.uint64))]) for p in (_P, _INVERSE))


def blocks(texts: list, most: int = 1 << 18):
    """Ranges of texts that hold about ``most`` characters each; a longer text is a range of its own."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of the texts, A-Z in lower case, one after the other, and where each text's words start
    (one entry more than texts). Words are separated by [\\x20\\x09-\\x0D]; null texts have none."""
    raw = [(t or "").encode("utf-8", "replace") for t in texts]
    data = np.frombuffer((b" " + b" ".join(raw) + b" ").lower(), dtype=np.uint8)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    up, down = _powers(max(19, int(len(data)).bit_length()))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)])])
    hashes = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
    first = np.cumsum([1, *[len(r) + 1 for r in raw]])
    return hashes, np.searchsorted(start, first)
