"""Vectorised word hashing for whole batches of texts (numpy, inside tasks).

Words are runs of bytes other than space and \\t\\n\\v\\f\\r. A word's hash is a
polynomial in its bytes, each byte first replaced by a random 64-bit value,
taken from one running sum over the batch and then mixed; n-grams combine word
hashes the same way. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INV = np.uint64(pow(int(_BASE), -1, 1 << 64))
_GRAM = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = np.ones(1, dtype=np.uint64)
_inverse = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (splitmix finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grown(table: np.ndarray, base: np.uint64, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        while len(table) < n:
            table = np.concatenate([table, table * np.uint64(pow(int(base), len(table), 1 << 64))])
    return table


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverse
    if len(_powers) < n:
        _powers, _inverse = _grown(_powers, _BASE, n), _grown(_inverse, _INV, n)
    return _powers, _inverse


def blocks(texts: list[bytes], limit: int = 1 << 20):
    """Index ranges of ``texts`` of about ``limit`` bytes each (one text at least)."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


# lower case for A-Z, a space for every other ASCII character that is no letter or digit
PLAIN = bytes(c + 32 if 65 <= c < 91 else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def word_hashes(texts: list[bytes], lower: bool = False, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """(hash of every word, first word of each text plus the total, byte start and end of every word).

    Byte offsets count in the texts joined by one newline. For each of ``prefixes``
    follow the hashes of the words' first so many bytes (0 for words that aren't longer).
    """
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    if lower:
        buf = _LOWER[buf]
    space = _SPACE[buf]
    before = np.empty_like(space)
    before[0], before[1:] = True, space[:-1]
    start, end = np.flatnonzero(before & ~space), np.flatnonzero(space & ~before)
    power, inverse = _tables(len(buf) + 1)
    with np.errstate(over="ignore"):
        run = np.empty(len(buf) + 1, dtype=np.uint64)
        run[0] = 0
        np.cumsum(_BYTE[buf] * power[: len(buf)], out=run[1:])
        words = mix((run[end] - run[start]) * inverse[start] + (end - start).astype(np.uint64))
        more = []
        for k in prefixes:
            h = mix((run[np.minimum(start + k, end)] - run[start]) * inverse[start] + np.uint64((k << 32) + 1))
            more.append(np.where(end - start > k, h, np.uint64(0)))
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return words, np.searchsorted(start, at), start, end, *more


def grams(words: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``n`` words from each position on (``len(words) - n + 1`` values, none when shorter)."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        if n <= 6:
            out = np.zeros(count, dtype=np.uint64)
            for k in range(n):
                out += words[k : k + count] * _GRAM[(k + salt) % 64]
        else:
            base = _GRAM[salt % 64]
            power, inverse = _grown(np.ones(1, np.uint64), base, len(words)), None
            inverse = _grown(np.ones(1, np.uint64), np.uint64(pow(int(base), -1, 1 << 64)), count)
            run = np.empty(len(words) + 1, dtype=np.uint64)
            run[0] = 0
            np.cumsum(words * power[: len(words)], out=run[1:])
            out = (run[n:] - run[:count]) * inverse[:count]
        return mix(out + np.uint64(n))


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the least (the first of equals) of each ``width`` consecutive values."""
    if len(x) < width:
        return np.empty(0, dtype=np.int64)
    size, at = 1, np.arange(len(x))

    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(x[a] <= x[b], a, b)

    while size * 2 <= width:
        at = lower(at[:-size], at[size:])
        size *= 2
    rest = width - size
    return lower(at[: len(at) - rest], at[rest:]) if rest else at
