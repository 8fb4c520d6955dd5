"""Words, shingles and window hashes of byte strings, by numpy over whole buffers."""

from __future__ import annotations

import functools

import numpy as np

#: Multiplier of the polynomial hash (odd, so that it has an inverse modulo 2**64).
BASE = np.uint64(0x9E3779B97F4A7C15)
_MASK = (1 << 64) - 1

#: Separators to a space, A-Z to a-z; all else, bytes above 0x7F too, stays.
_WORDS = bytes(
    0x20 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)
)


def word_bytes(data: bytes) -> list[bytes]:
    """Lower-cased words of letters, digits and all code points above ASCII."""
    return data.translate(_WORDS).split()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(int(BASE), -1, 1 << 64)
    out = []
    for base in (int(BASE), inverse):
        p = np.ones(n, np.uint64)
        done = 1
        while done < n:
            step = min(done, n - done)
            p[done : done + step] = p[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
        out.append(p)
    return out[0], out[1]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n at least, in tables of doubling size."""
    return _powers(1 << max(16, int(n).bit_length()))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] = the sum of (byte + 1) * BASE**position over i <= position < j."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], alike wherever the bytes stand."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start])


#: Words of a text hashed at a time; longer texts go in overlapping parts.
PART_WORDS = 200_000


def shingles(words: list[bytes], width: int = 5) -> np.ndarray:
    """Hashes of all windows of ``width`` words in text order; a text of fewer words, but not
    none, is one window."""
    if not words:
        return np.zeros(0, np.uint64)
    k = min(width, len(words))
    out = []
    for at in range(0, len(words) - k + 1, PART_WORDS):
        part = words[at : at + PART_WORDS + k - 1]
        size = np.fromiter(map(len, part), np.int64, len(part))
        end = np.cumsum(size + 1) - 1
        start = end - size
        p = prefix_hash(np.frombuffer(b" ".join(part), np.uint8))
        out.append(spans_hash(p, start[: len(part) - k + 1], end[k - 1 :]))
    return np.concatenate(out)


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Occurrence-labelled: the n-th occurrence of a value becomes a value of its own."""
    if len(hashes) < 2:
        return hashes
    order = np.argsort(hashes, kind="stable")
    s = hashes[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return hashes
    run = np.flatnonzero(np.concatenate(([True], ~same)))
    count = np.arange(len(s)) - np.repeat(run, np.diff(np.append(run, len(s))))
    out = hashes.copy()
    out[order] = np.where(count > 0, mix(s + count.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)), s)
    return out
