"""64-bit fingerprints of bytes, words and word shingles, vectorised over whole blocks of text.

A block's fingerprints come from one running sum: with random 64-bit values T of the bytes and an odd base B,
S[i] = sum of T[byte j] * B^j over j < i (modulo 2^64), so (S[e] - S[s]) * B^-s depends on bytes s..e-1 alone.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 3
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of SplitMix64)."""
    x = np.asarray(x, _U) + _U((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Values of the bytes in two independent fingerprints.
_SYMBOLS = mix(np.arange(256), 77), mix(np.arange(256), 78)
#: Words are hashed in stretches of about so many bytes, so that a long text takes no more memory than a short one.
STRETCH = 1 << 18


def _to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n at least."""
    if len(_powers[0]) < n:
        n = 1 << (n - 1).bit_length()
        for k, b in enumerate((_BASE, _INVERSE)):
            out = np.ones(n, _U)
            done = 1
            while done < n:
                out[done : 2 * done] = out[:done] * _U(pow(b, done, 1 << 64))
                done *= 2
            _powers[k] = out
    return _powers[0], _powers[1]


def running(data: np.ndarray, second: bool = False) -> np.ndarray:
    """S for a block of bytes, or of words given by their hashes (length + 1); second: of the other fingerprint."""
    out = np.zeros(len(data) + 1, _U)
    if data.dtype == _U:
        values = mix(data, 78) if second else data
    else:
        values = _SYMBOLS[second][data]
    np.cumsum(values * _to(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the byte ranges [start, end) of the block that `sums` runs over."""
    return mix((sums[end] - sums[start]) * _to(len(sums))[1][start]) + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93)


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (exclusive) of the words `[^\\x20\\x09-\\x0D]+` of a block of bytes that ends with a space."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space)).view(np.int8)))
    return edge[::2], edge[1::2]


def prints(data: np.ndarray, start: np.ndarray, end: np.ndarray, second: bool = False) -> np.ndarray:
    """Fingerprints of ranges of a block of bytes, in ascending order, stretch by stretch."""
    out, a = np.empty(len(start), _U), 0
    while a < len(start):
        first = start[a]
        b = max(a + 1, int(np.searchsorted(end, first + STRETCH, side="right")))
        out[a:b] = ranges(running(data[first : end[b - 1]], second), start[a:b] - first, end[a:b] - first)
        a = b
    return out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words `[^\\x20\\x09-\\x0D]+` of many texts, one text after the other, and each text's count."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    start, end = word_places(data)
    stops = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(start, stops), prepend=0)
    return prints(data, start, end), counts


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct k-word shingles of each text (sorted within it) and each text's count.

    A text of fewer words, but at least one, has its whole word sequence as its only shingle.
    """
    words, counts = word_hashes(texts)
    padded = np.concatenate((words, np.zeros(k, _U)))
    all_k = np.zeros(len(words), _U)
    for i in range(k):
        all_k = all_k * _U(0xC2B2AE3D27D4EB4F) + mix(padded[i : i + len(words)], i)
    all_k = mix(all_k, 5)
    out, sizes, at = [], np.zeros(len(counts), np.int64), 0
    for i, n in enumerate(counts.tolist()):
        if n >= k:
            own = np.unique(all_k[at : at + n - k + 1])
        elif n:
            whole = _U(n)
            for w in words[at : at + n]:
                whole = mix(np.array([whole ^ w]), 9)[0]
            own = np.array([whole], _U)
        else:
            own = np.zeros(0, _U)
        out.append(own)
        sizes[i] = len(own)
        at += n
    return np.concatenate(out) if out else np.zeros(0, _U), sizes


def blocks(texts: list[bytes], most: int = 1 << 19):
    """Slices (first, last) of texts of about `most` bytes together; a longer text stands alone."""
    first = size = 0
    for i, t in enumerate(texts):
        if i > first and size + len(t) > most:
            yield first, i
            first, size = i, 0
        size += len(t)
    if first < len(texts):
        yield first, len(texts)
