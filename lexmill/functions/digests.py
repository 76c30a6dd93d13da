"""md5 digests of many short texts at once, step by step over arrays: a call per digest costs more than the digest.

The results are those of ``hashlib``; texts that need more than one block of 64 bytes are left to it.
"""

from __future__ import annotations

import hashlib

import numpy as np

BLOCK = 64
#: Longest text that fits a block with its end mark and length.
LONGEST = 55
#: Texts worked on together, so that their arrays stay in the cache.
_TOGETHER = 1 << 14

# Fixed values of md5.
_TURNS = ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21))
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint32)
_START = np.array([0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476], np.uint32)
_HEX = np.frombuffer(b"".join(b"%02x" % i for i in range(256)), np.uint8).reshape(256, 2)


def _md5(texts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Digests, 16 bytes a row, of rows of 64 bytes that hold a text of ``length`` bytes and zeros. The rows are written to."""
    n = len(texts)
    texts[np.arange(n), length] = 0x80
    words = texts.view("<u4")
    words[:, 14] = length * 8
    words = np.ascontiguousarray(words.T, np.uint32)
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, high = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        turn = i >> 4
        if turn == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
            word = i
        elif turn == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
            word = (5 * i + 1) & 15
        elif turn == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
            word = (3 * i + 5) & 15
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
            word = (7 * i) & 15
        f += a
        f += words[word]
        f += _SINES[i]
        shift = _TURNS[turn][i & 3]
        np.right_shift(f, np.uint32(32 - shift), out=high)
        f <<= np.uint32(shift)
        f |= high
        f += b
        a, d, c, b, f = d, c, b, f, a
    state = np.stack([a, b, c, d], axis=1) + _START
    return np.ascontiguousarray(state, "<u4").view(np.uint8)


def md5_numbered(prefixes: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Digests, 16 bytes a row, of every prefix followed by each number from 0 below its count in decimal digits."""
    total = int(counts.sum())
    out = np.empty((total, 16), np.uint8)
    if not total:
        return out
    owner = np.repeat(np.arange(len(prefixes)), counts)
    number = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    size = np.array([len(p) for p in prefixes])
    most_digits = len(str(int(counts.max()) - 1))
    if int(size.max()) + most_digits > LONGEST:
        joined = b"".join([hashlib.md5(b"%s%d" % (prefixes[p], n)).digest() for p, n in zip(owner.tolist(), number.tolist())])
        return np.frombuffer(joined, np.uint8).reshape(-1, 16)
    rows = np.frombuffer(b"".join([p.ljust(BLOCK, b"\0") for p in prefixes]), np.uint8).reshape(-1, BLOCK)
    for low in range(0, total, _TOGETHER):
        own, left = owner[low : low + _TOGETHER], number[low : low + _TOGETHER]
        texts, end = rows[own], size[own]
        at = np.arange(len(own))
        for power in range(most_digits - 1, -1, -1):
            has = at if power == 0 else np.flatnonzero(left >= 10**power)
            texts[has, end[has]] = 0x30 + left[has] // 10**power % 10
            end[has] += 1
        out[low : low + _TOGETHER] = _md5(texts, end)
    return out


def md5_of_hex(digests: np.ndarray, digit: np.ndarray) -> np.ndarray:
    """Digests of the hex digits of each digest followed by ``:`` and one decimal digit."""
    out = np.empty((len(digests), 16), np.uint8)
    for low in range(0, len(digests), _TOGETHER):
        part = digests[low : low + _TOGETHER]
        texts = np.zeros((len(part), BLOCK), np.uint8)
        texts[:, :32] = _HEX[part].reshape(len(part), 32)
        texts[:, 32] = 0x3A
        texts[:, 33] = 0x30 + digit[low : low + _TOGETHER]
        out[low : low + _TOGETHER] = _md5(texts, np.full(len(part), 34))
    return out
