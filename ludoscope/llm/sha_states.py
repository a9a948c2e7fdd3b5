"""SHA-256 (FIPS 180-4) with its inner state in the open, for many messages at once in numpy.

A digest as hex text is 64 bytes, which is one block. So the state before a node's k-th child is what k blocks left behind:
eight words that can be kept, stored and resumed. hashlib's copies can neither be stored nor sent to another task.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

#: Messages worked on at a time: their words stay in the processor's cache.
LANES = 8192


def _primes(n: int) -> list[int]:
    found: list[int] = []
    k = 2
    while len(found) < n:
        if all(k % p for p in found):
            found.append(k)
        k += 1
    return found


def _cube_root(n: int) -> int:
    x = 1 << -(-n.bit_length() // 3)
    while (y := (2 * x + n // (x * x)) // 3) < x:
        x = y
    return x


# The first 32 bits of the fractions of square and cube roots of primes, as the standard defines them.
_FIRST = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], dtype=np.uint32)
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], dtype=np.uint32)
_HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


def fresh(n: int) -> np.ndarray:
    """The state before any block, for n messages: an array of n rows of eight words."""
    return np.tile(_FIRST, (n, 1))


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint32(bits)) | (x << np.uint32(32 - bits))


def _compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    w = [block[:, i].copy() for i in range(16)]
    for t in range(16, 64):
        x, y = w[t - 15], w[t - 2]
        w.append(w[t - 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3))) + w[t - 7]
                 + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
    a, b, c, d, e, f, g, h = (state[:, i].copy() for i in range(8))
    for t in range(64):
        one = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[t] + w[t]
        two = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return state + np.stack([a, b, c, d, e, f, g, h], axis=1)


def absorb(state: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The states after one more child each: ``digests`` are rows of 32 bytes, taken in as 64 hex characters."""
    out = np.empty_like(state)
    for at in range(0, len(state), LANES):
        part = digests[at : at + LANES]
        text = np.empty((len(part), 64), dtype=np.uint8)
        text[:, 0::2], text[:, 1::2] = _HEX[part >> 4], _HEX[part & 15]
        out[at : at + LANES] = _compress(state[at : at + LANES], text.view(">u4").astype(np.uint32))
    return out


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """The digests, as rows of 32 bytes, of messages of so many whole blocks that left these states."""
    out = np.empty((len(state), 32), dtype=np.uint8)
    for at in range(0, len(state), LANES):
        part = state[at : at + LANES]
        last = np.zeros((len(part), 16), dtype=np.uint32)
        bits = np.asarray(blocks[at : at + LANES], dtype=np.uint64) * np.uint64(512)
        last[:, 0] = 0x80000000
        last[:, 14], last[:, 15] = bits >> np.uint64(32), bits & np.uint64(0xFFFFFFFF)
        out[at : at + LANES] = np.ascontiguousarray(_compress(part, last).astype(">u4")).view(np.uint8)
    return out
