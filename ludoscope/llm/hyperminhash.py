"""HyperMinHash sketches of shingle sets: leading-zero counts and mantissa bits per bucket, in numpy.

A shingle's hash is dealt to one of ``BUCKETS`` buckets, and a bucket keeps its smallest hash. Buckets that stay empty are
filled in further rounds: each round deals all shingles anew, and after ``SPREAD_ROUNDS`` rounds every shingle is offered
to each bucket left, so that a small set has full sketches too and equal places agree with the sets' Jaccard
similarity. A register is the round, the number of leading zeros of the kept hash and the ``MANTISSA`` bits after them.
"""

from __future__ import annotations

import numpy as np

from ludoscope.llm.words import mix

BUCKETS, BANDS = 120, 24
ROWS = BUCKETS // BANDS
MANTISSA = 10
SPREAD_ROUNDS = 8
_ROUND = 0x9E3779B97F4A7C15
_FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def registers(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of BUCKETS registers (uint16) per non-empty set ``values[bounds[i]:bounds[i+1]]``."""
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    best = np.full((n, BUCKETS), _FULL, dtype=np.uint64)
    turn = np.zeros((n, BUCKETS), dtype=np.uint16)
    open_ = np.arange(n)
    owner = np.repeat(open_, sizes)
    items = values
    for r in range(SPREAD_ROUNDS):
        if not len(open_):
            break
        h = mix(items + np.uint64((r + 1) * _ROUND & 0xFFFFFFFFFFFFFFFF))
        place = ((h >> np.uint64(40)) * np.uint64(BUCKETS)) >> np.uint64(24)
        fresh = best[open_] == _FULL
        got = np.full((n, BUCKETS), _FULL, dtype=np.uint64) if r == 0 else np.full((len(open_), BUCKETS), _FULL, dtype=np.uint64)
        at = np.searchsorted(open_, owner) if r else owner
        np.minimum.at(got.ravel(), at * BUCKETS + place.astype(np.int64), mix(h ^ np.uint64(_ROUND)))
        take = fresh & (got != _FULL)
        rows = best[open_]
        rows[take] = got[take]
        best[open_] = rows
        turns = turn[open_]
        turns[take] = r
        turn[open_] = turns
        left = open_[(best[open_] == _FULL).any(axis=1)]
        keep = np.isin(owner, left)
        owner, items, open_ = owner[keep], items[keep], left
    for i in open_:
        own = values[bounds[i] : bounds[i + 1]]
        for b in np.flatnonzero(best[i] == _FULL):
            best[i, b] = mix(own + np.uint64((SPREAD_ROUNDS + 1 + int(b)) * _ROUND & 0xFFFFFFFFFFFFFFFF)).min()
            turn[i, b] = SPREAD_ROUNDS
    # frexp's exponent is floor(log2) + 1 up to rounding at powers of two; shifting by it finds the first set bit.
    top = np.frexp((best >> np.uint64(11)).astype(np.float64))[1].astype(np.int64)
    zeros = np.minimum(53 - top, 31)
    tail = (best << (zeros + 1).astype(np.uint64)) >> np.uint64(64 - MANTISSA)
    # Round (0 to SPREAD_ROUNDS) and zeros share six bits; both are small together only where sets are large.
    head = (zeros.astype(np.uint64) + turn.astype(np.uint64) * np.uint64(7)) & np.uint64(63)
    return ((head << np.uint64(MANTISSA)) | tail).astype(np.uint16)


def bands(regs: np.ndarray) -> np.ndarray:
    """One key per band: a hash of the band's number and its registers."""
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(_ROUND), (len(regs), BANDS)).copy()
    parts = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    for k in range(ROWS):
        key = mix(key ^ (parts[:, :, k] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from equal registers, less those that agree by chance.

    Two independent registers with the same head agree in the mantissa once in 2**MANTISSA, and heads agree in at most
    about a third of the places, so the expected share of chance agreements is ``c``; J = (share - c) / (1 - c).
    """
    share = (a == b).mean(axis=-1)
    c = (1.0 / 3.0) / (1 << MANTISSA)
    return np.clip((share - c) / (1.0 - c), 0.0, 1.0)
