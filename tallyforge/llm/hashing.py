"""64-bit hashes of numbers and of stretches of a sequence, whole arrays at a time."""

from __future__ import annotations

import numpy as np

ODD = 0x9E3779B97F4A7C15


def scramble(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit integers (the finalizer of splitmix64)."""
    x = x + np.uint64(ODD)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of ODD modulo 2**64 and of its inverse.

    With sums of symbol * power up to each place, a difference times an inverse power is the hash
    of a stretch, the same wherever the stretch lies.
    """
    made = []
    for base in (ODD, pow(ODD, -1, 1 << 64)):
        steps = np.full(count, np.uint64(base))
        steps[0] = 1
        made.append(np.cumprod(steps, dtype=np.uint64))
    return made[0], made[1]
