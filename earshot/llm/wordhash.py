"""Words of a stretch of bytes and their 64-bit hashes, by whole-array operations."""

from __future__ import annotations

import numpy as np

U = np.uint64
MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so that its powers have inverses modulo 2**64
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base & (2**64 - 1), U)
    if n:
        steps[0] = 1
    return np.multiply.accumulate(steps)


class Powers:
    """Powers of MULTIPLIER and of its inverse, as many as were ever asked for."""

    up = down = np.zeros(0, U)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 21)
            cls.up, cls.down = powers(MULTIPLIER, size), powers(pow(MULTIPLIER, -1, 2**64), size)
        return cls.up[:n], cls.down[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(33))) * U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(33))


def sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each stretch of values that depends on their order, not on where it stands."""
    up, down = Powers.of(len(values) + 1)
    total = np.concatenate([np.zeros(1, U), np.cumsum(values * up[: len(values)])])
    return (total[ends] - total[starts]) * down[starts]


def word_spans(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word starts and ends, and its hash."""
    raw = np.frombuffer(b" " + text + b" ", np.uint8)
    space = SPACE[raw]
    starts = np.flatnonzero(space[:-1] & ~space[1:])
    ends = np.flatnonzero(~space[:-1] & space[1:])
    return starts, ends, mix(sums(raw[1:-1].astype(U) + U(1), starts, ends))
