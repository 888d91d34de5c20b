"""The perfect binary Golay code of length 23: 4096 words, and each of the 2**23 points within distance 3 of one."""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, RADIUS = 23, 3
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _remainder(x: int) -> int:
    for bit in range(LENGTH - 1, 10, -1):
        if x >> bit & 1:
            x ^= GENERATOR << (bit - 11)
    return x


def _tables():
    unit = [_remainder(1 << i) for i in range(LENGTH)]
    by_byte = np.zeros((3, 256), dtype=np.int64)
    for part in range(3):
        for value in range(256):
            for bit in range(8):
                if value >> bit & 1 and part * 8 + bit < LENGTH:
                    by_byte[part, value] ^= unit[part * 8 + bit]
    near: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(RADIUS + 2):
        for bits in combinations(range(LENGTH), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= unit[bit]
            near[syndrome].append(sum(1 << bit for bit in bits))
    width = max(map(len, near))
    errors = np.full((2048, width), -1, dtype=np.int64)
    for syndrome, found in enumerate(near):
        errors[syndrome, : len(found)] = found
    return by_byte, errors


_BY_BYTE, _ERRORS = _tables()


def anchors(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code words within RADIUS + 1 of each point (2-D, first the nearest), and which places hold one."""
    points = points.astype(np.int64)
    syndrome = _BY_BYTE[0, points & 255] ^ _BY_BYTE[1, points >> 8 & 255] ^ _BY_BYTE[2, points >> 16]
    errors = _ERRORS[syndrome]
    return points[:, None] ^ errors, errors >= 0
