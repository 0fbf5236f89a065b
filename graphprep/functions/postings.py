"""Posting blocks: sorted numbers as bytes, and their intersection."""

from __future__ import annotations

import numpy as np


def encode(values: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups of rising numbers as bytes: differences (the first of a group whole), seven bits a byte, the last with its top
    bit clear. ``begins`` are the places of the groups' first numbers; the second result those of their first bytes."""
    deltas = np.diff(values, prepend=0)
    deltas[begins] = values[begins]
    sizes = np.ones(len(deltas), np.int64)
    for bits in range(7, 63, 7):
        more = deltas >= 1 << bits
        if not more.any():
            break
        sizes += more
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - sizes
    for k in range(int(sizes.max(initial=0))):
        has = sizes > k
        out[starts[has] + k] = ((deltas[has] >> (7 * k)) & 127) | np.where(sizes[has] > k + 1, 128, 0)
    return out, starts[begins]


def decode(data: bytes) -> np.ndarray:
    """The numbers of one group."""
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.int64)
    starts = np.append(0, np.flatnonzero(raw < 128)[:-1] + 1)
    place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    return np.cumsum(np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), starts))


def met(few: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The numbers of the shorter list that are in the longer one: looked up, not merged, so that it costs a logarithm each."""
    if not len(many):
        return few[:0]
    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
    return few[many[at] == few]
