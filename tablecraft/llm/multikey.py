"""Multikey quicksort of pointers into one byte buffer.

A pointer is where a string starts.  Slices of pointers are quicksorted by the next
eight bytes of their strings at once, taken as one big-endian number; pointers with
equal numbers are a slice of the next round, eight bytes on.  Strings are never copied.
"""

from __future__ import annotations

import numpy as np

STEP = 8


def padded(flat: bytes) -> np.ndarray:
    """The buffer with room behind it, so that every pointer has eight bytes."""
    return np.frombuffer(flat + bytes(STEP), np.uint8)


def _keys(buffer: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The next eight bytes of each string as a number, zero beyond its end."""
    every = np.ndarray((len(buffer) - STEP + 1,), ">u8", buffer, strides=(1,))
    key = every[np.minimum(at, len(every) - 1)].astype(np.uint64)
    left = np.clip(left, 0, STEP)
    shift = ((STEP - left) * 8 % 64).astype(np.uint64)
    return np.where(left > 0, (key >> shift) << shift, np.uint64(0))


def sorted_runs(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers by (group, bytes), and where in it a run of equal strings of a group begins.

    ``group`` ascends.  Strings of one group must have no zero byte or equal lengths.
    """
    n = len(start)
    key = _keys(buffer, start, length)
    order = np.empty(n, np.int64)
    edges = [*np.flatnonzero(np.append(True, group[1:] != group[:-1])[:n]).tolist(), n]
    for a, b in zip(edges, edges[1:]):
        order[a:b] = a + np.argsort(key[a:b], kind="quicksort")
    key = key[order]
    new = np.append(True, (key[1:] != key[:-1]) | (group[1:] != group[:-1]))[:n]
    depth = STEP
    live = np.arange(n)  # places in the order whose slice may still part
    while len(live):
        first = np.flatnonzero(new[live])
        size = np.diff(np.append(first, len(live)))
        longest = np.maximum.reduceat(length[order[live]], first)
        stays = np.repeat((size > 1) & (longest > depth), size)
        live = live[stays]
        if not len(live):
            break
        own = order[live]
        run = np.cumsum(new[live])
        key = _keys(buffer, start[own] + depth, length[own] - depth)
        turn = np.lexsort((key, run))
        order[live], key = own[turn], key[turn]
        new[live[1:]] |= (key[1:] != key[:-1])
        depth += STEP
    return order, new
