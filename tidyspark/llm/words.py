"""Words of many texts at once, as numpy arrays: bytes, places and hashes."""

from __future__ import annotations

import numpy as np

U = np.uint64
PRIME, SPREAD, SPREAD2 = U(0x100000001B3), U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)

#: Bytes with A to Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*values: int) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(values)] = True
    return table


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(32))) * SPREAD2
    x = (x ^ (x >> U(29))) * SPREAD
    return x ^ (x >> U(32))


def joined(values: list[str], mark: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes in lower case, ``mark`` after each, and where each text's mark ends."""
    raw = [v.encode() for v in values]
    data = LOWER[np.frombuffer(mark.join([*raw, b""]), np.uint8)]
    return data, np.cumsum([len(r) + len(mark) for r in raw])


def places(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of every run of bytes that are no breaks."""
    inside = ~breaks[data]
    first = np.flatnonzero(inside & ~np.append(False, inside[:-1]))
    last = np.flatnonzero(inside & ~np.append(inside[1:], False))
    return first, last - first + 1


def hashes(data: np.ndarray, first: np.ndarray, length: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of runs of bytes, eight bytes at a time; runs of other lengths start elsewhere."""
    found = mixed(length.astype(np.uint64) * SPREAD + U(seed))
    words = np.lib.stride_tricks.sliding_window_view(np.concatenate([data, np.zeros(8, np.uint8)]), 8)
    masks = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
    todo, done = np.arange(len(first)), 0
    while len(todo):
        left = np.minimum(length[todo] - done, 8)
        piece = np.ascontiguousarray(words[first[todo] + done]).view(np.uint64)[:, 0] & masks[left]
        found[todo] = mixed(found[todo] * PRIME + piece)
        done += 8
        todo = todo[length[todo] > done]
    return found
