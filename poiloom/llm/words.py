"""Words of a batch of texts as arrays of 64-bit hashes, and runs of words as hashes of them."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

#: Odd multipliers that mix hashes; fixed values of a well-known 64-bit finalizer.
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


def split(text: str | None) -> list[bytes]:
    """Words as UTF-8: what stands between spaces and the control characters 9 to 13, nothing else."""
    return text.encode().split() if text else []


def hashes(words: Iterable[bytes]) -> np.ndarray:
    """A 64-bit hash of each word, the same on every machine."""
    from xxhash import xxh3_64_digest

    return np.frombuffer(b"".join(map(xxh3_64_digest, words)), dtype="<u8")


def wide_hashes(words: Iterable[bytes]) -> np.ndarray:
    """Two independent 64-bit hashes of each word, one in each row."""
    from xxhash import xxh3_128_digest

    return np.ascontiguousarray(np.frombuffer(b"".join(map(xxh3_128_digest, words)), dtype="<u8").reshape(-1, 2).T)


def windows(h: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of width consecutive entries of h, along its last axis; it depends on their order."""
    n = h.shape[-1] - width + 1
    if n <= 0:
        return np.zeros((*h.shape[:-1], 0), dtype=np.uint64)
    # doubling: w[k] covers 2**k entries; the runs of the width's binary digits are put together
    done, at, found, step = 0, h, None, 1
    left = width
    while left:
        if left & 1:
            part = at[..., done : done + n]
            found = part.copy() if found is None else mixed(found * ODD + part)
            done += step
        left >>= 1
        if left:
            at = mixed(at[..., : at.shape[-1] - step] * ODD + at[..., step:])
            step *= 2
    return mixed(found)


def starts(lengths: np.ndarray) -> np.ndarray:
    """Where each of several runs begins, laid end to end; one more for the end."""
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def inside(begin: np.ndarray, width: int) -> np.ndarray:
    """Which windows over runs laid end to end lie within one run; begin as from starts()."""
    total = int(begin[-1])
    ok = np.ones(max(0, total - width + 1), dtype=bool)
    for b in begin[1:-1]:
        ok[max(0, b - width + 1) : b] = False
    return ok


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which entries of keys occur more than once."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s) + 1, dtype=bool)
    same[1:-1] = s[1:] == s[:-1]
    found = np.zeros(len(s), dtype=bool)
    found[order] = same[1:] | same[:-1]
    return found


def covered(begins: np.ndarray, width: int, total: int) -> np.ndarray:
    """Which of total places lie in one of the runs of width that start at begins (distinct)."""
    edge = np.zeros(total + 1, dtype=np.int64)
    edge[begins] += 1
    np.subtract.at(edge, np.minimum(begins + width, total), 1)
    return np.cumsum(edge[:-1]) > 0
