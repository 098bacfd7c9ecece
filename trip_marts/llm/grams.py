"""Hashed character n-grams of texts, by arrays."""

from __future__ import annotations

import numpy as np

from trip_marts.llm.textarrays import code_points, mix, prefix_sums, slice_hashes


def char_grams(texts: list[str], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every n-gram of code points; none spans two texts."""
    points, starts = code_points(texts)
    owner = np.repeat(np.arange(len(texts)), np.diff(np.append(starts, len(points))))
    ends = np.append(starts[1:], len(points)) - 1  # the line feeds between texts
    sums = prefix_sums(points)
    owners, grams = [], []
    for n in sizes:
        inside = np.ones(len(points), bool)
        for k in range(n):
            inside[np.maximum(ends - k, starts)] = False
        at = np.flatnonzero(inside)
        owners.append(owner[at])
        grams.append(bucket_of(slice_hashes(sums, at, at + n), buckets, n))
    return np.concatenate(owners), np.concatenate(grams)


def bucket_of(hashes: np.ndarray, buckets: int, salt: int = 0) -> np.ndarray:
    """A bucket for every hash; `buckets` is a power of two."""
    mixed = mix(hashes + np.uint64(salt * 0x51ED27 + 1))
    return (mixed >> np.uint64(65 - buckets.bit_length())).astype(np.int64)
