"""Texts as arrays: words, hashes of slices, code points.

Words and other byte slices that are told apart by their hash are hashed eight bytes at a
time (`byte_hashes`). Hashes of short n-grams for feature buckets are polynomials
modulo 2**64, so that one prefix sum gives all of them (`slice_hashes`); long slices can
collide there by construction.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd

_BASE = 0x9E3779B97F4A7C15
#: Bytes from which on a slice is hashed by itself.
_LONG_SLICE = 256
_U = np.uint64
_powers = {"up": np.ones(1, _U), "down": np.ones(1, _U)}

#: A-Z in lower case, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit reaches every output bit."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


_SYMBOLS = mix(np.arange(1, 257, dtype=_U))


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Sums from which `slice_hashes` takes differences; bytes or code points."""
    up, _ = _up_to(len(symbols) + 1)
    values = _SYMBOLS[symbols] if symbols.dtype == np.uint8 else mix(symbols.astype(_U) + _U(1))
    sums = np.zeros(len(symbols) + 1, _U)
    np.cumsum(values * up[: len(symbols)], out=sums[1:])
    return sums


def slice_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every short slice, the same wherever the slice stands; for features only."""
    _, down = _up_to(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(_U))


def byte_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every slice of bytes, the same wherever the slice stands.

    All slices are mixed eight bytes a step, each byte into a state that depends on all bytes
    before it.
    """
    size = (ends - starts).astype(np.int64)
    out = mix(size.astype(_U) + _U(_BASE))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words_at = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # eight bytes from every place on
    own = np.flatnonzero((size > 0) & (size < _LONG_SLICE))
    at, left = np.asarray(starts)[own], size[own]
    while len(own):
        chunk = words_at[at]
        short = left < 8
        chunk[short] &= (_U(1) << (left[short] << 3).astype(_U)) - _U(1)
        out[own] = mix((out[own] ^ chunk) + _U(_BASE))
        more = left > 8
        own, at, left = own[more], at[more] + 8, left[more] - 8
    for i in np.flatnonzero(size >= _LONG_SLICE):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def distinct_slices(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of every slice among the distinct ones, and the hashes of those.

    Slices of one hash are compared byte by byte with the first of them; should they
    differ after all, each is given another hash of its own.
    """
    hashes = byte_hashes(data, lo, hi)
    which, unique = pd.factorize(hashes)
    first = np.full(len(unique), len(which))
    np.minimum.at(first, which, np.arange(len(which)))
    one = first[which]
    size = hi - lo
    same = size == size[one]
    check = np.flatnonzero(same & (one != np.arange(len(which))))
    differ = data[ranges(lo[check], hi[check])] != data[ranges(lo[one[check]], hi[one[check]])]
    if differ.any() or not same.all():
        for i in np.union1d(np.flatnonzero(~same), np.unique(np.repeat(check, size[check])[differ])):
            digest = hashlib.blake2b(data[lo[i] : hi[i]].tobytes(), digest_size=8).digest()
            hashes[i] = int.from_bytes(digest, "little")
        which, unique = pd.factorize(hashes)
    return which, unique


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """lo[0], lo[0] + 1, ... hi[0] - 1, lo[1], ..."""
    sizes = hi - lo
    total = int(sizes.sum())
    shift = np.repeat(lo - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) if total else np.zeros(0, np.int64)
    return np.arange(total) + shift


def joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, a line feed after each, and where each starts."""
    encoded = [t.encode() for t in texts]
    data = np.frombuffer(b"\n".join(encoded) + b"\n", np.uint8)
    starts = np.zeros(len(texts), np.int64)
    np.cumsum([len(e) + 1 for e in encoded[:-1]], out=starts[1:])
    return data, starts


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of bytes other than space and 0x09-0x0D begin and end; `data` ends with a blank."""
    edge = np.diff(_SPACE[data].astype(np.int8), prepend=1)
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of every word, in order.

    Words are runs of bytes other than space and 0x09-0x0D, A-Z in lower case.
    """
    data, text_starts = joined(texts)
    starts, ends = word_places(data)
    if len(starts) == 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    hashes = byte_hashes(LOWER[data], starts, ends)
    return np.searchsorted(text_starts, starts, "right") - 1, hashes


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, a line feed after each, and where each starts."""
    data = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    starts = np.zeros(len(texts), np.int64)
    np.cumsum([len(t) + 1 for t in texts[:-1]], out=starts[1:])
    return data, starts


def bounds(owners: np.ndarray, n: int) -> np.ndarray:
    """Where the run of each owner 0..n-1 begins in sorted `owners`; n + 1 places."""
    return np.searchsorted(owners, np.arange(n + 1))
