"""Word and phrase hashes of whole Arrow batches of texts, in numpy.

All texts of a batch form one byte buffer. Hashes of ranges are differences of prefix sums of a
polynomial modulo 2^64 (the base is odd, so it has an inverse), mixed at the end.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

BASE = 0x9E3779B97F4A7C15 | 1
SPACES = b" \t\n\v\f\r"

_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash: every input bit reaches every output bit."""
    h = h ^ (h >> _U(33))
    h *= _U(0xFF51AFD7ED558CCD)
    h ^= h >> _U(33)
    h *= _U(0xC4CEB9FE1A85EC53)
    h ^= h >> _U(33)
    return h


@lru_cache(4)
def _powers(n: int, base: int = BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


KEPT_POWERS = 1 << 17  # powers that are kept between batches, 1 MB


def powers(n: int, inverse: bool = False) -> np.ndarray:
    base = pow(BASE, -1, 1 << 64) if inverse else BASE
    size = 1 << max(10, (n - 1).bit_length())
    return _powers(size, base)[:n] if size <= KEPT_POWERS else _powers.__wrapped__(n, base)


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each starts, with the end as last entry; null is empty."""
    binary = texts.cast(pa.large_binary())
    if binary.null_count:
        binary = binary.fill_null(b"")
    offsets = np.frombuffer(binary.buffers()[1], np.int64, len(binary) + 1, binary.offset * 8) if len(binary) else np.zeros(1, np.int64)
    data = binary.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data)


class Words:
    """The words of a batch of texts: byte ranges, text of each word, hashes."""

    def __init__(self, texts: pa.Array, lower: bool, separators: bytes = SPACES):
        self.data, self.bounds = buffer_of(texts)
        if lower:
            self.data = lower_ascii(self.data)
        table = np.ones(256, bool)
        table[list(separators)] = False
        inside = table[self.data]
        cut = np.zeros(len(inside) + 1, bool)
        cut[self.bounds] = True  # a word does not run on into the next text
        before = np.concatenate([[False], inside[:-1]])
        self.starts = np.flatnonzero(inside & (~before | cut[:-1]))
        after = np.concatenate([inside[1:], [False]])[: len(inside)]
        self.ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        # Words of text t are first[t] up to first[t + 1].
        self.first = np.searchsorted(self.starts, self.bounds)
        self.counts = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + _U(1)) * powers(n), out=sums[1:])
        return mix((sums[self.ends] - sums[self.starts]) * powers(n + 1, inverse=True)[self.starts] + (self.ends - self.starts).astype(np.uint64))


def phrases(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` items from each position that has so many after it in the buffer."""
    if len(hashes) < size:
        return np.zeros(0, np.uint64)
    # The polynomial of 1, 2, 4, ... items by doubling; those that add up to the size are put together.
    out, have, part, span = None, 0, hashes, 1
    while True:
        if size & span:
            after = part[have : len(hashes) - size + 1 + have]
            out = after.copy() if out is None else out[: len(after)] + after * _U(pow(BASE, have, 1 << 64))
            have += span
        if 2 * span > size:
            return mix(out)
        part = part[:-span] + part[span:] * _U(pow(BASE, span, 1 << 64))
        span *= 2


def starts_of(first: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions from which ``size`` items of one text follow, and how many there are per text."""
    fits = np.maximum(counts - size + 1, 0)
    ends = np.cumsum(fits)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(first[: len(counts)] - (ends - fits), fits)
    return at, fits


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbouring values, by doubling."""
    if len(values) < width:
        return values[:0]
    out, span = values, 1
    while 2 * span <= width:
        out, span = np.minimum(out[:-span], out[span:]), 2 * span
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def sliding_any(flags: np.ndarray, width: int) -> np.ndarray:
    """Whether one of each ``width`` neighbouring flags is set."""
    return ~sliding_min(~flags, width)


def anchors(keys: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimizers: positions whose key is least in one of the windows, and the least key of each window.

    Window ``starts[i]`` holds ``width`` keys. Equal windows have equal least keys, so a window
    that occurs again has a least key that occurs again.
    """
    least = sliding_min(keys, width)
    if not len(starts):
        return starts, least[:0]
    # The largest window minimum over the windows around a position equals its key if it is the least of one.
    flipped = np.full(len(keys) + width - 1, np.iinfo(np.uint64).max, np.uint64)
    flipped[starts + width - 1] = ~least[starts]
    best = ~sliding_min(flipped, width)
    jumps = np.flatnonzero(np.diff(starts) != 1)
    covered = np.zeros(len(keys) + 1, np.int32)
    np.add.at(covered, starts[np.concatenate([[0], jumps + 1])], 1)
    np.add.at(covered, starts[np.append(jumps, len(starts) - 1)] + width, -1)
    inside = np.cumsum(covered[:-1]) > 0
    return np.flatnonzero(inside & (best == keys)), least[starts]
