"""Elias-Fano coding of a non-decreasing sequence with a sampled select
structure: about ``2 + log2(u / n)`` bits a value, any value found again
from one 32-bit sample and a short scan, no 64-bit offset table."""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = "<QQBQ"


def encode(values: np.ndarray) -> bytes:
    """``values``: non-decreasing, none negative, as uint64."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return struct.pack(_HEAD, 0, 0, 0, 0)
    if np.any(values[1:] < values[:-1]):
        raise ValueError("the sequence decreases")
    u = int(values[-1])
    width = max(0, ((u + 1) // n).bit_length() - 1)
    low = []
    for i in range(0, n if width else 0, 1 << 16):  # whole bytes: 65,536 values of any width
        part = values[i:i + (1 << 16), None] >> np.arange(width, dtype=np.uint64)
        low.append(np.packbits((part & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little").tobytes())
    ones = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
    if int(ones[-1]) >= 1 << 32:
        raise ValueError("too many values for 32-bit samples; use smaller shards")
    bits = np.zeros(int(ones[-1]) + 1, np.uint8)
    bits[ones] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    return b"".join((struct.pack(_HEAD, n, u, width, len(high)), *low, high, ones[::SAMPLE].astype("<u4").tobytes()))


class Sequence:
    """Reads what ``encode`` wrote, without decoding it as a whole."""

    def __init__(self, blob: bytes):
        self.n, self.u, self.width, n_high = struct.unpack_from(_HEAD, blob)
        at = struct.calcsize(_HEAD)
        n_low = (self.n * self.width + 7) // 8
        self.low = np.frombuffer(blob, np.uint8, n_low, at)
        self.high = np.frombuffer(blob, np.uint8, n_high, at + n_low)
        self.samples = np.frombuffer(blob, "<u4", -(-self.n // SAMPLE), at + n_low + n_high)

    def __len__(self) -> int:
        return self.n

    def select(self, lo: int, hi: int) -> np.ndarray:
        """Values ``lo`` to ``hi - 1``: the scan starts at the sample before ``lo``
        and ends at the one after ``hi - 1``."""
        if not 0 <= lo <= hi <= self.n:
            raise IndexError((lo, hi, self.n))
        if lo == hi:
            return np.zeros(0, np.uint64)
        first, after = lo // SAMPLE, (hi - 1) // SAMPLE + 1
        start = int(self.samples[first])
        end = int(self.samples[after]) if after < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[start // 8:-(-end // 8)], bitorder="little")
        ones = np.flatnonzero(bits) + start // 8 * 8
        ones = ones[ones >= start][lo - first * SAMPLE:hi - first * SAMPLE]
        out = (ones - np.arange(lo, hi)).astype(np.uint64) << np.uint64(self.width)
        if self.width:
            b0, b1 = lo * self.width, hi * self.width
            bits = np.unpackbits(self.low[b0 // 8:-(-b1 // 8)], bitorder="little")[b0 % 8:][:b1 - b0]
            weight = np.uint64(1) << np.arange(self.width, dtype=np.uint64)
            out |= (bits.reshape(hi - lo, self.width).astype(np.uint64) * weight).sum(axis=1, dtype=np.uint64)
        return out

    def __getitem__(self, i: int) -> int:
        return int(self.select(i, i + 1)[0])
