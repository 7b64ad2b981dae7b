"""Elias-Fano coding of a non-decreasing sequence: n values below u take about
2 + log2(u / n) bits each. The low bits of the values are packed; the high
bits are a unary bit vector with a select directory, so that the i-th value is
found without decoding the others and without a table of 64-bit offsets."""

from __future__ import annotations

import struct

import numpy as np

SELECT_EVERY = 256
_HEAD = "<QQBQ"  # n, universe, low bits, bytes of the high vector


class EliasFano:
    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, select: np.ndarray, universe: int):
        self.n, self.l, self.low, self.high, self.select, self.universe = n, low_bits, low, high, select, universe

    @classmethod
    def encode(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n, universe = len(v), int(v[-1]) + 1 if len(v) else 1
        l = max(0, (universe // max(n, 1)).bit_length() - 1)
        bits = ((v[:, None] >> np.arange(l, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        ones = (v >> np.uint64(l)).astype(np.int64) + np.arange(n, dtype=np.int64)
        high = np.zeros((int(ones[-1]) if n else 0) // 8 + 1, np.uint8)
        np.bitwise_or.at(high, ones >> 3, (1 << (ones & 7)).astype(np.uint8))
        return cls(n, l, low, high, ones[::SELECT_EVERY].astype(np.uint64), universe)

    def to_bytes(self) -> bytes:
        return struct.pack(_HEAD, self.n, self.universe, self.l, len(self.high)) + self.low.tobytes() \
            + self.high.tobytes() + self.select.astype("<u8").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes, at: int = 0) -> tuple[EliasFano, int]:
        n, universe, l, n_high = struct.unpack_from(_HEAD, data, at)
        at += struct.calcsize(_HEAD)
        n_low, n_select = (n * l + 7) // 8, -(-n // SELECT_EVERY)
        low = np.frombuffer(data, np.uint8, n_low, at)
        high = np.frombuffer(data, np.uint8, n_high, at + n_low)
        select = np.frombuffer(data, "<u8", n_select, at + n_low + n_high)
        return cls(n, l, low, high, select, universe), at + n_low + n_high + 8 * n_select

    def _low(self, i: int, count: int) -> np.ndarray:
        if not self.l:
            return np.zeros(count, np.uint64)
        first = i * self.l
        bits = np.unpackbits(self.low[first // 8:((i + count) * self.l + 7) // 8], bitorder="little")
        bits = bits[first % 8:first % 8 + count * self.l].reshape(count, self.l).astype(np.uint64)
        return (bits << np.arange(self.l, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def slice(self, i: int, count: int) -> np.ndarray:
        """Values i .. i+count-1: select finds the first, a scan the others."""
        count = max(0, min(count, self.n - i))
        if not count:
            return np.zeros(0, np.uint64)
        k = i // SELECT_EVERY
        begin = int(self.select[k]) >> 3
        last = (i + count - 1) // SELECT_EVERY + 1
        end = (int(self.select[last]) >> 3) + 1 if last < len(self.select) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")) + begin * 8
        ones = ones[np.searchsorted(ones, int(self.select[k])):]
        skip = i - k * SELECT_EVERY
        pos = ones[skip:skip + count] - np.arange(i, i + count)
        return (pos.astype(np.uint64) << np.uint64(self.l)) | self._low(i, count)

    def __getitem__(self, i: int) -> int:
        return int(self.slice(i, 1)[0])
