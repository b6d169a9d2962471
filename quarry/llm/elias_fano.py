"""Elias-Fano sequences of numbers, read in place from one buffer by whole arrays of queries."""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)


def every(byte: int) -> np.uint64:
    return np.uint64(byte * 0x0101010101010101)


#: Place of set bit number r of byte b, at r * 256 + b.
IN_BYTE = np.array([next((i for i in range(8) if b >> i & 1 and (b & ((1 << i) - 1)).bit_count() == r), 0) for r in range(8) for b in range(256)], np.int64)


def kth_bit(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Where in each word its set bit number k (from 0) stands: first the byte, by sums over all bytes at once, then the bit in it."""
    k = k.astype(np.uint64)
    sums = words - ((words >> ONE) & every(0x55))
    sums = (sums & every(0x33)) + ((sums >> np.uint64(2)) & every(0x33))
    with np.errstate(over="ignore"):
        sums = ((sums + (sums >> np.uint64(4))) & every(0x0F)) * every(1)  # in each byte, the set bits up to its end
        at = np.bitwise_count(((k * every(1) | every(0x80)) - sums) & every(0x80)).astype(np.uint64) << np.uint64(3)
    at = np.minimum(at, np.uint64(56))
    rest = k - (((sums << np.uint64(8)) >> at) & np.uint64(255))
    return at.astype(np.int64) + IN_BYTE[((rest & np.uint64(7)) << np.uint64(8) | ((words >> at) & np.uint64(255))).astype(np.int64)]


class EliasFano:
    """Numbers n_0 <= n_1 <= ..., all at least 0: low bits packed, high parts as gaps in unary."""

    def __init__(self, raw: memoryview):
        self.n, self.low_bits, n_low, n_high = (int(x) for x in np.frombuffer(raw, "<i8", 4))
        at = 32
        self.low = np.frombuffer(raw, "<u8", n_low, at)
        self.high = np.frombuffer(raw, "<u8", n_high, at + 8 * n_low)
        self.ones = np.frombuffer(raw, "<i8", n_high + 1, at + 8 * (n_low + n_high))
        self.zeros = np.arange(n_high + 1) * 64 - self.ones
        self.table = None

    @staticmethod
    def pack(numbers: np.ndarray) -> bytes:
        numbers = np.asarray(numbers, np.int64)
        n, top = len(numbers), int(numbers[-1]) + 1 if len(numbers) else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        u = numbers.astype(np.uint64)
        low = np.zeros((n * bits + 63) // 64 + 1, np.uint64)
        if bits:
            at = np.arange(n, dtype=np.uint64) * np.uint64(bits)
            word, shift, part = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63), u & np.uint64((1 << bits) - 1)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + np.uint64(bits) > np.uint64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (np.uint64(64) - shift[over]))
        place = (u >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        high = np.zeros((int(place[-1]) if n else 0) // 64 + 2, np.uint64)  # at least one zero stands after the last one
        np.bitwise_or.at(high, place >> 6, ONE << (place & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))])
        return np.array([n, bits, len(low), len(high)], "<i8").tobytes() + low.astype("<u8").tobytes() + high.astype("<u8").tobytes() + ones.astype("<i8").tobytes()

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        bits = np.uint64(self.low_bits)
        at = i.astype(np.uint64) * bits
        word, shift = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
        found = self.low[word] >> shift
        over = shift + bits > np.uint64(64)
        found[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
        return (found & ((ONE << bits) - ONE)).astype(np.int64)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The numbers at positions i."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.ones, i, "right") - 1
        place = word * 64 + kth_bit(self.high[word], i - self.ones[word])
        return (place - i) << self.low_bits | self.lows(i)

    def below(self, h: np.ndarray) -> np.ndarray:
        """How many numbers have a high part below h: what stands before zero number h - 1 of the high bits. Many queries share a table of all zeros, few look up their own."""
        if self.table is None and len(h) * 4 >= self.n:
            places = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little") == 0)
            self.table = np.concatenate([[0], places - np.arange(len(places)), [self.n]])
        if self.table is not None:
            return self.table[np.clip(h, 0, len(self.table) - 1)]
        k = np.maximum(h - 1, 0)
        inside = (h > 0) & (k < self.zeros[-1])
        k = np.where(inside, k, 0)
        word = np.searchsorted(self.zeros, k, "right") - 1
        place = word * 64 + kth_bit(~self.high[word], k - self.zeros[word])
        return np.where(h <= 0, 0, np.where(inside, place - k, self.n))

    def successor(self, x: np.ndarray) -> np.ndarray:
        """Position of the first number that is at least x; n where there is none."""
        return self.search(np.asarray(x, np.int64))[0]

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """successor(x), and where the numbers with the high part of x end."""
        h, want = x >> self.low_bits, x & ((1 << self.low_bits) - 1)
        a, b = self.below(h), self.below(h + 1)
        end = b.copy()
        todo = np.flatnonzero(a < b)
        while len(todo):
            mid = (a[todo] + b[todo]) >> 1
            less = self.lows(mid) < want[todo]
            a[todo] = np.where(less, mid + 1, a[todo])
            b[todo] = np.where(less, b[todo], mid)
            todo = todo[a[todo] < b[todo]]
        return a, end

    def find(self, x: np.ndarray) -> np.ndarray:
        """Position of x, or -1."""
        x = np.asarray(x, np.int64)
        if not self.n:
            return np.full(len(x), -1, np.int64)
        at, end = self.search(x)
        there = at < end
        there[there] = self.lows(at[there]) == x[there] & ((1 << self.low_bits) - 1)
        return np.where(there, at, -1)
