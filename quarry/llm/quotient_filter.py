"""Counting quotient filters that lose nothing, as sorted arrays.

A key of some bits is permuted by a Feistel network, which is invertible. The top bits of the result are the quotient, all others the
remainder, kept in full: so a filter gives its keys back. Entries lie in the order of the permuted keys: the quotients as runs in unary, the
remainders in whole bytes, a counter of one byte each and those that don't fit apart. Filters over one range of quotients merge in that order.
Keys up to 128 bits are two arrays, the high and the low half of their bits.
"""

from __future__ import annotations

import numpy as np

from .blocks import pack_ints, unpack_ints
from .byte_bpe import frame, packed, unframe, unpacked

ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


def half_bits(bits: int) -> int:
    return (bits + 1) // 2


def stirred(x: np.ndarray, salt: int, mask: np.uint64) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + np.uint64(salt)) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (x ^ (x >> np.uint64(29))) & mask


def permute(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << half_bits(bits)) - 1)
    for salt in ROUNDS:
        high, low = low, high ^ stirred(low, salt, mask)
    return high, low


def restore(high: np.ndarray, low: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << half_bits(bits)) - 1)
    for salt in reversed(ROUNDS):
        high, low = low ^ stirred(high, salt, mask), high
    return high, low


def summed(high: np.ndarray, low: np.ndarray, counts: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    half = half_bits(bits)
    if 2 * half <= 64:
        order = np.argsort((high << np.uint64(half)) | low, kind="stable")
    else:
        order = np.lexsort((low, high))
    high, low = high[order], low[order]
    new = np.ones(len(high), bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.flatnonzero(new)
    return high[at], low[at], np.add.reduceat(counts[order], at) if len(at) else counts


def pack_filter(high: np.ndarray, low: np.ndarray, counts: np.ndarray, bits: int, first: int, slots: int) -> bytes:
    """Sorted permuted keys whose high half lies in a range of `slots` quotient values that begins at `first`. The quotient is the high half's top bits, as many as make about one entry a quotient."""
    half = half_bits(bits)
    cut = max(0, (max(slots, 1) // max(len(high), 1)).bit_length() - 1)  # remainder bits taken from the high half
    inside = high - np.uint64(first)  # quotient and remainder are both of this, as first may have any low bits
    quotient = inside >> np.uint64(cut)
    runs = np.bincount(quotient.astype(np.int64), minlength=1)
    unary = np.zeros(int(runs.sum()) + len(runs), np.uint8)
    unary[np.cumsum(runs + 1) - 1] = 1  # a zero for each entry, a one where its quotient ends
    remainder = [place(inside & np.uint64((1 << cut) - 1), (cut + 7) // 8), place(low, (half + 7) // 8)]
    small = np.minimum(counts, 255).astype(np.uint8)
    head = np.array([len(high), len(runs), cut, first], np.uint64).view(np.int64)
    return frame(pack_ints(head), packed(np.packbits(unary).tobytes()), *map(packed, remainder), packed(small.tobytes()), pack_ints(counts[small == 255]))


def unpack_filter(data: bytes, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    head, unary, upper, lower, small, large = unframe(data)
    n, runs, cut, first = unpack_ints(head).view(np.uint64).tolist()
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unpacked(unary), np.uint8))[: n + runs])
    quotient = np.repeat(np.arange(runs, dtype=np.uint64), np.diff(ends, prepend=-1) - 1)
    high = ((quotient << np.uint64(cut)) | unplaced(unpacked(upper), n, (cut + 7) // 8)) + np.uint64(first)
    counts = np.frombuffer(unpacked(small), np.uint8).astype(np.int64)
    counts[counts == 255] = unpack_ints(large)
    return high, unplaced(unpacked(lower), n, (half_bits(bits) + 7) // 8), counts


def place(x: np.ndarray, size: int) -> bytes:
    """The low `size` bytes of each number."""
    return np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unplaced(raw: bytes, n: int, size: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw, np.uint8).reshape(n, size)
    return out.view("<u8").ravel()
