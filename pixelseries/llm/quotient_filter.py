"""Counting quotient filters that lose nothing: exact counters of n-grams of word ids, in a few bytes each.

An n-gram is packed into lanes of at most 64 bits, whole ids in each. A permutation of the packed bits
spreads n-grams evenly; being invertible, it loses none. The first bits of the first lane say
in which range of the table an n-gram falls, the next ones are its quotient there, and all that is
left is its remainder. A filter holds the n-grams of one range in sorted order: quotients as a bit
string with a one for each entry and a zero for each quotient passed, remainders in as many bytes as they
need, counts in a byte, or in eight where a byte does not do. Filters of a range merge by
sorting their entries together and adding equal ones up.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

HEAD = struct.Struct("<IIB")
ODD = 0x9E3779B97F4A7C15
ROUNDS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _hash(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number; need not be inverted."""
    x = (x + np.uint64(1)) * np.uint64(ODD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(ROUNDS[0])
    return x ^ (x >> np.uint64(32))


@dataclass(frozen=True)
class Layout:
    """How ``k`` ids of ``bits`` bits each lie in lanes, and how many ranges (a power of two) the table has."""

    k: int
    bits: int
    range_bits: int

    @property
    def lanes(self) -> list[int]:
        """Ids in each lane."""
        most = 64 // self.bits
        return [min(most, self.k - at) for at in range(0, self.k, most)]

    @property
    def widths(self) -> list[int]:
        return [n * self.bits for n in self.lanes]

    @property
    def cut(self) -> int:
        """Bits that name the range."""
        return min(self.range_bits, self.widths[0])

    def pack(self, ids: np.ndarray) -> list[np.ndarray]:
        """Lanes of the n-grams that begin at each place of ``ids`` but the last ``k - 1``."""
        n, out, at = len(ids) - self.k + 1, [], 0
        for held in self.lanes:
            lane = np.zeros(n, np.uint64)
            for j in range(at, at + held):
                lane = (lane << np.uint64(self.bits)) | ids[j : j + n].astype(np.uint64)
            out.append(lane)
            at += held
        return out

    def unpack(self, lanes: Sequence[np.ndarray]) -> np.ndarray:
        """A row of ``k`` ids for each n-gram."""
        out = []
        for lane, held in zip(lanes, self.lanes):
            out += [(lane >> np.uint64((held - 1 - j) * self.bits)) & _mask(self.bits) for j in range(held)]
        return np.stack(out, 1).astype(np.int64)

    def permute(self, lanes: Sequence[np.ndarray]) -> list[np.ndarray]:
        first, width = lanes[0], self.widths[0]
        for lane in lanes[1:]:
            first = first ^ (_hash(lane) & _mask(width))
        half = np.uint64((width + 1) // 2)
        for odd in ROUNDS:
            first = ((first ^ (first >> half)) * np.uint64(odd)) & _mask(width)
        first = first ^ (first >> half)
        rest = [lane ^ (_hash(first + np.uint64(j)) & _mask(w)) for j, (lane, w) in enumerate(zip(lanes[1:], self.widths[1:]))]
        return [first, *rest]

    def restore(self, lanes: Sequence[np.ndarray]) -> list[np.ndarray]:
        """The inverse of ``permute``."""
        first, width = lanes[0], self.widths[0]
        rest = [lane ^ (_hash(first + np.uint64(j)) & _mask(w)) for j, (lane, w) in enumerate(zip(lanes[1:], self.widths[1:]))]
        half = np.uint64((width + 1) // 2)
        first = first ^ (first >> half)
        for odd in reversed(ROUNDS):
            first = (first * np.uint64(pow(odd, -1, 1 << width))) & _mask(width)
            first = first ^ (first >> half)
        for lane in rest:
            first = first ^ (_hash(lane) & _mask(width))
        return [first, *rest]

    def mark(self, lanes: Sequence[np.ndarray], bits: int) -> np.ndarray:
        """The place of permuted n-grams in a bitmap of ``2 ** bits``."""
        return lanes[0] >> np.uint64(max(0, self.widths[0] - bits))


Entries = tuple[list[np.ndarray], np.ndarray]


def summed(lanes: list[np.ndarray], counts: np.ndarray | None = None) -> Entries:
    """Entries in order, equal ones added up; without ``counts`` each counts once."""
    if len(lanes) == 1 and counts is None:
        keys, n = np.unique(lanes[0], return_counts=True)
        return [keys], n.astype(np.int64)
    order = np.argsort(lanes[0], kind="stable") if len(lanes) == 1 else np.lexsort(lanes[::-1])
    lanes = [x[order] for x in lanes]
    counts = np.ones(len(order), np.int64) if counts is None else counts[order]
    if not len(order):
        return lanes, counts
    new = np.zeros(len(order), bool)
    new[0] = True
    for x in lanes:
        new[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(new)
    return [x[at] for x in lanes], np.add.reduceat(counts, at)


def _bytes_of(x: np.ndarray, bits: int) -> bytes:
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8].tobytes()


def _numbers(raw: memoryview, n: int, bits: int) -> np.ndarray:
    out, size = np.zeros((n, 8), np.uint8), (bits + 7) // 8
    out[:, :size] = np.frombuffer(raw[: n * size], np.uint8).reshape(n, size)
    return out.view("<u8").ravel()


def encode(layout: Layout, entries: Entries) -> bytes:
    """The filter of entries (permuted, sorted, distinct) that share a range."""
    lanes, counts = entries
    n, free = len(counts), layout.widths[0] - layout.cut
    q = min(free, max(0, (n - 1).bit_length()))
    inner = lanes[0] & _mask(free)
    places = (inner >> np.uint64(free - q)).astype(np.int64) + np.arange(n)
    bits = np.zeros((1 << q) + n, np.uint8)
    bits[places] = 1
    large = counts > 254
    parts = [HEAD.pack(n, int(large.sum()), q), np.packbits(bits).tobytes(), _bytes_of(inner & _mask(free - q), free - q)]
    parts += [_bytes_of(x, w) for x, w in zip(lanes[1:], layout.widths[1:])]
    parts += [np.where(large, 255, counts).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes()]
    return b"".join(parts)


def decode(layout: Layout, at: int, raw: bytes) -> Entries:
    """The entries of a filter of range ``at``."""
    n, large, q = HEAD.unpack_from(raw)
    view, free = memoryview(raw)[HEAD.size :], layout.widths[0] - layout.cut
    size = ((1 << q) + n + 7) // 8
    quotient = np.flatnonzero(np.unpackbits(np.frombuffer(view[:size], np.uint8))) - np.arange(n)
    view, lanes = view[size:], []
    for w in [free - q, *layout.widths[1:]]:
        lanes.append(_numbers(view, n, w))
        view = view[n * ((w + 7) // 8) :]
    lanes[0] = lanes[0] | (quotient.astype(np.uint64) << np.uint64(free - q)) | (np.uint64(at) << np.uint64(free) if layout.cut else np.uint64(0))
    counts = np.frombuffer(view[:n], np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(view[n : n + 8 * large], "<i8")
    return lanes, counts


def filters(layout: Layout, entries: Entries) -> list[tuple[int, bytes]]:
    """(range, filter) of sorted entries, for each range that has any."""
    lanes, counts = entries
    if not len(counts):
        return []
    if not layout.cut:
        return [(0, encode(layout, entries))]
    at = (lanes[0] >> np.uint64(layout.widths[0] - layout.cut)).astype(np.int64)
    heads = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    ends = [*heads[1:], len(at)]
    return [(int(at[a]), encode(layout, ([x[a:b] for x in lanes], counts[a:b]))) for a, b in zip(heads, ends)]


def merged(layout: Layout, at: int, raws: Sequence[bytes]) -> Entries:
    """The entries of all filters of a range, equal ones added up."""
    parts = [decode(layout, at, x) for x in raws]
    return summed([np.concatenate(x) for x in zip(*[p[0] for p in parts])], np.concatenate([p[1] for p in parts]))
