"""SimHash near-dedup with Golay-code keys.

A fingerprint is 64 bits; two of them link at ``MAX_BITS`` (3) or fewer differing bits. It
is cut into four segments of 16 bits. Three errors leave at least one segment i untouched,
and for some such i the next segment (cyclically) has at most one error: were all the
next ones worse, each would need two. So a key is segment i as it stands plus the next
segment up to one error, and the perfect binary Golay code (23 bits, 12 of them free)
absorbs that error: a segment padded to 23 bits is decoded to the index of its codeword;
one side of the join takes that index, the other takes the indexes of all words one bit
away too. Two segments one bit apart then share an index, whichever side they are on.
Four keys a fingerprint probe about 24, of 28 bits each, and every pair that meets is
verified. Copies of one fingerprint are one class before any key is made.
"""

from __future__ import annotations

from functools import cache
from itertools import accumulate, combinations

import numpy as np
import xxhash

MAX_BITS = 3
SHINGLE = 3
SEED = 42
#: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, the generator of the (23, 12) Golay code.
GENERATOR = 0b101011100011


def shingle_hashes(text: bytes, width: int = SHINGLE) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``width`` words, or of the whole sequence if it is shorter."""
    found = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
    if not found:
        return np.empty(0, np.uint64)
    line = b" ".join(found)
    if len(found) <= width:
        return np.array([xxhash.xxh64_intdigest(line, SEED)], np.uint64)
    ends = list(accumulate((len(w) + 1 for w in found), initial=0))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a : b - 1], SEED) for a, b in zip(ends, ends[width:])], np.uint64)


def fingerprint(text: bytes) -> int:
    """Bit k is set if it is set in over half the hashes; no words give zero."""
    hashes = shingle_hashes(text)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


@cache
def codeword_indexes() -> np.ndarray:
    """For each 16-bit segment, padded to 23 bits with zeros: the index of the nearest Golay codeword."""

    def remainder(word: np.ndarray) -> np.ndarray:
        for k in range(22, 10, -1):
            word = np.where(word >> k & 1, word ^ (GENERATOR << (k - 11)), word)
        return word

    errors = np.array([sum(1 << b for b in bits) for n in range(4) for bits in combinations(range(23), n)])
    leader = np.zeros(1 << 11, np.int64)
    leader[remainder(errors)] = errors  # the code is perfect: each remainder has one error of weight 3 or less
    segments = np.arange(1 << 16)
    return (segments ^ leader[remainder(segments)]) >> 11


def segments(prints: np.ndarray) -> np.ndarray:
    return prints.view(np.uint64).reshape(-1, 1) >> np.array([0, 16, 32, 48], np.uint64) & np.uint64(0xFFFF)


def keys(prints: np.ndarray, near: bool) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs; ``near`` gives the indexes of the words one bit away from the second segment too."""
    seg = segments(prints).astype(np.int64)
    nxt = np.roll(seg, -1, axis=1)
    flips = np.array([0] + [1 << b for b in range(16)] if near else [0])
    index = np.sort(codeword_indexes()[nxt[:, :, None] ^ flips], axis=2)
    fresh = np.ones(index.shape, bool)
    fresh[:, :, 1:] = index[:, :, 1:] != index[:, :, :-1]
    key = np.arange(4)[None, :, None] << 28 | seg[:, :, None] << 12 | index
    row = np.broadcast_to(np.arange(len(seg))[:, None, None], index.shape)
    return row[fresh], key[fresh]
