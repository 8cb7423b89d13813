"""Passages of a text and the vector that describes each.

A passage is ``PASSAGE_WORDS`` words in a row with the white space around them, or
``PASSAGE_BYTES`` bytes where fewer words than that begin in so many. Passages of many texts are
measured at once with numpy: counts of byte classes, repeated and adjacent-equal words (by a
rolling hash of the lower-cased bytes), stop words, word lengths. A long text is measured in
pieces that end where a passage does, so memory does not grow with it, and its passages are
the same as if it were measured in one piece.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np

PASSAGE_WORDS = 64
PASSAGE_BYTES = 1 << 20
#: Bytes of text that are measured together, about.
RUN_BYTES = 1 << 20
STOP_WORDS = (
    "the of and to in that is was for on with as it by at from this are be or an "
    "der die das und ist von mit den zu auf für im dem nicht ein eine sich "
    "le la les et en un une du que est pour dans par sur au pas "
    "el los las y del se por con para su al lo como es no"
).split()
CLASSES = [b"#*$%&<>|", b"!", b"?", b".,;:", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"aeiou", b" ", b"\n", b"\t\r\x0b\x0c"]
#: One class for each of the above, one for other ASCII letters, other ASCII, lead bytes and continuation bytes.
N_CLASSES = len(CLASSES) + 4
N_FEATURES = N_CLASSES + 6


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    kind = np.full(256, N_CLASSES - 3, np.int64)
    kind[ord("a") : ord("z") + 1] = N_CLASSES - 4
    for k, chars in enumerate(CLASSES):
        kind[list(chars)] = k
    kind[0xC0:], kind[0x80:0xC0] = N_CLASSES - 2, N_CLASSES - 1
    lower = np.arange(256, dtype=np.uint64)
    lower[65:91] += 32
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    return kind, lower, space


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15
    inverse = pow(base, -1, 1 << 64)
    up = np.full(n, base, np.uint64)
    down = np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    size = 1 << max(12, int(len(data)).bit_length())
    up, down = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_tables()[1][data] + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashed = (sums[ends] - sums[starts]) * down[starts]
    return hashed ^ hashed >> np.uint64(29)


@cache
def _stop_hashes() -> np.ndarray:
    text = " ".join(STOP_WORDS).encode()
    data = np.frombuffer(text, np.uint8)
    starts, ends = _spans(data)
    return np.unique(_word_hashes(data, starts, ends))


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word = np.concatenate([[False], ~_tables()[2][data], [False]])
    edges = np.flatnonzero(word[1:] != word[:-1])
    return edges[::2], edges[1::2]


def _measure(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(piece of each passage, features of each passage); a piece without words has one passage."""
    data = np.frombuffer(b" ".join(pieces) + b" ", np.uint8)  # the spaces between pieces count as nothing
    heads = np.cumsum([0] + [len(p) + 1 for p in pieces])
    starts, ends = _spans(data)
    owner = np.searchsorted(heads, starts, "right") - 1
    counts = np.bincount(owner, minlength=len(pieces))
    passages = np.maximum(1, -(-counts // PASSAGE_WORDS))
    first = np.concatenate([[0], np.cumsum(passages)])
    inside = np.arange(len(starts)) - np.concatenate([[0], np.cumsum(counts)])[owner]
    at = first[owner] + inside // PASSAGE_WORDS
    n = int(first[-1])
    piece_of = np.repeat(np.arange(len(pieces)), passages)
    # Bytes of a passage: from its first word (or the head of its piece) to the next passage.
    begin = np.empty(n, np.int64)
    begin[first[:-1]] = heads[:-1]
    cut = inside % PASSAGE_WORDS == 0
    later = cut & (inside > 0)
    begin[at[later]] = starts[later]
    lengths = np.diff(np.append(begin, len(data)))
    kind = _tables()[0][data]
    kind[heads[1:] - 1] = N_CLASSES
    kind += np.repeat(np.arange(n) * (N_CLASSES + 1), lengths)
    classes = np.bincount(kind, minlength=n * (N_CLASSES + 1)).reshape(n, N_CLASSES + 1)[:, :N_CLASSES]
    words = np.bincount(at, minlength=n)
    some = np.maximum(words, 1)
    hashed = _word_hashes(data, starts, ends)
    equal = np.zeros(len(starts), bool)
    equal[1:] = (hashed[1:] == hashed[:-1]) & (at[1:] == at[:-1])
    tagged = np.sort(at.astype(np.uint64) << np.uint64(40) | hashed & np.uint64((1 << 40) - 1))
    fresh = np.ones(len(tagged), bool)
    fresh[1:] = tagged[1:] != tagged[:-1]
    distinct = np.bincount((tagged[fresh] >> np.uint64(40)).astype(np.int64), minlength=n)
    stops = _stop_hashes()
    stop = stops[np.minimum(np.searchsorted(stops, hashed), len(stops) - 1)] == hashed
    size = ends - starts
    extra = [
        distinct / some,
        np.bincount(at, equal, minlength=n) / some,
        np.bincount(at, stop, minlength=n) / some,
        np.bincount(at, size, minlength=n) / some / 10,
        np.bincount(at, size == 1, minlength=n) / some,
        np.log1p(words) / 4,
    ]
    features = np.column_stack([classes / np.maximum(classes.sum(axis=1), 1)[:, None], *extra])
    return piece_of, features.astype(np.float32)


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text, cut where passages end."""
    at, view = 0, memoryview(text)
    while len(text) - at > PASSAGE_BYTES:
        window = view[at : at + PASSAGE_BYTES]
        starts = _spans(np.frombuffer(window, np.uint8))[0]
        whole = (len(starts) - 1) // PASSAGE_WORDS * PASSAGE_WORDS  # words of the passages that end in the window
        end = int(starts[whole]) if whole > 0 else PASSAGE_BYTES
        yield bytes(window[:end])
        at += end
    yield bytes(view[at:])


def passages(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(index of the text, features) of all passages, in runs of about ``RUN_BYTES``; a text is never empty of passages.

    A text longer than a run goes on in the next one.
    """
    held, owners, size = [], [], 0
    for k, text in enumerate(texts):
        for piece in _pieces(text):
            held.append(piece)
            owners.append(k)
            size += len(piece)
            if size >= RUN_BYTES:
                of, features = _measure(held)
                yield np.array(owners)[of], features
                held, owners, size = [], [], 0
    if held:
        of, features = _measure(held)
        yield np.array(owners)[of], features
