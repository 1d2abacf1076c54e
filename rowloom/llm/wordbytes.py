"""Words of whole texts as spans of bytes, their hashes, and open-addressed tables of them, all in numpy.

Words are runs of ASCII letters, digits and all bytes from 0x80 on, A-Z lower-cased; in UTF-8 that is the same as runs of
those characters. Arrow's buffers are read as they are, no text becomes a Python string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are split into words at once; a longer text is taken by itself.
BYTES = 1 << 21
#: Words that are hashed and looked up at once.
WORDS = 1 << 16

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

# the five primes of the hash (fixed values)
P1, P2, P3, P4, P5 = map(np.uint64, (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


class Words:
    """The words of some texts, joined by single blanks in one buffer: `begin` and `size` of each, and `bounds`, the
    number of words before each text. A run of words is the span from its first one's begin to its last one's end."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        lowered = _LOWER[raw]
        inside = _WORD[lowered]
        before, after = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 1, bool)
        before[1:], after[: len(raw)] = inside, inside
        before[offsets] = after[offsets] = False  # no word goes on from one text to the next
        starts, ends = np.flatnonzero(inside & ~before[:-1]), np.flatnonzero(inside & ~after[1:]) + 1
        self.size = ends - starts
        self.begin = np.cumsum(self.size + 1) - self.size - 1
        self.bounds = np.searchsorted(starts, offsets)
        # eight spare bytes, so that eight can be read from any place
        self.buffer = np.full(int(self.size.sum()) + len(starts) + 8, 32, np.uint8)
        self.buffer[np.arange(int(self.size.sum())) + np.repeat(np.arange(len(starts)), self.size)] = lowered[inside]

    def __len__(self) -> int:
        return len(self.size)

    def text_of(self) -> np.ndarray:
        """The number of each word's text."""
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def of_list(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, begin, size) of words as they are."""
    size = np.array([len(word) for word in words], np.int64)
    return np.frombuffer(b" ".join(words) + b" " * 9, np.uint8), np.cumsum(size + 1) - size - 1, size


def words_of(column: pa.Array) -> Iterator[tuple[int, Words]]:
    """(number of the first text, words) of the texts of a column, a bounded number of bytes at a time; null has none."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + BYTES, side="right")) - 1)
        yield start, Words(raw[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start])
        start = end


def _eights(buffer: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as one number."""
    return np.ndarray((max(0, len(buffer) - 7),), "<u8", buffer, strides=(1,))


def _low(x: np.ndarray, bits) -> np.ndarray:
    """The lowest bits of each number, 1 to 64 of them."""
    return x & (np.uint64(0xFFFFFFFFFFFFFFFF) >> np.uint64(64 - bits))


def hashed(buffer: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of each span. Spans of one size are hashed together."""
    out, eights = np.empty(len(size), np.uint64), _eights(buffer)
    order = np.argsort(size.astype(np.uint16) if len(size) and size.max() < 1 << 16 else size, kind="stable")
    sizes, firsts = np.unique(size[order], return_index=True)
    with np.errstate(over="ignore"):
        for n, group in zip(sizes.tolist(), np.split(order, firsts[1:])):
            at, stop = begin[group], n - n % 32
            if n >= 32:
                lanes = [np.full(len(group), x, np.uint64) for x in (P1 + P2, P2, np.uint64(0), np.uint64(0) - P1)]
                for place in range(0, stop, 32):
                    for i in range(4):
                        lanes[i] = _turned(lanes[i] + eights[at + (place + 8 * i)] * P2, 31) * P1
                h = sum(_turned(lane, by) for lane, by in zip(lanes, (1, 7, 12, 18)))
                for lane in lanes:
                    h = (h ^ (_turned(lane * P2, 31) * P1)) * P1 + P4
                h += np.uint64(n)
            else:
                h = np.full(len(group), P5 + np.uint64(n), np.uint64)
            for place in range(stop, n - 7, 8):
                h = _turned(h ^ (_turned(eights[at + place] * P2, 31) * P1), 27) * P1 + P4
            place = n - n % 8
            if n % 8 >= 4:
                h = _turned(h ^ (_low(eights[at + place], 32) * P1), 23) * P2 + P3
                place += 4
            for place in range(place, n):
                h = _turned(h ^ (buffer[at + place].astype(np.uint64) * P5), 11) * P1
            h = (h ^ (h >> np.uint64(33))) * P2
            h = (h ^ (h >> np.uint64(29))) * P3
            out[group] = h ^ (h >> np.uint64(32))
    return out


def _equal(one: np.ndarray, a: np.ndarray, other: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans at a and at b, of the same sizes, hold the same bytes."""
    same, left, right = np.ones(len(size), bool), _eights(one), _eights(other)
    rest, done = np.flatnonzero(size > 0), 0
    while len(rest):
        differ = left[a[rest] + done] ^ right[b[rest] + done]
        same[rest] = _low(differ, 8 * np.minimum(size[rest] - done, 8)) == 0
        done += 8
        rest = rest[same[rest] & (size[rest] > done)]
    return same


class Table:
    """An open-addressed table of byte strings: slots hold a key (the hash) and the number of a span; a string goes to
    the first slot from its key on that is free or holds the same bytes, which are compared, keys alone never count."""

    def __init__(self, buffer: np.ndarray, begin: np.ndarray, size: np.ndarray):
        """A table of the spans. `slot`: the slot of each of them; `used`: slots in use; `first`: a span of each slot in
        use, -1 elsewhere."""
        self.buffer, self.begin, self.size = buffer, begin, size
        self.keys = hashed(buffer, begin, size)
        self.mask = (1 << max(4, (2 * len(size)).bit_length())) - 1
        self.first = np.full(self.mask + 1, -1, np.int64)
        self.slot = (self.keys & np.uint64(self.mask)).astype(np.int64)
        rest = np.arange(len(size))
        while len(rest):
            at = self.slot[rest]
            free = self.first[at] < 0
            self.first[at[free]] = rest[free]  # of several, one is left
            there = self.first[at]
            same = there == rest
            alike = np.flatnonzero(~same & (self.keys[there] == self.keys[rest]) & (size[there] == size[rest]))
            same[alike] = _equal(buffer, begin[there[alike]], buffer, begin[rest[alike]], size[rest[alike]])
            rest = rest[~same]
            self.slot[rest] = (self.slot[rest] + 1) & self.mask
        self.used = np.flatnonzero(self.first >= 0)

    def strings(self) -> list[bytes]:
        """The strings of the slots in use, in their order."""
        raw, spans = self.buffer.tobytes(), self.first[self.used]
        return [raw[a : a + n] for a, n in zip(self.begin[spans].tolist(), self.size[spans].tolist())]

    def find(self, buffer: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """For each span the number of the table's own span of the same bytes, -1 where it has none."""
        keys, found = hashed(buffer, begin, size), np.full(len(size), -1, np.int64)
        at, rest = (keys & np.uint64(self.mask)).astype(np.int64), np.arange(len(size))
        while len(rest):
            there = self.first[at[rest]]
            rest, there = rest[there >= 0], there[there >= 0]  # a free slot: not in the table
            same = (self.keys[there] == keys[rest]) & (self.size[there] == size[rest])
            alike = np.flatnonzero(same)
            same[alike] = _equal(self.buffer, self.begin[there[alike]], buffer, begin[rest[alike]], size[rest[alike]])
            found[rest[same]] = there[same]
            rest = rest[~same]
            at[rest] = (at[rest] + 1) & self.mask
        return found
