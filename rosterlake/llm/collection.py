"""The Burrows-Wheeler transform and common prefixes of a collection of byte strings, built column by column.

In every round each string adds its next symbol from the right, so all strings grow by one suffix at a time. The transform
and the common prefixes lie in two files; a round reads them once from front to end and writes them anew with the new
suffixes in place. Strings end in markers that differ from one another and come before every byte.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

#: Marks the start of a string in the transform. No UTF-8 text has this byte.
START = 0xFF
#: Common prefixes are counted up to here.
LONGEST = 255
#: Added to parents by first symbol (the first entry: none), so that all places of a collection ascend and are searched at once.
_FIRST = np.arange(-1, 256, dtype=np.int64) << 32


class Collection:
    """``parents`` is a third file beside the transform and the prefixes: where the suffix without its first symbol lies.
    Among suffixes with the same first symbol parents ascend, so a place of insertion is found by bisection.

    The arrays that a round reads and writes are made once, for the finished collection; making them anew every round
    costs more than filling them.
    """

    KINDS = (np.uint8, np.uint8, np.int32)

    def __init__(self, strings: list[bytes], folder: str):
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.columns = np.full((int(self.lengths.max(initial=0)) + 1, len(strings)), START, np.uint8)
        for i, s in enumerate(strings):  # row j is the j-th symbol from the right
            self.columns[: len(s), i] = np.frombuffer(s, np.uint8)[::-1]
        self.files = [os.open(os.path.join(folder, name), os.O_RDWR | os.O_CREAT) for name in ("transform", "prefixes", "parents")]
        self.at = np.arange(len(strings))  # where the latest suffix of each string is
        self.begins = np.full(257, len(strings), np.int64)  # of the suffixes with each first symbol
        size = int(self.lengths.sum()) + len(strings)
        self.was, self.now = ([np.empty(size, k) for k in self.KINDS] for _ in range(2))
        if size > np.iinfo(np.int32).max:
            raise ValueError("places are counted in 32 bits; build fewer strings at once")
        self.old, self.moved, self.steps = np.empty(size, bool), np.empty(size, np.int32), np.arange(size, dtype=np.int32)
        self._write(self.columns[0], np.zeros(len(strings), np.uint8), np.zeros(len(strings), np.int32))

    def _write(self, *arrays: np.ndarray) -> None:
        self.count = len(arrays[0])
        for file, values in zip(self.files, arrays):
            os.pwrite(file, values.data, 0)

    def read(self) -> list[np.ndarray]:
        out = [values[: self.count] for values in self.was]
        for file, values in zip(self.files, out):
            os.preadv(file, [values.data], 0)
        return out

    def close(self) -> None:
        for file in self.files:
            os.close(file)

    def build(self) -> Collection:
        for column in range(1, len(self.columns)):
            self._insert(column)
        return self

    def _insert(self, column: int) -> None:
        """Add the suffixes of ``column`` symbols, for every string that has so many."""
        transform, prefixes, parents = self.read()
        own = np.flatnonzero(self.lengths >= column)
        symbols = self.columns[column - 1, own]
        order = np.lexsort((self.at[own], symbols))
        own, symbols = own[order], symbols[order].astype(np.int64)
        mine = self.at[own]  # the parents of the new suffixes: ascending within a symbol
        n = len(own)

        # what stands before and after among suffixes with the same first symbol, by parent; -1 and the end: nothing
        end = self.count
        held = np.repeat(_FIRST, np.diff(self.begins, prepend=0))
        held += parents
        before = np.searchsorted(held, _FIRST[symbols + 1] + mine)
        last, after = np.full(n, -1), np.full(n, end)
        has = before > self.begins[symbols]
        last[has] = parents[before[has] - 1]
        has = before < self.begins[symbols + 1]
        after[has] = parents[before[has]]
        same = symbols[1:] == symbols[:-1]
        last[1:][same] = np.maximum(last[1:], mine[:-1])[same]
        closed = np.zeros(n, bool)  # the next suffix is new as well, and looks back by itself
        closed[:-1] = same & (mine[1:] < after[:-1])

        # a new suffix shares with its neighbour one symbol more than the least prefix between their parents
        back = np.where(last < 0, 0, _least(prefixes, np.where(last < 0, mine, last + 1), mine + 1) + 1)
        opens = ~closed & (after < end)
        ahead = _least(prefixes, mine[opens] + 1, after[opens] + 1) + 1

        places, total = before + np.arange(n), self.count + n
        old, moved = self.old[:total], self.moved[: self.count]
        old[:] = True
        old[places] = False
        moved[:] = 0
        np.add.at(moved, before[before < self.count], 1)  # a suffix moves by what is put in at or before it
        np.cumsum(moved, out=moved)
        moved += self.steps[: self.count]
        grown, common, above = (values[:total] for values in self.now)
        np.take(moved, parents, out=parents, mode="clip")
        grown[old], common[old], above[old] = transform, prefixes, parents
        grown[places], common[places], above[places] = self.columns[column, own], np.minimum(back, LONGEST), moved[mine]
        common[places[opens] + 1] = np.minimum(ahead, LONGEST)
        self.at = moved[self.at]
        self.at[own] = places
        self.begins[1:] += np.cumsum(np.bincount(symbols, minlength=256))
        self._write(grown, common, above)

    def repeated(self, length: int) -> np.ndarray:
        """A row for each string: whether the ``length`` symbols from each place occur anywhere else in the collection.
        Read off by following all strings from their whole to their end, a symbol a step."""
        _, prefixes, parents = self.read()
        shared = prefixes >= length
        shared[:-1] |= shared[1:].copy()
        out = np.zeros((len(self.lengths), len(self.columns)), bool)
        at = self.at.copy()
        for start in range(len(self.columns) - 1):
            own = np.flatnonzero(self.lengths > start)
            out[own, start] = shared[at[own]]
            at[own] = parents[at[own]]
        return out


def _least(values: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The least value of each half-open range; ranges are not empty."""
    if not len(begins):
        return np.zeros(0, np.int64)
    order = np.argsort(begins, kind="stable")  # else the gaps between ranges are read again and again
    pairs = np.empty(2 * len(begins), np.int64)
    pairs[::2], pairs[1::2] = begins[order], ends[order]
    if pairs[-1] == len(values):
        pairs = pairs[:-1]
    over = pairs >= len(values)
    out = np.empty(len(begins), np.int64)
    if over.any():
        out[order] = np.minimum.reduceat(np.append(values, values.dtype.type(255)), pairs)[::2]
    else:
        out[order] = np.minimum.reduceat(values, pairs)[::2]
    return out


def repeated_places(strings: list[bytes], length: int) -> np.ndarray:
    """For distinct strings: where a substring of ``length`` starts that is found anywhere else in the collection."""
    with tempfile.TemporaryDirectory(prefix="collection-") as folder:
        made = Collection(strings, folder)
        try:
            return made.build().repeated(length)
        finally:
            made.close()
