"""The column-by-column construction: its results, and how many searches a column takes."""

import random

import numpy as np

from rosterlake.llm import collection


def brute(strings, length):
    seen = {}
    for s in strings:
        for i in range(len(s) - length + 1):
            seen[s[i : i + length]] = seen.get(s[i : i + length], 0) + 1
    return [[i + length <= len(s) and seen[s[i : i + length]] > 1 for i in range(len(s))] for s in strings]


def test_repeated_places_of_strings_of_many_lengths():
    rng = random.Random(5)
    for symbols, length in ((b"ab", 3), (b"abcdefgh", 4), (bytes(range(1, 250)), 2)):
        strings = list({bytes(rng.choices(symbols, k=rng.randint(1, 40))) for _ in range(60)} - {b""})
        found = collection.repeated_places(strings, length)
        assert [row[: len(s)].tolist() for s, row in zip(strings, found)] == brute(strings, length)
    assert collection.repeated_places([b"\x00\x00\x00", b"\x00"], 1).tolist() == [[True, True, True, False], [True, False, False, False]]


def test_a_column_is_searched_once_however_many_symbols_it_has(monkeypatch):
    searches, search = [], np.searchsorted
    monkeypatch.setattr(collection.np, "searchsorted", lambda *a, **k: searches.append(1) or search(*a, **k))
    rng = random.Random(7)
    collection.repeated_places([bytes(rng.choices(range(1, 250), k=50)) for _ in range(40)], 4)
    assert len(searches) == 50
