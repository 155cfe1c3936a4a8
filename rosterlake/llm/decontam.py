"""Benchmark decontamination with SimHash windows.

For each benchmark item, document windows of the item's number of words get a SimHash over their word shingles; a
document with fewer words is one window. A
multi-index over Hamming blocks finds every item of that size whose fingerprint lies within the radius; the weighted
similarity of the shingle multisets then decides. A window that has no shingle in common with the item has similarity
zero, so only windows that reach a benchmark shingle are fingerprinted; that leaves out nothing that could be verified.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import free, numbered, small_batches, texts, with_row

SHINGLE = 5
SIMILARITY = 0.8
#: The fingerprint is eight blocks of a byte. Within BLOCK_RADIUS of each block, any distance up to RADIUS leaves one block
#: that the index finds: more than 8 * (BLOCK_RADIUS + 1) - 1 bits would be needed to miss them all.
BLOCKS, BLOCK_RADIUS = 8, 2
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
#: Benchmark items that are held at once; a larger benchmark takes more passes over the documents.
ITEMS = 20_000
_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """Lower-case runs of letters and digits."""
    return _WORD.findall((text or "").lower())


def shingles(found: list, size: int = SHINGLE) -> list[tuple]:
    """Word shingles with repeats; a shorter sequence is one shingle, an empty one has none."""
    if len(found) <= size:
        return [tuple(found)] if found else []
    return list(zip(*(found[i:] for i in range(size))))


def similarity(left: Counter, right: Counter) -> float:
    """Weighted Jaccard: what the multisets share over what they hold together."""
    shared = sum((left & right).values())
    whole = sum(left.values()) + sum(right.values()) - shared
    return shared / whole if whole else 0.0


def _hash(shingle: tuple) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(" ".join(shingle).encode("utf-8", "surrogatepass"))


def _bits(hashes: list[int]) -> np.ndarray:
    """+1 or -1 for each bit of each hash."""
    return np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").reshape(-1, 8).copy().view("<u8")[:, 0]


def simhash(hashes: list[int]) -> int:
    return int(_packed(_bits(hashes).sum(axis=0)[None])[0])


class Index:
    """Items of a benchmark by number of words, with the tables of a multi-index for each number."""

    def __init__(self, items: list[tuple[int, str]], radius: int = RADIUS, threshold: float = SIMILARITY):
        self.radius, self.threshold = radius, threshold
        sized: dict[int, list] = defaultdict(list)
        self.with_shingle: dict[tuple, set[int]] = defaultdict(set)  # shingle: numbers of words of the items that have it
        for item, text in items:
            found = words(text)
            own = shingles(found)
            if own:
                sized[len(found)].append((item, Counter(own), simhash([_hash(s) for s in own])))
                for s in own:
                    self.with_shingle[s].add(len(found))
        self.vocabulary = {w for s in self.with_shingle for w in s}
        near = [[v for v in range(256) if (v ^ w).bit_count() <= BLOCK_RADIUS] for w in range(256)]
        self.sized = {}
        for size, group in sized.items():
            prints = np.array([g[2] for g in group], np.uint64)
            table = [[[] for _ in range(256)] for _ in range(BLOCKS)]
            for i, p in enumerate(prints.tolist()):
                for b in range(BLOCKS):
                    for v in near[p >> (8 * b) & 255]:
                        table[b][v].append(i)
            self.sized[size] = group, prints, table

    def found(self, text: str) -> list[tuple[int, int, int, float]]:
        """(item, first word, words, similarity): the best window of each item, the first of equals. For an item longer than
        the document, the window is the whole document."""
        known = self.vocabulary
        document = words(text)
        marks = [w in known for w in document]
        if not any(marks):
            return []
        reach: dict[int, set[int]] = defaultdict(set)
        for size in sorted({len(s) for s in self.with_shingle}):
            for at in _full(marks, size):
                for n in self.with_shingle.get(tuple(document[at : at + size]), ()):
                    if n >= size:
                        reach[n].update(range(max(0, at + size - n), min(at, max(0, len(document) - n)) + 1))
        best: dict[int, tuple[float, int, int]] = {}
        for n, starts in reach.items():
            for first, last in _stretches(sorted(starts)):
                self._windows(document, first, last, n, best)
        return [(item, at, min(n, len(document)), score) for item, (score, at, n) in best.items()]

    def _windows(self, document: list[str], first: int, last: int, n: int, best: dict) -> None:
        """Windows of ``n`` words that start from ``first`` to ``last``."""
        group, prints, table = self.sized[n]
        own = shingles(document[first : last + n], min(SHINGLE, n))
        each = min(n - min(SHINGLE, n) + 1, len(own))
        sums = np.zeros((len(own) + 1, 64), np.int32)
        np.cumsum(_bits([_hash(s) for s in own]), axis=0, out=sums[1:])
        for k, value in enumerate(_packed(sums[each:] - sums[:-each]).tolist()):
            candidates = {i for b in range(BLOCKS) for i in table[b][value >> (8 * b) & 255]}
            for i in candidates:
                if (value ^ int(prints[i])).bit_count() <= self.radius:
                    score = similarity(Counter(own[k : k + each]), group[i][1])
                    if score >= self.threshold and score > best.get(group[i][0], (0.0,))[0]:
                        best[group[i][0]] = score, first + k, n


def _full(marks: list[bool], size: int) -> Iterator[int]:
    """Where ``size`` marks in a row start."""
    run = 0
    for i, mark in enumerate(marks):
        run = run + 1 if mark else 0
        if run >= size:
            yield i - size + 1


def _stretches(starts: list[int]) -> Iterator[tuple[int, int]]:
    first = last = starts[0] if starts else 0
    for at in starts[1:]:
        if at != last + 1:
            yield first, last
            first = at
        last = at
    if starts:
        yield first, last


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
          item_text: str = "text", radius: int = RADIUS, threshold: float = SIMILARITY, items: int = ITEMS, nameless: bool = False) -> DataFrame:
    """One row for each input row and item found in it: ``_row``, ``doc_id``, ``item_id``, ``first_word``, ``n_words``
    and ``similarity`` of the best window.

    The benchmark is read in blocks of ``items`` items, which bounds what is sent to the executors; each block is one
    pass over the documents without a shuffle, and all windows of all documents are looked at in each. Null and empty
    texts, and items without a word, give nothing. Repeated rows give a result each. An item is a pair of id and text: one
    that is listed twice is reported once, different texts under one id are looked for and reported one by one. Items
    without an id are looked for with ``nameless``, and reported with a null one.
    """
    whole = with_row(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")))
    return _leaks(whole, benchmark, item_id, item_text, radius, threshold, items, nameless)


def _leaks(whole: DataFrame, benchmark: DataFrame, item_id: str, item_text: str, radius: int, threshold: float, items: int, nameless: bool) -> DataFrame:
    small_batches(whole.sparkSession)
    schema = "_row long, doc_id long, item_id long, first_word int, n_words int, similarity double"
    listed = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).cast("string").alias("text")).filter("text IS NOT NULL")
    listed = (listed if nameless else listed.filter("id IS NOT NULL")).distinct()
    named = F.concat_ws(" ", F.coalesce(F.col("id").cast("string"), F.lit("none")), "text")
    listed = listed.withColumn("key", F.sha2(named.cast("binary"), 256))
    passes, below = [], None
    while not passes or below is not None:
        part = (listed if below is None else listed.filter(F.col("key") > below)).orderBy("key").limit(items).collect()
        below = part[-1]["key"] if len(part) == items else None
        passes.append(whole.mapInArrow(_pass([(r["id"], r["text"]) for r in part], radius, threshold), schema))
    out = passes[0]
    for more in passes[1:]:
        out = out.unionByName(more)
    return out


def _pass(items: list[tuple[int | None, str]], radius: int, threshold: float):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index([(k, value) for k, (_, value) in enumerate(items)], radius, threshold)
        for batch in batches:
            of, rows = [], []
            for i, value in enumerate(texts(batch)):
                for found in index.found(value):
                    of.append(i)
                    rows.append(found)
            at, first, n, score = zip(*rows) if rows else ((),) * 4
            item = [items[k][0] for k in at]
            own = [batch.column(c).take(pa.array(of, pa.int64())) for c in ("_row", "doc_id")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(item, pa.int64()), pa.array(first, pa.int32()), pa.array(n, pa.int32()), pa.array(score, pa.float64())],
                names=["_row", "doc_id", "item_id", "first_word", "n_words", "similarity"])

    return search


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
          radius: int = RADIUS, threshold: float = SIMILARITY, items: int = ITEMS) -> DataFrame:
    """``docs`` without the rows in which an item was found, items without an id included. Columns of any name come through.
    Rows are numbered and written once, so that the rows that go are the rows that were searched."""
    row = free(docs, "_row")
    whole = numbered(docs, row)
    looked = whole.select(F.col(row).alias("_row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    rows = _leaks(looked, benchmark, item_id, item_text, radius, threshold, items, True).select(F.col("_row").alias(row)).distinct()
    return whole.join(rows, row, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
