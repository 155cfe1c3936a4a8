"""Ranked lexical search over a length-stratified index.

What a term adds to a document's score depends on how often the document holds it and on the document's normaliser ``m``,
which depends on its length alone. Documents of one ``m`` are a stratum. Inside it a term's postings are in order of ``tf``,
the impact is worked out once for each ``tf``, and the impact of a term's largest ``tf``, summed over an item's terms, bounds
every score in the stratum. Strata are visited from the highest bound down, and not at all once the bound is under the worst of
the scores an item already has: no document that belongs in the list can be in them.

A stratum is written as blocks of a bounded number of postings, each with bounds of its own, so that a length which a third of
all documents share is many blocks. The highest bounds are looked up first, over all blocks; what they give is the floor that
every task starts from when it goes through its own blocks.

Items are taken in slices of a bounded number of terms. The index of a slice holds the postings of its terms only, from whole
texts; counts of documents and terms are over all documents.

Defined results: a null text has no term, and neither has one of separators alone; such documents are not counted, as the
ranking asks. Repeated rows are ranked each; a null ``doc_id`` comes after all others of its score. Every row of items is an
item of its own, also under a null or repeated id; one without a term that occurs gets no row. Empty tables give no rows.
Texts of any length are read whole, in batches bounded by bytes. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import stored, texts

BEST = 10
#: Postings of a block; one document is never parted.
BLOCK = 1 << 19
#: Terms, counted for each item, of a slice.
SLICE = 500_000
#: Blocks of an item that are visited before all others.
FIRST = 4
#: A-Z become a-z, everything in ASCII that is neither letter nor digit parts terms.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    """What a weight of one gives, once for each different ``tf``."""
    each, which = np.unique(tf, return_inverse=True)
    return (1_000_000_000 * each // (1000 * each + 8 * m))[which]


class Items:
    """The items of a slice as flat arrays: term numbers in order of item, where each item begins, ids and names."""

    def __init__(self, rows: list, vocabulary: dict[bytes, int]):
        kept = [(r["item"], r["item_id"], np.array(sorted({vocabulary[t] for t in r["terms"]}), "<i4")) for r in rows if r["terms"]]
        self.numbers, self.names = [k[0] for k in kept], [k[1] for k in kept]
        self.terms = np.concatenate([k[2] for k in kept]) if kept else np.empty(0, "<i4")
        self.begins = np.concatenate([[0], np.cumsum([len(k[2]) for k in kept])]).astype("int64")
        self.weights = np.zeros(len(self.terms), "int64")

    def __len__(self) -> int:
        return len(self.numbers)


class Block:
    """Postings of one stratum, or of a part of it."""

    def __init__(self, row: dict):
        self.m = row["m"]
        self.docs, self.none = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["none"], "?")
        self.terms, self.ends = np.frombuffer(row["terms"], "<i4"), np.frombuffer(row["ends"], "<i4")
        self.tf, self.at = np.frombuffer(row["tf"], "<i4").astype("int64"), np.frombuffer(row["at"], "<i4")
        self.impact = impacts(self.tf, self.m)

    def places(self, items: Items) -> np.ndarray:
        """For each term of each item its place among the block's terms, or -1."""
        at = np.minimum(np.searchsorted(self.terms, items.terms), len(self.terms) - 1)
        return np.where(self.terms[at] == items.terms, at, -1)

    def bounds(self, items: Items, places: np.ndarray) -> np.ndarray:
        """The most any document here can score, for each item: a term's last posting has its largest ``tf``."""
        most = np.where(places >= 0, self.impact[self.ends[places] - 1], 0)
        return np.add.reduceat(most * items.weights, items.begins[:-1])

    def scores(self, items: Items, item: int, places: np.ndarray) -> np.ndarray:
        """Scores of all documents here for one item."""
        out = np.zeros(len(self.docs), "int64")
        for k in range(items.begins[item], items.begins[item + 1]):
            if (place := places[k]) >= 0:
                own = slice(self.ends[place - 1] if place else 0, self.ends[place])
                out[self.at[own]] += items.weights[k] * self.impact[own]
        return out


class Best:
    """The highest scores of an item met so far: of equal ones those of the smaller ids, null ids last."""

    def __init__(self, n: int, floor: int = 0):
        self.n, self.floor = n, max(1, floor)
        self.score, self.none, self.doc = np.empty(0, "int64"), np.empty(0, "?"), np.empty(0, "int64")

    def take(self, scores: np.ndarray, none: np.ndarray, docs: np.ndarray) -> None:
        hits = np.flatnonzero(scores >= self.floor)
        if not len(hits):
            return
        score, gone, doc = (np.concatenate([a, b[hits]]) for a, b in ((self.score, scores), (self.none, none), (self.doc, docs)))
        order = np.lexsort((doc, gone, -score))[: self.n]
        self.score, self.none, self.doc = score[order], gone[order], doc[order]
        if len(order) == self.n:
            self.floor = max(self.floor, int(self.score[-1]))


def counted(docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document with a term: its length ``n`` and the numbers and counts of its terms in the vocabulary."""
    whole = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            of, lengths, numbers, counts = [], [], [], []
            for i, value in enumerate(texts(batch)):
                words = terms(value)
                if words:
                    found = Counter(words)
                    pairs = sorted((vocabulary[t], found[t]) for t in known & found.keys())
                    of.append(i)
                    lengths.append(len(words))
                    numbers.append(np.array([p[0] for p in pairs], "<i4").tobytes())
                    counts.append(np.array([p[1] for p in pairs], "<i4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(of, pa.int64())), pa.array(lengths, pa.int64()), pa.array(numbers, pa.binary()), pa.array(counts, pa.binary())],
                names=["doc_id", "n", "terms", "tf"])

    return whole.mapInArrow(count, "doc_id long, n long, terms binary, tf binary")


def holding(held: DataFrame, size: int) -> dict[int, int]:
    """In how many documents each term of the vocabulary is: one sum a task, then one for each term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, "int64")
        for batch in batches:
            numbers = np.frombuffer(b"".join(batch.column("terms").to_pylist()), "<i4")
            total += np.bincount(numbers, minlength=size)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])], names=["term", "df"])

    sums = held.select("terms").mapInArrow(count, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    return {r["term"]: r["df"] for r in sums.collect()}  # no more rows than the slice has terms


def index(held: DataFrame, documents: int, length: int, block: int = BLOCK) -> DataFrame:
    """Blocks in order of stratum, written. Documents without a term of the vocabulary are in none. The range
    partitioning is by stratum and row, so that a stratum with very many documents is dealt to many tasks."""
    placed = (held.filter("length(terms) > 0").withColumn("m", F.expr(f"100 - 90 + (90L * n * {documents}L) div {length}L"))
              .withColumn("_at", F.monotonically_increasing_id()).select("m", "_at", "doc_id", "terms", "tf")
              .repartitionByRange("m", "_at").sortWithinPartitions("m"))

    def build(m: int, rows: list[tuple]) -> pa.RecordBatch:
        sizes = np.array([len(r[1]) // 4 for r in rows])
        number, tf = (np.frombuffer(b"".join(r[k] for r in rows), "<i4") for k in (1, 2))
        at = np.repeat(np.arange(len(rows), dtype="<i4"), sizes)
        order = np.lexsort((tf, number))
        each, ends = np.unique(number, return_counts=True)
        cells = [np.array([r[0] or 0 for r in rows], "<i8"), np.array([r[0] is None for r in rows], "?"), each, np.cumsum(ends).astype("<i4"), tf[order], at[order]]
        return pa.RecordBatch.from_arrays([pa.array([m], pa.int64()), *[pa.array([c.tobytes()], pa.binary()) for c in cells]],
                                          names=["m", "docs", "none", "terms", "ends", "tf", "at"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, rows, postings = None, [], 0
        for batch in batches:
            for now, *row in zip(*[batch.column(c).to_pylist() for c in ("m", "doc_id", "terms", "tf")]):
                if rows and (now != m or postings >= block):
                    yield build(m, rows)
                    rows, postings = [], 0
                m = now
                rows.append(row)
                postings += len(row[1]) // 4
        if rows:
            yield build(m, rows)

    made = placed.mapInArrow(blocks, "m long, docs binary, none binary, terms binary, ends binary, tf binary, at binary")
    return stored(made.withColumn("block", F.monotonically_increasing_id()))


def _highest(blocks: DataFrame, items: Items, first: int) -> DataFrame:
    """For each item the ``first`` blocks of the highest bounds: (item, block), the best of a task, then of all."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bound, block = np.zeros((first, len(items)), "int64"), np.full((first, len(items)), -1, "int64")
        for batch in batches:
            for row in batch.to_pylist():
                held = Block(row)
                new = held.bounds(items, held.places(items))
                bound, block = np.vstack([bound, new[None]]), np.vstack([block, np.full((1, len(items)), row["block"])])
                order = np.argsort(-bound, axis=0, kind="stable")[:first]
                bound, block = np.take_along_axis(bound, order, 0), np.take_along_axis(block, order, 0)
        item = np.broadcast_to(np.arange(len(items)), bound.shape)
        met = bound > 0
        yield pa.RecordBatch.from_arrays([pa.array(x[met]) for x in (item, block, bound)], names=["item", "block", "bound"])

    best = Window.partitionBy("item").orderBy(F.desc("bound"), "block")
    rows = blocks.mapInArrow(look, "item long, block long, bound long").withColumn("_nth", F.row_number().over(best))
    return rows.filter(F.col("_nth") <= first).select("item", "block")


_FOUND = "item long, doc_id long, score long"


def _found(best: dict[int, Best]) -> pa.RecordBatch:
    rows = [(i, None if none else int(doc), int(score)) for i, b in best.items() for score, none, doc in zip(b.score, b.none, b.doc)]
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])


def _floors(blocks: DataFrame, items: Items, best: int, first: int) -> np.ndarray:
    """For each item the worst of its ``best`` scores in its highest blocks; zero if these have fewer."""
    wanted = stored(_highest(blocks, items, first)).groupBy("block").agg(F.collect_list("item").alias("items"))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held = Block(row)
                places = held.places(items)
                for i in row["items"]:
                    kept.setdefault(i, Best(best)).take(held.scores(items, i, places), held.none, held.docs)
        yield _found(kept)

    nth = Window.partitionBy("item").orderBy(F.desc("score"))
    rows = blocks.join(wanted, "block").mapInArrow(visit, _FOUND).withColumn("_nth", F.row_number().over(nth)).filter(F.col("_nth") <= best)
    floors = np.zeros(len(items), "int64")
    for r in rows.filter(F.col("_nth") == best).select("item", "score").collect():  # no more rows than items
        floors[r["item"]] = r["score"]
    return floors


def _visit_all(blocks: DataFrame, items: Items, floors: np.ndarray, best: int) -> DataFrame:
    """The best of each task for each item. Of the blocks of a batch an item's are visited by falling bound, and no more
    once a bound is under the item's floor, which rises with what is found."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {i: Best(best, int(floor)) for i, floor in enumerate(floors)}
        for batch in batches:
            held = [Block(row) for row in batch.to_pylist()]
            if not held:
                continue
            places = [b.places(items) for b in held]
            bounds = np.stack([b.bounds(items, p) for b, p in zip(held, places)])
            for i in np.flatnonzero(bounds.max(axis=0) >= floors):
                for k in np.argsort(-bounds[:, i], kind="stable"):
                    if bounds[k, i] < kept[i].floor:
                        break
                    kept[i].take(held[k].scores(items, i, places[k]), held[k].none, held[k].docs)
        yield _found(kept)

    return blocks.mapInArrow(visit, _FOUND)


def _slice(docs: DataFrame, rows: list, best: int, doc_id: str, text: str, block: int, first: int) -> DataFrame | None:
    """Ranked documents for the items of one slice."""
    spark = docs.sparkSession
    words = sorted({t for r in rows for t in r["terms"]})
    vocabulary = {bytes(t): i for i, t in enumerate(words)}
    items = Items([{"item": r["item"], "item_id": r["item_id"], "terms": [bytes(t) for t in r["terms"]]} for r in rows], vocabulary)
    if not len(items):
        return None
    held = stored(counted(docs, vocabulary, doc_id, text))
    documents, length = held.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not documents:
        return None
    df = holding(held, len(vocabulary))
    by_term = np.array([weight(documents, df.get(i, 0)) for i in range(len(vocabulary))], "int64")
    items.weights = by_term[items.terms]
    blocks = index(held, documents, length, block)
    found = _visit_all(blocks, items, _floors(blocks, items, best, first), best)
    named = spark.createDataFrame([(i, n) for i, n in enumerate(items.names)], "item long, item_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(named, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, best: int = BEST, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", slice_terms: int = SLICE, block: int = BLOCK, first: int = FIRST) -> DataFrame:
    """For each item the ``best`` documents with a score above zero: ``item_id``, ``rank`` from 1, ``doc_id``, ``score``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [sorted(set(terms(value))) for value in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), pa.array(lists, pa.list_(pa.binary()))], names=["item", "item_id", "terms"])

    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text"))
    asked = stored(numbered.mapInArrow(cut, "item long, item_id long, terms array<binary>").filter("size(terms) > 0"))
    slices = max(1, math.ceil((asked.agg(F.sum(F.size("terms"))).first()[0] or 0) / slice_terms))
    out = None
    for k in range(slices):
        rows = asked.filter(F.pmod(F.xxhash64("item"), F.lit(slices)) == k).orderBy("item").collect()  # about slice_terms terms
        part = _slice(docs, rows, best, doc_id, text, block, first)
        out = part if out is None else out if part is None else out.unionByName(part)
    return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long") if out is None else out
