"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are made in one pass over the texts. Equal fingerprints become one node. Distinct fingerprints are dealt to
tiles by their population count; two tiles are compared only if their counts differ by no more than the radius, with
exclusive-or and bit counts in numpy. Within a pair of tiles the same argument is used again on the counts of the four
16-bit quarters, whose differences add up to at most the distance. A pair of tiles reports the spanning forest of the
links it found, never all of them; connected components follow by contracting stars.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import free, numbered, small_batches, staged, with_row

RADIUS = 2
SHINGLE = 3
#: Fingerprints that one tile holds; a pair of tiles is two such arrays.
TILE = 32_768
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of the word shingles of a text, 0 without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], dtype="<u8")
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        set_in += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_in * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text: str = "text", into: str = "_fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long. Null and empty texts have fingerprint 0."""
    small_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def made(column: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in column], dtype="uint64").view("int64"))

    return docs.withColumn(into, made(F.col(text).cast("string")))


def _quarters(values: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters, as one number with a byte for each."""
    out = np.zeros(len(values), np.int64)
    for q in range(4):
        out |= np.bitwise_count((values >> np.uint64(16 * q)) & np.uint64(0xFFFF)).astype(np.int64) << (8 * q)
    return out


def _cells(values: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[int, int]]]:
    """Values in the order of their quarter counts, and where the values of each such cell lie."""
    keys = _quarters(values)
    order = np.argsort(keys, kind="stable")
    found, begins = np.unique(keys[order], return_index=True)
    return order, dict(zip(found.tolist(), zip(begins.tolist(), [*begins[1:].tolist(), len(values)])))


def _steps(radius: int) -> list[tuple[int, ...]]:
    """Differences of quarter counts that a distance within the radius allows."""
    out = [()]
    for _ in range(4):
        out = [(*s, d) for s in out for d in range(-radius, radius + 1) if sum(map(abs, s)) + abs(d) <= radius]
    return out


def links(left: np.ndarray, right: np.ndarray | None, radius: int, block: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in left, in right) of the fingerprints that differ in at most ``radius`` bits, in parts; ``right`` None:
    left with itself."""
    order, cells = _cells(left)
    other_order, other_cells = (order, cells) if right is None else _cells(right)
    a, b = left[order], (left if right is None else right)[other_order]
    steps = [sum(d << (8 * q) for q, d in enumerate(s)) for s in _steps(radius)]
    for key, (lo, hi) in cells.items():
        for step in steps:
            if right is None and step < 0 or key + step not in other_cells:
                continue
            from_, to = other_cells[key + step]
            for at in range(lo, hi, block):
                mine = a[at : min(at + block, hi), None]
                for bt in range(from_, to, block):
                    x, y = np.nonzero(np.bitwise_count(mine ^ b[None, bt : min(bt + block, to)]) <= radius)
                    if len(x):
                        yield order[x + at], other_order[y + bt]


def forest(found: Iterator[tuple[np.ndarray, np.ndarray]], n: int, at_once: int = 1_000_000) -> np.ndarray:
    """For each of ``n`` nodes the smallest node of its component. Links are folded in as they come, so however many
    there are, no more than ``at_once`` and one part are held."""
    root, xs, ys, held = np.arange(n), [], [], 0

    def fold() -> None:
        nonlocal root
        x, y = (np.concatenate(xs), np.concatenate(ys)) if xs else (root[:0], root[:0])
        while True:
            low = np.minimum(root[x], root[y])
            new = root.copy()
            np.minimum.at(new, root[x], low)
            np.minimum.at(new, root[y], low)
            while not np.array_equal(new, jumped := new[new]):
                new = jumped
            if np.array_equal(new, root):
                return
            root = new

    for x, y in found:
        xs.append(x)
        ys.append(y)
        held += len(x)
        if held > at_once:
            fold()
            xs, ys, held = [], [], 0
    fold()
    return root


def _compared(radius: int):
    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        values = group["_fp"].to_numpy().view("uint64")
        first = group["_first"].to_numpy()
        values = np.concatenate([values[first], values[~first]])
        split = int(first.sum())
        if key[0] == key[1]:
            found = links(values, None, radius)
        else:
            found = ((x, y + split) for x, y in links(values[:split], values[split:], radius))
        root = forest(found, len(values))
        child = np.flatnonzero(root != np.arange(len(values)))
        return pd.DataFrame({"u": values[child].view("int64"), "v": values[root[child]].view("int64")})

    return compare


def forests(nodes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``_fp`` that span the components of all pairs within the radius.

    A tile is a population count and a block, as many blocks as the count's fingerprints need, so no tile grows with the
    input. Every fingerprint goes once to each pair of tiles that its own tile belongs to.
    """
    counted = nodes.withColumn("_pop", F.bit_count("_fp").cast("int"))
    held = {r["_pop"]: r["n"] for r in counted.groupBy("_pop").agg(F.count(F.lit(1)).alias("n")).collect()}  # 65 rows at most
    blocks = F.create_map(*[F.lit(x) for p in range(-radius, 65 + radius) for x in (p, -(-held.get(p, 0) // tile))])
    own = blocks[F.col("_pop")]
    tiled = counted.withColumn("_block", F.pmod(F.xxhash64("_fp"), own).cast("int"))
    me = F.struct(F.col("_pop").alias("p"), F.col("_block").alias("b"))

    def others(step: int):
        """The pairs with the tiles of a count ``step`` away, the lower tile first."""
        there = (F.col("_pop") + step).cast("int")
        every = F.when(blocks[there] > 0, F.sequence(F.lit(0), blocks[there] - 1)).otherwise(F.array().cast("array<int>"))
        other = F.transform(every, lambda b: F.struct(there.alias("p"), b.cast("int").alias("b")))
        return F.transform(other, lambda o: F.struct(F.least(me, o).alias("_one"), F.greatest(me, o).alias("_two"), (me <= o).alias("_first")))

    pairs = reduce(lambda x, y: F.concat(x, y), [others(s) for s in range(-radius, radius + 1)])
    dealt = tiled.select("_fp", F.inline(pairs))
    return dealt.groupBy("_one", "_two").applyInPandas(_compared(radius), "u long, v long")


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one link, to a node that has none."""
    centres = links.select(F.col("v").alias("u")).distinct()
    several = links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
    return links.join(centres, "u", "left_semi").select("u").union(several).isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node of the links (u, v).

    Large stars and small stars in turn: each node hands its neighbours to the smallest it sees. Both steps are
    aggregations and one join; every round is staged, so a lost executor costs one round. Ends when only stars are left.
    """
    state = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    while not _are_stars(state):
        both = state.union(state.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("_low")).select("u", F.least("u", "_low").alias("_low"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("_low").alias("v")).distinct()
        own = large.groupBy("u").agg(F.min("v").alias("_low"))
        small = large.join(own, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("_low").alias("v")), F.struct(F.col("v").alias("u"), F.col("_low").alias("v")))).alias("e"))
        state = staged(small.select("e.u", "e.v").filter("u <> v").distinct())
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")).union(state.select("v", "v").distinct())


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: ``_row``, ``doc_id``, ``fingerprint`` (hex) and ``component_id``, the smallest id that
    can be reached over fingerprints within ``radius`` bits.

    Null and empty texts have fingerprint zero and link like any other. A null id is never the smallest; a component
    whose ids are all null has a null id. Repeated rows and repeated ids keep a row each. Texts of any length are
    fingerprinted whole. Other columns are not read. An empty table gives an empty result.
    """
    return _linked(with_row(docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))), shingle, radius)


def _linked(whole: DataFrame, shingle: int, radius: int) -> DataFrame:
    rows = staged(fingerprints(whole, shingle).drop("text"))
    nodes = staged(rows.groupBy("_fp").agg(F.min("doc_id").alias("_least")))
    linked = components(forests(nodes.select("_fp"), radius))
    rooted = nodes.join(linked, nodes["_fp"] == linked["node"], "left").select("_fp", "_least", F.coalesce("root", "_fp").alias("_root"))
    rooted = staged(rooted)
    least = rooted.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = rooted.join(least, "_root").select("_fp", "_root", "component_id")

    def shown(column: str) -> Column:
        return F.lower(F.lpad(F.hex(column), 16, "0"))

    return rows.join(named, "_fp").select("_row", "doc_id", shown("_fp").alias("fingerprint"), "component_id", shown("_root").alias("component_fingerprint"))


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the smallest id, and of repeated rows with that id the first.

    Columns of any name come through. Rows are numbered and written once, so that the rows kept are the rows that were
    compared, whatever becomes of the cluster in between."""
    row = free(docs, "_row")
    whole = numbered(docs, row)
    marked = _linked(whole.select(F.col(row).alias("_row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")), shingle, radius)
    ranked = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("_row"))
    kept = marked.groupBy("component_fingerprint").agg(F.min(ranked).alias("_kept")).select(F.col("_kept._row").alias(row))
    return whole.join(kept, row, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
