"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform) turns a unit vector, and the signed axis nearest
to the result is its cell; finer cells are tuples of such axes. Several tables, each with rotations of its own, put every vector
into one cell each. A query looks into the cells whose axes it is nearest to, the best over all tables first; everything in
them is compared with it exactly, in double precision.

Inner products are turned into angles first: vectors are divided by the largest norm and given one more coordinate that fills
them up to unit length; where all norms are equal that coordinate is nothing and is left out.

How many cells a query looks into is found on a bounded sample of queries, whose true neighbours come from a pass over all
vectors: the fewest cells with which the sample finds ``target`` of them. A bucket holds as many vectors as fall into it. It is
written as blocks of a bounded number, queries likewise, and blocks meet blocks of one cell; none is cut off.

Defined results: vectors that are null, zero, hold a null or a component that is not finite, or are not of the commonest length,
take no part, and neither do rows without an id. Equal vectors are hashed and compared once; as only the smallest ids among
them can be among the nearest, one more than asked for is remembered. Rows equal in id and vector are one; several vectors under
one id are rows of their own, as candidates and as queries. Equal products are in order of id. An empty table, or none with a
query, gives no rows. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import stored

NEAREST = 20
TABLES = 4
#: Vectors of a cell, on average, from which on cells are made finer.
CELL = 8_192
BLOCK, QUERY_BLOCK = 2_048, 512
#: Queries on which the number of cells is found, and the share of their true neighbours it must reach.
SAMPLE, TARGET = 256, 0.95
#: The first of so many parts of a query's cells give its floor: what is farther than the worst it needs is not handed over.
NEARBY = 8
SEED = 42
#: Axes of one part that are looked at when cells have two parts, three parts, more.
_AXES = {2: 48, 3: 16}
_CHUNK = 32 << 20


@dataclass(frozen=True)
class Shape:
    """Everything a task needs to hash: length and type of the vectors, the largest norm if norms differ, parts of a cell."""

    size: int
    kind: str
    norm: float
    filled: bool
    parts: int
    tables: int
    seed: int = SEED

    @property
    def turned(self) -> int:
        return 1 << max(0, (self.size + self.filled - 1).bit_length())

    def signs(self) -> np.ndarray:
        return np.random.default_rng(self.seed).choice([-1.0, 1.0], (self.tables, self.parts, 3, self.turned))

    def vectors(self, data: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(data), self.kind).reshape(len(data), self.size).astype("float64")

    def unit(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Unit vectors whose angles are in order of inner products with any query."""
        out = np.zeros((len(x), self.turned))
        if query or not self.filled:
            out[:, : self.size] = x / np.linalg.norm(x, axis=1)[:, None]
            return out
        scaled = x / self.norm
        out[:, : self.size] = scaled
        out[:, self.size] = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
        return out


def hadamard(x: np.ndarray) -> np.ndarray:
    """The transform along the rows, of unit scale."""
    n, step = x.shape[1], 1
    while step < n:
        pairs = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        step *= 2
    return x / math.sqrt(n)


def _axes(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """How near each row is to each signed axis after a pseudo-rotation: the axes, then their opposites."""
    for flip in signs:
        x = hadamard(x * flip)
    return np.concatenate([x, -x], axis=1)


def homes(shape: Shape, x: np.ndarray) -> np.ndarray:
    """The cell of each row in each table."""
    unit, out = shape.unit(x, False), np.zeros((len(x), shape.tables), "int64")
    for table, parts in enumerate(shape.signs()):
        for signs in parts:
            out[:, table] = out[:, table] * 2 * shape.turned + _axes(unit, signs).argmax(axis=1)
    return out


def probes(shape: Shape, x: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The cells of all tables, nearest first: (tables, cells), ``most`` of them for each row."""
    unit, all_tables, all_cells, all_near = shape.unit(x, True), [], [], []
    for table, parts in enumerate(shape.signs()):
        cells, near = np.zeros((len(x), 1), "int64"), np.zeros((len(x), 1))
        for signs in parts:
            axes = _axes(unit, signs)
            kept = min(_AXES.get(shape.parts, 6), axes.shape[1]) if shape.parts > 1 else axes.shape[1]
            best = np.argsort(-axes, axis=1, kind="stable")[:, :kept]
            value = np.take_along_axis(axes, best, 1)
            cells = (cells[:, :, None] * 2 * shape.turned + best[:, None, :]).reshape(len(x), -1)
            near = (near[:, :, None] + value[:, None, :]).reshape(len(x), -1)
        all_tables.append(np.full(cells.shape, table))
        all_cells.append(cells)
        all_near.append(near)
    tables, cells, near = (np.concatenate(a, axis=1) for a in (all_tables, all_cells, all_near))
    order = np.argsort(-near, axis=1, kind="stable")[:, :most]
    return np.take_along_axis(tables, order, 1), np.take_along_axis(cells, order, 1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, added from the first component to the last, so that equal vectors give equal numbers."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


# rows that take part


def _clean(vectors: DataFrame, vec_id: str, vector: str, queries: Column) -> tuple[DataFrame, int, str] | None:
    """``vec_id``, ``asks``, ``digest``, ``vector`` and ``norm`` of the rows that take part, written."""
    element = vectors.schema[vector].dataType.elementType.simpleString()
    kind, arrow = ("<f4", pa.float32()) if element == "float" else ("<f8", pa.float64())
    held = F.col(f"`{vector}`").cast("array<float>" if kind == "<f4" else "array<double>")
    lengths = vectors.select(F.size(held).alias("n")).filter("n > 0").groupBy("n").agg(F.count(F.lit(1)).alias("rows"))
    commonest = lengths.orderBy(F.desc("rows"), F.desc("n")).first()
    if commonest is None:
        return None
    size = commonest["n"]
    asked = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.coalesce(queries, F.lit(False)).alias("asks"), held.alias("vector"))

    def sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            flat = pc.fill_null(pc.list_flatten(column).cast(arrow), float("nan")).to_numpy(zero_copy_only=False)
            matrix = flat.reshape(-1, size) + 0.0  # one zero, not two
            wide = matrix.astype("float64")
            good = np.flatnonzero(np.isfinite(wide).all(axis=1) & wide.any(axis=1))
            data = [matrix[i].astype(kind).tobytes() for i in good]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(pa.array(good)) for c in ("vec_id", "asks")], pa.array([hashlib.sha256(x).digest()[:16] for x in data], pa.binary()),
                 pa.array(data, pa.binary()), pa.array(np.linalg.norm(wide[good], axis=1))], names=["vec_id", "asks", "digest", "vector", "norm"])

    fit = asked.filter(F.col("vec_id").isNotNull() & (F.size("vector") == size))
    return stored(fit.mapInArrow(sound, "vec_id long, asks boolean, digest binary, vector binary, norm double")), size, kind


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """One row for each different vector, written: ``rep``, the ``k + 1`` smallest ids that have it, the vector, its norm and
    whether it is asked for. Ids are cut in every task before they meet, so copies of a third of all rows are no group."""
    smallest = Window.partitionBy("digest").orderBy("vec_id")
    named = rows.select("digest", "vec_id").distinct().withColumn("_nth", F.row_number().over(smallest)).filter(F.col("_nth") <= k + 1)
    ids = named.groupBy("digest").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    each = rows.groupBy("digest").agg(F.first("vector").alias("vector"), F.max("norm").alias("norm"), F.bool_or("asks").alias("asks"))
    return stored(each.join(ids, "digest").withColumn("rep", F.monotonically_increasing_id()).withColumn("first_id", F.col("ids")[0]))


# candidates


def _blocks(rows: DataFrame, block: int, beside: str) -> DataFrame:
    """Rows (``table``, ``cell``, ``rep``, ``beside``, ``vector``) as written blocks of at most ``block`` rows of one cell. The range
    partitioning is by cell and row, so that a full cell is dealt to many tasks."""
    kind = "<f8" if beside == "floor" else "<i8"

    def build(at: tuple, held: list[tuple]) -> pa.RecordBatch:
        cells = [np.array([h[0] for h in held], "<i8").tobytes(), np.array([h[1] for h in held], kind).tobytes(), b"".join(h[2] for h in held)]
        return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int64()), *[pa.array([x], pa.binary()) for x in cells]],
                                          names=["table", "cell", "reps", f"{beside}s", "vectors"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            for table, cell, *row in zip(*[batch.column(c).to_pylist() for c in ("table", "cell", "rep", beside, "vector")]):
                if held and ((table, cell) != at or len(held) >= block):
                    yield build(at, held)
                    held = []
                at = (table, cell)
                held.append(row)
        if held:
            yield build(at, held)

    spread = rows.repartitionByRange("table", "cell", "rep").sortWithinPartitions("table", "cell")
    return stored(spread.select("table", "cell", "rep", beside, "vector").mapInArrow(cut, f"table int, cell long, reps binary, {beside}s binary, vectors binary"))


def _placed(reps: DataFrame, shape: Shape) -> DataFrame:
    """Each vector in its cell of every table."""
    return _dealt(reps, shape, "first_id", shape.tables, lambda x: (np.broadcast_to(np.arange(shape.tables), (len(x), shape.tables)), homes(shape, x)))


def _looking(reps: DataFrame, shape: Shape, skip: int, most: int) -> DataFrame:
    """Each query in the cells it looks into, nearest first: from the ``skip``th to the ``most``th."""
    return _dealt(reps, shape, "floor", most - skip, lambda x: tuple(a[:, skip:] for a in probes(shape, x, most)))


def _dealt(reps: DataFrame, shape: Shape, beside: str, fan: int, cells_of: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """A row for each vector and cell; a batch is taken in steps, as it grows by ``fan``."""
    step = max(1, _CHUNK // (fan * max(64, shape.size * 8)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                batch = whole.slice(at, step)
                tables, cells = cells_of(shape.vectors(batch.column("vector").to_pylist()))
                of = pa.array(np.repeat(np.arange(batch.num_rows), cells.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(tables.reshape(-1).astype("int32")), pa.array(cells.reshape(-1)), *[batch.column(c).take(of) for c in ("rep", beside, "vector")]],
                                                 names=["table", "cell", "rep", beside, "vector"])

    kind = "double" if beside == "floor" else "long"
    return reps.select("rep", beside, "vector").mapInArrow(place, f"table int, cell long, rep long, {beside} {kind}, vector binary")


def _nearest(asked: np.ndarray, held: np.ndarray, firsts: np.ndarray, k: int, floors: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The nearest ``k`` of ``held`` for each row of ``asked``, of those that reach its floor: rows, exact products, first ids and
    columns. The matrix product only chooses; what it may be off by is allowed for."""
    rough = asked @ held.T
    edge = np.full(len(asked), -np.inf) if floors is None else floors
    if held.shape[0] > k:
        edge = np.maximum(edge, np.partition(rough, held.shape[0] - k, axis=1)[:, held.shape[0] - k])
    slack = 1e-12 * held.shape[1] * np.linalg.norm(asked, axis=1) * np.linalg.norm(held, axis=1).max()
    row, column = np.nonzero(rough >= (edge - slack)[:, None])
    score = products(asked[row], held[column])
    if floors is not None:
        row, column, score = (a[score >= floors[row]] for a in (row, column, score))
    return _cut(row, score, firsts[column], column, k)


def _cut(query: np.ndarray, score: np.ndarray, first: np.ndarray, other: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best (score, then smallest id) of each query."""
    order = np.lexsort((other, first, -score, query))
    query, score, first, other = query[order], score[order], first[order], other[order]
    begins = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, int)
    kept = np.arange(len(query)) - np.repeat(begins, np.diff(np.r_[begins, len(query)])) < k
    return query[kept], score[kept], first[kept], other[kept]


_PAIRS = "query long, score double, first_id long, rep long"


def _compared(pairs: DataFrame, shape: Shape, k: int) -> DataFrame:
    """The best of each task for each query of the block pairs it is given."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def best() -> tuple[np.ndarray, ...]:
            query, score, first, rep = (np.concatenate(c) for c in zip(*held))
            _, once = np.unique(np.stack([query, rep]), axis=1, return_index=True)  # found in several tables
            return _cut(query[once], score[once], first[once], rep[once], k)

        def out(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "score", "first_id", "rep"])

        for batch in batches:
            for row in batch.to_pylist():
                asked, there = (np.frombuffer(row[c], shape.kind).reshape(-1, shape.size).astype("float64") for c in ("asked", "vectors"))
                reps, firsts, queries = (np.frombuffer(row[c], "<i8") for c in ("reps", "first_ids", "queries"))
                q, score, first, column = _nearest(asked, there, firsts, k, np.frombuffer(row["floors"], "<f8"))
                held.append((queries[q], score, first, reps[column]))
            if sum(len(h[0]) for h in held) > 1_000_000:
                held = [best()]
                if len(held[0][0]) > 500_000:  # too many queries for one memory: hand over what there is
                    yield out(held.pop())
        if held:
            yield out(best())

    return pairs.mapInArrow(compare, _PAIRS)


def _found(held: DataFrame, asked: DataFrame, shape: Shape, k: int) -> DataFrame:
    """What the queries of ``asked`` find in the blocks of the cells they look into."""
    there = asked.select("table", "cell", F.col("reps").alias("queries"), F.col("vectors").alias("asked"), "floors")
    return _compared(held.join(there, ["table", "cell"]).drop("table", "cell"), shape, k)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """``query`` and its ``k`` best ``found``, in order; what tables and tasks have found of a query is bounded by the cells it
    looked into."""
    each = F.struct((-F.col("score")).alias("minus"), "first_id", "rep")
    return found.groupBy("query").agg(F.slice(F.array_sort(F.collect_set(each)), 1, k).alias("found"))


# how many cells


def true_neighbours(reps: DataFrame, shape: Shape, numbers: list[int], asked: np.ndarray, k: int) -> DataFrame:
    """The nearest of all vectors to a bounded sample of queries: (query, score, first_id, rep), the sample's own rows included."""
    reached = np.array(numbers, "int64")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, firsts = (batch.column(c).to_numpy() for c in ("rep", "first_id"))
            q, score, first, column = _nearest(asked, shape.vectors(batch.column("vector").to_pylist()), firsts, k)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (reached[q], score, first, reps[column])], names=["query", "score", "first_id", "rep"])

    return reps.select("rep", "first_id", "vector").mapInArrow(scan, _PAIRS)


def calibrate(reps: DataFrame, shape: Shape, k: int, target: float = TARGET, sample: int = SAMPLE) -> tuple[Shape, int, float]:
    """The shape, the number of cells a query looks into, and the share of the sample's true neighbours found with it.

    The sample are the ``sample`` queries of the least hash; their neighbours come from all vectors. Where the cells that a query
    can look into do not reach the target, cells are made coarser; cells of one part can all be looked into, which is exact.
    """
    chosen = reps.filter("asks").orderBy(F.xxhash64("rep"), "rep").limit(sample).select("rep", "vector").collect()  # bounded by sample
    numbers, asked = [r["rep"] for r in chosen], shape.vectors([r["vector"] for r in chosen])
    best = _merged(true_neighbours(reps, shape, numbers, asked, k + 1), k + 1).select("query", F.explode("found.rep").alias("rep"))
    rows = best.filter("query <> rep").join(reps.select("rep", "vector"), "rep").select("query", "vector").collect()  # sample times k
    near, of = shape.vectors([r["vector"] for r in rows]), np.array([numbers.index(r["query"]) for r in rows], int)
    while True:
        cells, ranks = homes(shape, near) if len(rows) else np.empty((0, shape.tables)), []
        tables, looked = probes(shape, asked)
        for i in range(len(rows)):
            hit = np.flatnonzero(cells[i][tables[of[i]]] == looked[of[i]])
            ranks.append(int(hit[0]) if len(hit) else looked.shape[1])
        if not ranks:
            return shape, 1, 1.0
        ranks = np.sort(ranks)
        most = min(looked.shape[1], int(ranks[min(len(ranks), math.ceil(target * len(ranks))) - 1]) + 1)
        recall = float((ranks < most).mean())
        if recall >= target or shape.parts == 1:
            return shape, most, recall
        shape = Shape(shape.size, shape.kind, shape.norm, shape.filled, shape.parts - 1, shape.tables, shape.seed)


def nearest(vectors: DataFrame, queries: Column, k: int = NEAREST, vec_id: str = "vec_id", vector: str = "embedding", tables: int = TABLES,
            target: float = TARGET, sample: int = SAMPLE, cell: int = CELL, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """For each row that ``queries`` holds for, the ``k`` other rows of the largest inner product: ``query_id``, ``rank`` from 1,
    ``vec_id``, ``score``."""
    spark: SparkSession = vectors.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cleaned = _clean(vectors, vec_id, vector, queries)
    if cleaned is None:
        return empty
    rows, size, kind = cleaned
    reps = _distinct(rows, k)
    n, asks, least, norm = reps.agg(F.count(F.lit(1)), F.count_if("asks"), F.min("norm"), F.max("norm")).first()
    if not asks:
        return empty
    filled = least < norm * (1 - 1e-6)
    wide = 2 << max(0, (size + filled - 1).bit_length())
    parts = max(1, math.ceil(math.log(max(1, n / cell)) / math.log(wide)))
    shape, most, _ = calibrate(reps, Shape(size, kind, norm, filled, parts, tables), k, target, sample)
    held = _blocks(_placed(reps, shape), block, "first_id")
    asked = reps.filter("asks").withColumn("floor", F.lit(float("-inf")))
    nearby = max(1, most // NEARBY)
    early = stored(_merged(_found(held, _blocks(_looking(asked, shape, 0, nearby), query_block, "floor"), shape, k + 1), k + 1))
    floors = early.filter(F.size("found") > k).select(F.col("query").alias("rep"), (-F.col("found")[k]["minus"]).alias("_floor"))
    rest = asked.join(floors, "rep", "left").withColumn("floor", F.coalesce("_floor", "floor"))
    found = early.select("query", F.explode("found").alias("f")).select("query", (-F.col("f.minus")).alias("score"), "f.first_id", "f.rep")
    if most > nearby:
        found = found.unionByName(_found(held, _blocks(_looking(rest, shape, nearby, most), query_block, "floor"), shape, k + 1))
    best = _merged(found, k + 1)
    named = best.select("query", F.explode("found").alias("f")).select("query", (-F.col("f.minus")).alias("score"), F.col("f.rep").alias("rep"))
    each = named.join(reps.select("rep", "ids"), "rep").select("query", F.explode("ids").alias("vec_id"), "rep", "score")
    lists = each.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id", "rep"))), 1, k + 1).alias("found"))
    asking = rows.filter("asks").select("digest", F.col("vec_id").alias("query_id")).distinct()
    numbered = asking.join(reps.filter("asks").select("digest", F.col("rep").alias("query")), "digest").select("query_id", "query")
    own = F.filter("found", lambda x: ~((x["vec_id"] == F.col("query_id")) & (x["rep"] == F.col("query"))))
    answers = stored(numbered).join(stored(lists), "query").select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "f"))
    return answers.select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.vec_id").alias("vec_id"), (-F.col("f.minus")).alias("score"))
