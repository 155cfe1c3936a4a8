"""What filters do to each other: every order of them, every step, from one pass over the texts.

Which filters a document fails is a mask. The outcome of all steps of all orders depends on that mask alone, so each mask
has one big integer whose fields, a fixed number of bits each, hold what a document with that mask adds to every counter of
every step. Adding the integers of a part's documents therefore counts all orders at once, and reading the fields of the sum
gives the table. A field is as wide as the number of documents needs, so that no sum runs into the next field.

Defined results: a null text is empty; repeated rows count each; a null source is the part with the empty name; a null
``doc_id`` is smaller than none and none is smaller, and has no label; of several labels of one id any counts; an empty
table has no parts and no rows. Texts of any length are read whole, in batches bounded by bytes. Columns besides the named
ones are not looked at, so their names may be anything.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import stored, texts

FILTERS = "ABCDE"
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
#: Counters of a step, each a field for every step of every order: 600 outcomes a counter.
COUNTERS = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
STEPS = len(ORDERS) * len(FILTERS)
#: One more field for each filter: documents that fail it and no other.
FIELDS = STEPS * len(COUNTERS) + len(FILTERS)
#: Partial sums of one part that meet in one place at most, before they are added again.
SPREAD = 64
_CAPITALS, _SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"#$%&*|"


def failing(text: str) -> int:
    """Bits of the filters A to D that a text fails. Words are runs of anything but space and the five control breaks."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    few = len(words) < 200
    poor = 100 * len(set(words)) < 50 * len(words)
    loud = 100 * (len(data) - len(data.translate(None, _CAPITALS))) > 2 * len(text)
    signs = len(data.translate(None, _SIGNS)) < len(data)
    return few | poor << 1 | loud << 2 | signs << 3


def examined(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One narrow row for each document: ``part``, ``doc_id``, the mask of A to D and a 256-bit digest of the text."""
    whole = docs.select(F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
                        F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks, digests = [], []
            for value in texts(batch):
                masks.append(failing(value))
                digests.append(hashlib.sha256(value.encode("utf-8", "surrogatepass")).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("part"), batch.column("doc_id"), pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
                names=["part", "doc_id", "mask", "digest"])

    return whole.mapInArrow(look, "part string, doc_id long, mask int, digest binary")


def masks(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part`` and the whole ``mask`` of each document: the five filters and the two label bits.

    A text's smallest id is found over map-side partials, so a text that a third of all rows hold moves one row a task. Both
    lookups join plain shuffles of written rows, which adaptive execution splits where a text or an id is hot.
    """
    seen = stored(examined(docs, doc_id, text, part))
    first = seen.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    later = stored(first.filter("last_id > first_id").select("digest", "first_id"))
    repeated = F.when(F.col("doc_id") > F.col("first_id"), 1 << FILTERS.index("E")).otherwise(0)
    out = seen.join(later, "digest", "left").select("part", "doc_id", F.col("mask").bitwiseOR(repeated).alias("mask"))
    if labels is None:
        return out.select("part", "mask")
    flags = F.when(F.col("quality") == 1, GOOD).otherwise(0).bitwiseOR(F.when(F.col("toxic") == 1, TOXIC).otherwise(0))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), flags.alias("flags")).filter("flags <> 0")
    known = stored(marked.groupBy("doc_id").agg(F.bit_or("flags").alias("flags")))
    return out.join(known, "doc_id", "left").select("part", F.col("mask").bitwiseOR(F.coalesce("flags", F.lit(0))).alias("mask"))


def outcomes(mask: int) -> Iterator[int]:
    """The fields to which a document with this mask adds one."""
    failed = {f for i, f in enumerate(FILTERS) if mask >> i & 1}
    for at, order in enumerate(ORDERS):
        here = next((i for i, f in enumerate(order) if f in failed), len(order))
        for step, name in enumerate(order):
            of = at * len(FILTERS) + step
            if step < here:
                yield of
            elif step == here:
                yield STEPS + of
                if mask & GOOD:
                    yield 3 * STEPS + of
                if mask & TOXIC:
                    yield 4 * STEPS + of
            elif name in failed:
                yield 2 * STEPS + of
    if len(failed) == 1:
        yield len(COUNTERS) * STEPS + FILTERS.index(*failed)


@lru_cache(maxsize=512)
def packed(mask: int, width: int) -> int:
    """The big integer of a mask."""
    bits = bytearray(FIELDS * width // 8 + 1)
    for field in outcomes(mask):
        bits[field * width >> 3] |= 1 << (field * width & 7)
    return int.from_bytes(bits, "little")


def unpacked(total: int, width: int) -> list[int]:
    """All fields of a sum."""
    digits = f"{total:0{FIELDS * width}b}"
    return [int(digits[at - width : at], 2) for at in range(len(digits), len(digits) - FIELDS * width, -width)]


def packed_sums(marked: DataFrame, width: int) -> DataFrame:
    """One big integer, as little-endian bytes, for each part: first over each task, then over ``SPREAD`` groups of a part,
    then over the part. No group holds more than the partial sums of its tasks, however many documents a part has."""
    size = FIELDS * width // 8 + 1

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, int] = {}

        def batch_of(sums: dict[str, int]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([x.to_bytes(size, "little") for x in sums.values()], pa.binary())],
                                              names=["part", "packed"])

        for batch in batches:
            for pair in pa.table({c: batch.column(c) for c in ("part", "mask")}).group_by(["part", "mask"]).aggregate([("mask", "count")]).to_pylist():
                sums[pair["part"]] = sums.get(pair["part"], 0) + pair["mask_count"] * packed(pair["mask"], width)
            if len(sums) > 1_000:  # many small parts: hand over what there is
                yield batch_of(sums)
                sums = {}
        yield batch_of(sums)

    def total(table: pa.Table) -> pa.Table:
        whole = sum(int.from_bytes(x.as_py(), "little") for x in table.column("packed"))
        return pa.table({"part": table.column("part").slice(0, 1), "packed": pa.array([whole.to_bytes(size, "little")], pa.binary())})

    partial = marked.mapInArrow(added, "part string, packed binary").withColumn("_spread", F.spark_partition_id() % SPREAD)
    return partial.groupBy("part", "_spread").applyInArrow(total, "part string, packed binary").groupBy("part").applyInArrow(total, "part string, packed binary")


def audit(docs: DataFrame, labels: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """For each part, order and step: documents kept after the step, removed here, failing here but removed before, failing
    this filter only, removed here though labelled good, removed here and labelled toxic, and the filter's removals summed
    over all orders (its Shapley value times the number of orders).

    The fields are as wide as the number of documents is long in binary: no counter can pass that number.
    """
    marked = stored(masks(docs, labels, doc_id, text, part))
    width = max(1, marked.count().bit_length())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = pa.array([o for o in ORDERS for _ in FILTERS])
        steps = pa.array([s + 1 for _ in ORDERS for s in range(len(FILTERS))], pa.int32())
        which = [FILTERS.index(f) for o in ORDERS for f in o]
        for batch in batches:
            for name, data in zip(batch.column("part"), batch.column("packed")):
                fields = unpacked(int.from_bytes(data.as_py(), "little"), width)
                counts = {c: fields[i * STEPS : (i + 1) * STEPS] for i, c in enumerate(COUNTERS)}
                alone, removed = fields[len(COUNTERS) * STEPS :], [0] * len(FILTERS)
                for f, n in zip(which, counts["removed"]):
                    removed[f] += n
                longs = [counts["kept"], counts["removed"], counts["redundant"], [alone[f] for f in which], counts["good_lost"], counts["toxic_lost"], [removed[f] for f in which]]
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * STEPS), orders, steps, *[pa.array(x, pa.int64()) for x in longs]],
                                                 names=["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])

    return packed_sums(marked, width).mapInArrow(
        read, "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long")
