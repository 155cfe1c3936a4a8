"""Best-two-fit packing of token sequences.

Lengths are whole numbers from 1 to the capacity, so how to fill sequences depends on the histogram of lengths alone: at
most ``capacity`` counts, whatever the number of documents. The plan is made over that histogram, as filling patterns with
a number of repetitions; the pieces themselves stay on the executors and compute their place from their length and their
rank among the pieces of that length.
"""

from __future__ import annotations

import bisect
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterlake.llm.common import staged, texts, with_row

CAPACITY = 2048
#: Entries of each half of a memory; the older half goes when the newer one is full.
_REMEMBERED = 400_000
#: Chunks whose lower case and normal form are plain, and which hold neither an apostrophe nor the start of a special token.
_PLAIN = "[!-&(-;=-~À-ÖØ-öø-ÿ]+"
_RUN = "([a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+)"
#: Bytes of text that are encoded at once.
_AT_ONCE = 4 << 20


class Memory:
    """Two dictionaries: what is found in the older one moves to the newer, what is not asked for is forgotten."""

    def __init__(self, size: int = _REMEMBERED):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys: Iterable[str]) -> list[str]:
        """Keys that have to be made. All others are in the newer half afterwards; those made must be put there."""
        if len(self.new) > self.size:
            self.new, self.old = {}, self.new
        new, old, out = self.new, self.old, []
        for key in keys:
            if key not in new:
                value = old.get(key)
                if value is None:
                    out.append(key)
                else:
                    new[key] = value
        return out


class Encoder:
    """Token ids of whole texts, as little-endian unsigned 32-bit numbers.

    The tokenizer drops white space and never merges across it, so ids are looked up by space-separated chunk. A plain
    chunk is put together from its runs of letters, digits and signs, between which the tokenizer does not merge either; only
    runs not met before, and chunks that are not plain, go through the tokenizer. Chunks and runs are found and told apart for
    many texts at once; every different one is looked up once, and the ids are put together by their places.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.chunks, self.runs = Memory(_REMEMBERED // 4), Memory()

    def _made(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids by the whole tokenizer."""
        for at in range(0, len(texts), 20_000):
            part = texts[at : at + 20_000]
            for text, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                yield text, struct.pack(f"<{len(got.ids)}I", *got.ids)

    def _whole(self, chunks: list[str]) -> list[bytes]:
        """Ids of different chunks that are not plain."""
        missing = self.chunks.missing(chunks)
        self.chunks.new.update(self._made(missing))
        return [self.chunks.new[c] for c in chunks]

    def _merged(self, runs: list[str]) -> list[bytes]:
        """Ids of different runs."""
        missing = self.runs.missing(runs)
        known, merge, rest = self.runs.new, self.tokenizer.model.tokenize, []
        for run in missing:
            if run.isascii():  # stands for itself in a byte-level vocabulary, so only the merges are left to do
                ids = [token.id for token in merge(run)]
                known[run] = struct.pack(f"<{len(ids)}I", *ids)
            else:
                rest.append(run)
        known.update(self._made(rest))
        return [known[r] for r in runs]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        plain = pc.match_substring_regex(coded.dictionary, f"^{_PLAIN}$").to_numpy(zero_copy_only=False)
        spaced = pc.replace_substring_regex(pc.utf8_lower(coded.dictionary.filter(pa.array(plain))), _RUN, r"\1 ")
        parts = pc.split_pattern(pc.utf8_rtrim(spaced, " "), " ")
        runs = parts.flatten().dictionary_encode()
        ids, sizes = _gathered(runs.indices.to_numpy(), self._merged(runs.dictionary.to_pylist()))
        others = self._whole(coded.dictionary.filter(pa.array(~plain)).to_pylist())
        lengths, starts = np.empty(len(plain), np.int64), np.empty(len(plain), np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes)))[parts.offsets.to_numpy()]
        starts[plain], lengths[plain] = ends[:-1], np.diff(ends)
        lengths[~plain] = np.fromiter(map(len, others), np.int64, len(others)) >> 2
        starts[~plain] = len(ids) + np.cumsum(lengths[~plain]) - lengths[~plain]
        out, each = _placed(coded.indices.to_numpy(), np.concatenate((ids, np.frombuffer(b"".join(others), "<u4"))), starts, lengths)
        bounds = (np.concatenate(([0], np.cumsum(each)))[split.offsets.to_numpy()] * 4).tolist()
        whole = memoryview(out.tobytes())
        return [bytes(whole[a:b]) for a, b in zip(bounds, bounds[1:])]


def _placed(which: np.ndarray, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` that ``which`` names, one after the other, and how long each is."""
    each = lengths[which]
    before = np.cumsum(each) - each
    return flat[np.arange(each.sum()) + np.repeat(starts[which] - before, each)], each


def _gathered(which: np.ndarray, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``data`` in the order that ``which`` gives, and how many each has."""
    lengths = np.fromiter(map(len, data), np.int64, len(data)) >> 2
    return _placed(which, np.frombuffer(b"".join(data), "<u4"), np.cumsum(lengths) - lengths, lengths)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 0, doc_id: str = "doc_id",
           text: str = "text", ids: bool = False) -> DataFrame:
    """One row for each piece: the document's ids and the end id, cut every ``capacity`` ids.

    A null or empty text is the end id alone. Repeated rows are packed each on their own; a null id stays null. A text of any
    length is encoded whole; short ones are encoded some megabytes at a time. An empty table has no pieces. ``_row`` numbers
    the input rows. ``ids`` adds the ids themselves as a binary column.
    """
    whole = with_row(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")))
    schema = "_row long, doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if ids else "")
    step, last = 4 * capacity, np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for whole_batch in batches:
            for batch in _some_at_once(whole_batch):
                of, numbers, starts, parts = [], [], [], []
                for row, data in enumerate(encode(list(texts(batch)))):
                    data += last
                    for number, at in enumerate(range(0, len(data), step)):
                        of.append(row)
                        numbers.append(number)
                        starts.append(at // 4)
                        parts.append(data[at : at + step])
                columns = [*[batch.column(c).take(pa.array(of, pa.int64())) for c in ("_row", "doc_id")], pa.array(numbers, pa.int32()), pa.array(starts, pa.int64()),
                           pa.array([len(p) // 4 for p in parts], pa.int64()), pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = ["_row", "doc_id", "piece", "start", "length", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + ([pa.array(parts, pa.binary())] if ids else []), names=names + (["ids"] if ids else []))

    return whole.mapInArrow(cut, schema)


def _some_at_once(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose texts make up some megabytes, at least one row at a time."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        upto = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _AT_ONCE, "right")))
        yield batch.slice(at, upto - at)
        at = upto


def _best_pair(lengths: list[int], room: int, counts: dict[int, int], least: int) -> tuple[int, int] | None:
    """Two unpacked lengths whose sum comes closest to ``room`` without passing it and is more than ``least``."""
    best, pair = least, None
    low, high = 0, bisect.bisect_right(lengths, room) - 1
    while low <= high:
        both = lengths[low] + lengths[high]
        if both > room:
            high -= 1
            continue
        if both > best and (low != high or counts[lengths[low]] > 1):
            best, pair = both, (lengths[high], lengths[low])
            if best == room:
                break
        low += 1
    return pair


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Filling patterns over a histogram of lengths: (lengths in one sequence, number of such sequences).

    A sequence opens with the longest length left and greedily takes the longest that fits. Then its smallest piece is
    exchanged for two unpacked ones whenever they fill the gap, widened by that piece, more tightly. The finished pattern
    is repeated as often as the counts allow.
    """
    counts = {k: n for k, n in histogram.items() if n > 0}
    lengths = sorted(counts)
    made: list[tuple[list[int], int]] = []

    def take(length: int) -> None:
        counts[length] -= 1
        if not counts[length]:
            del counts[length]
            del lengths[bisect.bisect_left(lengths, length)]

    def give(length: int, n: int = 1) -> None:
        if length not in counts:
            bisect.insort(lengths, length)
        counts[length] = counts.get(length, 0) + n

    while lengths:
        held, gap = [], capacity
        while lengths and lengths[0] <= gap:
            length = lengths[bisect.bisect_right(lengths, gap) - 1]
            held.append(length)
            gap -= length
            take(length)
        while gap and len(held) > 1 and (pair := _best_pair(lengths, gap + held[-1], counts, held[-1])):
            smallest = held.pop()
            for length in pair:
                take(length)
            give(smallest)
            held = sorted([*held, *pair], reverse=True)
            gap = capacity - sum(held)
        use = {length: held.count(length) for length in held}
        again = min(counts.get(length, 0) // n for length, n in use.items())
        for length, n in use.items():
            if again:
                counts[length] -= again * n
                if not counts[length]:
                    del counts[length]
                    del lengths[bisect.bisect_left(lengths, length)]
        made.append((held, again + 1))
    return made


def _layout(patterns: list[tuple[list[int], int]]) -> pd.DataFrame:
    """Which ranks of a length go where: from rank ``first`` on, ``uses`` to a sequence, sequences from ``sequence``."""
    rows, taken, sequence = [], {}, 0
    for held, times in patterns:
        offset = 0
        for length in sorted(set(held), reverse=True):
            uses = held.count(length)
            rows.append((length, taken.get(length, 0), uses, sequence, offset))
            taken[length] = taken.get(length, 0) + uses * times
            offset += uses * length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "uses", "sequence", "offset"], dtype="int64").sort_values(["length", "first"], ignore_index=True)


def ranked(rows: DataFrame, key: str) -> DataFrame:
    """``_rank`` from 0 among the rows of a key, without gathering a key: rows are ranked inside their partition, and
    what earlier partitions hold is summed over counts. ``rows`` must be staged, so that its partitions are files."""
    placed = rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    inside = placed.withColumn("_in", F.row_number().over(Window.partitionBy("_part", key).orderBy("_at")) - 1)
    counts = placed.groupBy("_part", key).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("_part", key, F.coalesce(before, F.lit(0)).alias("_before"))
    return inside.join(offsets, ["_part", key]).withColumn("_rank", F.col("_before") + F.col("_in")).drop("_part", "_at", "_in", "_before")


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``. Every row is placed, equal
    rows one by one; an empty table gives an empty result. ``cut`` is written once, so tokens are made once."""
    held = staged(cut)
    histogram = {r["length"]: r["n"] for r in held.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # <= capacity rows
    layout = _layout(plan(histogram, capacity))
    by_length = {k: tuple(part[c].to_numpy() for c in ("first", "uses", "sequence", "offset")) for k, part in layout.groupby("length")}

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, offset = np.zeros(len(batch), "int64"), np.zeros(len(batch), "int64")
            lengths, ranks = batch["length"].to_numpy(), batch.pop("_rank").to_numpy()
            for length in np.unique(lengths):
                own = np.flatnonzero(lengths == length)
                first, uses, begins, places = by_length[int(length)]
                at = np.searchsorted(first, ranks[own], "right") - 1
                times, nth = np.divmod(ranks[own] - first[at], uses[at])
                sequence[own], offset[own] = begins[at] + times, places[at] + nth * length
            yield batch.assign(sequence_id=sequence, offset=offset)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema) + ", sequence_id long, offset long"
    return ranked(held, "length").select(*held.columns, "_rank").mapInPandas(put, schema)
