"""Exact substring dedup over suffix order: every byte covered by a substring of ``length`` bytes that starts anywhere else.

The collection is split so that suffixes that can share ``length`` bytes meet, and only those. Every window of ``length``
bytes has an anchor: the ``SEED`` bytes in it with the least hash, the leftmost of equals. Equal windows have equal anchors
at equal offsets. Neighbouring windows with the same anchor form one short string (at most 2 * length - SEED bytes), so the
texts become a few short strings an anchor, and the multi-document construction of ``collection`` runs over blocks of whole
anchors: its rounds are bounded by the length of such a string instead of the longest document. What is exact by itself
needs no construction: an anchor found once repeats nothing, and strings that are equal repeat in full.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.collection import repeated_places
from rosterlake.llm.common import numbered, small_batches, stored

LENGTH = 200
SEED = 100
#: Bytes of a text looked at in one go; longer texts are cut with an overlap of one window.
STRETCH = 1 << 20
#: Bytes of strings that one construction takes; one anchor's strings stay together.
BLOCK = 512 << 10
#: Distinct strings of one anchor above which its windows are compared by digest in Spark instead.
CROWDED = 4_096
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def _hashes(data: np.ndarray, seed: int) -> np.ndarray:
    """A mixed 64-bit hash of the ``seed`` bytes from every place on."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
    out = (sums[seed:] - sums[:-seed]) * down[: len(data) - seed + 1]
    for shift, factor in ((32, 0xD6E8FEB86659FD93), (29, 0xBF58476D1CE4E5B9)):
        out = (out ^ (out >> np.uint64(shift))) * np.uint64(factor)
    return out ^ (out >> np.uint64(32))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from running minima within blocks in both directions."""
    n = len(values) - width + 1
    filled = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    filled[: len(values)] = values
    blocks = filled.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchored(data: bytes, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: first window, number of windows, hash of the anchor."""
    starts, counts, anchors = [], [], []
    for begin in range(0, max(0, len(data) - length + 1), STRETCH):
        part = np.frombuffer(data, np.uint8, min(STRETCH + length - 1, len(data) - begin), begin)
        hashes = _hashes(part, seed)
        keys = (hashes >> np.uint64(21) << np.uint64(21)) | np.arange(len(hashes), dtype=np.uint64)
        least = _sliding_least(keys, length - seed + 1)
        change = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        starts.append(change + begin)
        counts.append(np.diff(np.append(change, len(least))))
        anchors.append(hashes[(least[change] & np.uint64((1 << 21) - 1)).astype(np.int64)].view(np.int64))
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, none
    return np.concatenate(starts), np.concatenate(counts), np.concatenate(anchors)


def occurrences(whole: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """``_row``, ``start``, ``n`` windows, ``anchor`` and ``string``, a digest of the bytes from the first window to the
    end of the last. Anchor, number of windows and digest together stand for the bytes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for batch in batches:
            of, parts = [], ([], [], [], [])
            for i, value in enumerate(batch.column("text")):
                data = (value.as_py() or "").encode()
                starts, counts, anchors = anchored(data, length, seed)
                if len(starts):
                    of.append(np.full(len(starts), i))
                    ends = starts + counts + (length - 1)
                    digests = np.array([xxh3_64_intdigest(data[a:b]) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
                    for part, values in zip(parts, (starts, counts, anchors, digests.view(np.int64))):
                        part.append(values)
            if of:
                at = pa.array(np.concatenate(of))
                starts, counts, anchors, digests = (np.concatenate(p) for p in parts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_row").take(at), pa.array(starts), pa.array(counts.astype(np.int16)), pa.array(anchors), pa.array(digests)],
                    names=["_row", "start", "n", "anchor", "string"])

    return whole.mapInArrow(found, "_row long, start long, n short, anchor long, string long")


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole anchors together, as many as a construction takes. Rows come sorted by anchor."""
    held = None
    for batch in batches:
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        anchors = held["anchor"].to_numpy()
        cuts = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1  # the last anchor may go on
        upto = np.cumsum(held["bytes"].str.len().to_numpy())
        start = 0
        for cut, size in zip(cuts.tolist(), upto[cuts - 1].tolist()):
            if size - (upto[start - 1] if start else 0) >= BLOCK:
                yield held.iloc[start:cut]
                start = cut
        held = held.iloc[start:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def _shared_ahead(anchors: np.ndarray, parts: list[bytes]) -> np.ndarray:
    """For each part the longest start that it has in common with any other part of its anchor: the longest neighbours in
    sorted order have."""
    order = sorted(range(len(parts)), key=lambda i: (anchors[i], parts[i]))
    wide = np.empty((len(parts), max(map(len, parts), default=0) + 1), np.uint8)
    wide[::2], wide[1::2] = 0xFF, 0xFE  # neither is in a UTF-8 text, so ends never agree
    for row, i in enumerate(order):
        wide[row, : len(parts[i])] = np.frombuffer(parts[i], np.uint8)
    same = np.argmax(wide[1:] != wide[:-1], axis=1)
    same[anchors[order][1:] != anchors[order][:-1]] = 0
    out = np.empty(len(parts), np.int64)
    out[order] = np.maximum(np.append(same, 0), np.insert(same, 0, 0))
    return out


def _clipped(anchors: np.ndarray, strings: list[bytes], length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The stretch of each string that any other string of its anchor can repeat: the anchor, and on either side as much as
    it shares with the one that agrees longest. Empty where that is shorter than ``length``."""
    ends = np.cumsum([len(x) for x in strings])
    starts = ends - np.diff(ends, prepend=0)
    hashes = _hashes(np.frombuffer(b"".join(strings), np.uint8), seed).view(np.int64)
    hits = np.flatnonzero(hashes == np.repeat(anchors, ends - starts)[: len(hashes)])
    at = hits[np.searchsorted(hits, starts)] - starts  # the anchor is the leftmost of its kind in every window
    left = at - _shared_ahead(anchors, [x[:p][::-1] for x, p in zip(strings, at.tolist())])
    right = at + seed + _shared_ahead(anchors, [x[p + seed :] for x, p in zip(strings, at.tolist())])
    return left, np.where(right - left >= length, right, left)


def _constructed(length: int, seed: int):
    def repeated(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches):
            anchors, strings = block["anchor"].to_numpy(), list(block["bytes"])
            left, right = _clipped(anchors, strings, length, seed)
            clips = [x[a:b] for x, a, b in zip(strings, left.tolist(), right.tolist())]
            # equal clips repeat in full; only clips that differ from another one of their anchor are built
            places: dict[tuple[int, bytes], list[int]] = {}
            for i, (anchor, clip) in enumerate(zip(anchors.tolist(), clips)):
                if clip:
                    places.setdefault((anchor, clip), []).append(i)
            kinds = Counter(anchor for anchor, _ in places)
            built = [key for key in places if kinds[key[0]] > 1]
            flags = dict(zip(built, repeated_places([clip for _, clip in built], length))) if built else {}
            out = []
            for i, (anchor, string, n, often) in enumerate(zip(anchors.tolist(), block["string"], block["n"], block["often"])):
                own = np.full(n, bool(often))
                if clips[i]:
                    key, windows = (anchor, clips[i]), len(clips[i]) - length + 1
                    own[left[i] : left[i] + windows] |= True if len(places[key]) > 1 else flags[key][:windows] if key in flags else False
                out += [(anchor, string, n, int(a), int(b - a)) for a, b in zip(*_runs(own))]
            yield pd.DataFrame(out, columns=["anchor", "string", "n", "first", "many"])

    return repeated


def _bytes_of(whole: DataFrame, picked: DataFrame, length: int) -> DataFrame:
    """The strings that ``picked`` names by row and place."""
    wanted = picked.groupBy("_row").agg(F.collect_list(F.struct("start", "n", "anchor", "string", "often")).alias("_wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: dict[str, list] = {c: [] for c in ("anchor", "string", "n", "often", "bytes")}
            for value, wants in zip(batch.column("text"), batch.column("_wanted")):
                data = value.as_py().encode()
                for w in wants.as_py():
                    for c in ("anchor", "string", "n", "often"):
                        columns[c].append(w[c])
                    columns["bytes"].append(data[w["start"] : w["start"] + w["n"] + length - 1])
            kinds = {"anchor": pa.int64(), "string": pa.int64(), "n": pa.int16(), "often": pa.bool_(), "bytes": pa.binary()}
            yield pa.RecordBatch.from_pydict({c: pa.array(v, kinds[c]) for c, v in columns.items()})

    return whole.join(wanted, "_row").select("text", "_wanted").mapInArrow(cut, "anchor long, string long, n short, often boolean, bytes binary")


def _by_window(strings: DataFrame, length: int) -> DataFrame:
    """For anchors with very many different strings: every window by digest, counted over map-side partials."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for at in range(0, len(batch), 256):
                out = []
                for anchor, string, n, often, data in batch.iloc[at : at + 256][["anchor", "string", "n", "often", "bytes"]].itertuples(index=False):
                    out += [(anchor, string, n, i, xxh3_128_digest(data[i : i + length]), often) for i in range(n)]
                yield pd.DataFrame(out, columns=["anchor", "string", "n", "first", "window", "often"])

    windows = strings.mapInPandas(cut, "anchor long, string long, n short, first int, window binary, often boolean")
    again = windows.groupBy("window").agg(F.count(F.lit(1)).alias("_n"), F.max("often").alias("_often")).filter("_n > 1 OR _often").select("window")
    return windows.join(again, "window", "left_semi").select("anchor", "string", "n", "first", F.lit(1).alias("many"))


def repeated_spans(whole: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """Spans (``_row``, ``start``, ``end``) of the bytes covered by a repeated substring; they may overlap. ``whole`` are written
    rows of ``_row`` and ``text``, which several jobs read."""
    small_batches(whole.sparkSession, 200)
    places = occurrences(whole, length, seed)
    known = F.xxhash64("string", "n")
    anchors = places.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n"), F.min(known).alias("_lo"), F.max(known).alias("_hi"))
    # written first: a join of two plain shuffles is one that adaptive execution can split at a hot anchor
    several = stored(anchors.filter("_n > 1").select("anchor", (F.col("_lo") == F.col("_hi")).alias("_same")))
    places = stored(places.join(several, "anchor"))
    equal = places.filter("_same").select("_row", "start", "n")

    distinct = places.filter("not _same").groupBy("anchor", "string", "n").agg(
        F.min(F.struct("_row", "start")).alias("_one"), (F.count(F.lit(1)) > 1).alias("often"))
    strings = stored(_bytes_of(whole, distinct.select("anchor", "string", "n", "often", "_one._row", "_one.start"), length))
    crowds = strings.groupBy("anchor").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > CROWDED).select("anchor")
    calm = strings.join(crowds, "anchor", "left_anti").repartition("anchor").sortWithinPartitions("anchor")
    built = calm.mapInPandas(_constructed(length, seed), "anchor long, string long, n short, first int, many int")
    crowded = _by_window(strings.join(crowds, "anchor", "left_semi"), length)
    found = stored(built.unionByName(crowded))
    partly = places.filter("not _same").join(found, ["anchor", "string", "n"]).select(
        "_row", (F.col("start") + F.col("first")).alias("start"), F.col("many").alias("n"))
    windows = equal.unionByName(partly)
    return windows.select("_row", "start", (F.col("start") + F.col("n") + (length - 1)).alias("end"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def without_repeated(docs: DataFrame, length: int = LENGTH, seed: int = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each input row: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (byte start and end of
    each maximal removed run) and ``kept_sha256`` over the bytes that stay.

    Texts are judged whole, as UTF-8 bytes, on the input; a match never crosses documents. Null counts as empty, and
    texts under ``length`` bytes lose nothing; very long ones are looked at in overlapping stretches of ``STRETCH`` bytes.
    Repeated rows repeat one another and lose everything. Other columns are not read. An empty table gives an empty result.
    Rows are numbered and written once, so that places and texts meet again whatever becomes of the cluster in between.
    """
    held = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    ids = numbered(held)
    spans = repeated_spans(ids.select("_row", "text"), length, seed)
    gone = spans.groupBy("_row").agg(F.collect_list(F.struct("start", "end")).alias("_gone"))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, gone_here in zip(batch.column("text"), batch.column("_gone")):
                data = value.as_py().encode()
                cut = merged([(g["start"], g["end"]) for g in gone_here.as_py() or ()])
                digest, at = hashlib.sha256(), 0
                for start, end in cut:
                    digest.update(data[at:start])
                    at = end
                digest.update(data[at:])
                rows.append((len(data), sum(e - s for s, e in cut), len(cut), [{"start": s, "end": e} for s, e in cut], digest.hexdigest()))
            n_bytes, removed, runs, cuts, digests = zip(*rows) if rows else ((),) * 5
            pair = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_bytes, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(cuts, pair), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept_sha256 string"
    return ids.join(gone, "_row", "left").select("doc_id", "text", "_gone").mapInArrow(judged, schema)
