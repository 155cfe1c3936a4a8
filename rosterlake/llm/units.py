"""Substring dedup by hashed units: equal units anywhere in the collection are kept once.

Units are lines, paragraphs, or the sentences of lines. They are normalised and hashed where they are read; only 128-bit
digests and places are grouped. The earliest ranked occurrence (smallest document id, then row, then place) stays, every other
one is removed and reported with its offsets in the original text.

A sentence shorter than ``MIN_CHARS`` repeats by chance. Neighbours that are that short make one unit, up to about ``TOGETHER``
code points, and the digest of a unit that is still short takes in the units before it, and where these are not enough those
after it, up to ``CONTEXT`` code points: it goes where it repeats together with what it stands beside, as in a copied text or
passage, and stays elsewhere. Floors are in code points, so scripts without spaces are treated alike.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import free, numbered, small_batches, stored, texts

#: Every unit with a letter or digit takes part: a floor in words parted by spaces would leave out short lines, and whole
#: passages in scripts without spaces.
MIN_WORDS = 1
#: Sentences, in code points when normalised: from when on one stands for itself, into how long stretches shorter neighbours are
#: put together, and what a unit that is shorter is looked up with.
MIN_CHARS, TOGETHER, CONTEXT = 80, 160, 200
#: A break stands between units; those of sentences have no length, so that the units make up the text.
_BREAKS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*(?:\n[ \t\r]*)+"),
           "sentence": re.compile(r"(?<=[\n。！？])|(?<=[.!?])(?=[ \t])")}
_NO_WORD = re.compile(r"[\W_]+")


def normalised(unit: str) -> str:
    """Lower case, and one space for whatever is neither letter nor digit."""
    return _NO_WORD.sub(" ", unit.lower()).strip()


def _pieces(text: str, by: str) -> Iterator[tuple[int, int]]:
    """Start and end of what stands between breaks, in code points."""
    at = 0
    for found in _BREAKS[by].finditer(text):
        yield at, found.start()
        at = found.end()
    yield at, len(text)


def _sentences(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and normal form of sentences, short neighbours in one."""
    start, end, parts, offset, stretch = 0, 0, [], 0, 0
    for at, upto in _pieces(text, "sentence"):
        v = normalised(text[at:upto])
        if len(v) >= MIN_CHARS or offset // TOGETHER != stretch:
            if end > start:
                yield start, end, " ".join(parts)
            start, parts, stretch = at, [], offset // TOGETHER
        if len(v) >= MIN_CHARS:
            yield at, upto, v
            start, offset, stretch = upto, 0, 0
        elif v:
            parts.append(v)
            offset += len(v) + 1
        end = upto
    if end > start:
        yield start, end, " ".join(parts)


def places(text: str, by: str = "line") -> Iterator[tuple[int, int]]:
    """Start and end of every unit, in code points; the break after it is not part of a unit."""
    return ((s, e) for s, e, _ in _sentences(text)) if by == "sentence" else _pieces(text, by)


def looked_up(text: str, by: str = "line", min_words: int = MIN_WORDS) -> Iterator[tuple[int, int, str]]:
    """Start, end and what is hashed of every unit that takes part."""
    if by != "sentence":
        for start, end in _pieces(text, by):
            v = normalised(text[start:end])
            if v and v.count(" ") + 1 >= min_words:
                yield start, end, v
        return
    found = [f for f in _sentences(text) if f[2]]
    sums = [0]
    for _, _, v in found:
        sums.append(sums[-1] + len(v) + 1)
    for i, (start, end, v) in enumerate(found, 1):
        if len(v) < MIN_CHARS:
            first = max(1, bisect_right(sums, sums[i] - 1 - CONTEXT))
            last = i if sums[i] - sums[first - 1] > CONTEXT else max(i, min(len(found), bisect_left(sums, CONTEXT + 1)))
            v = f"{i - first}\0" + "\n".join(f[2] for f in found[first - 1 : last])
        yield start, end, v


def _digests(whole: DataFrame, by: str, min_words: int) -> DataFrame:
    """One row for each unit that takes part: ``_row``, ``doc_id``, ``start``, ``end`` and the digest (``a``, ``b``)."""
    small_batches(whole.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            of, starts, ends, digests = [], [], [], []
            for i, value in enumerate(texts(batch)):
                for start, end, unit in looked_up(value, by, min_words):
                    of.append(i)
                    starts.append(start)
                    ends.append(end)
                    digests.append(xxh3_128_digest(unit.encode("utf-8", "surrogatepass")))
            halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
            own = [batch.column(c).take(pa.array(of, pa.int64())) for c in ("_row", "doc_id")]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                names=["_row", "doc_id", "start", "end", "a", "b"])

    return whole.mapInArrow(cut, "_row long, doc_id long, start int, end int, a long, b long")


def _repeats(whole: DataFrame, by: str, min_words: int) -> DataFrame:
    """The repeats of ``whole``, written rows of ``_row``, ``doc_id`` and ``text``."""
    units = _digests(whole, by, min_words)
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("_row"), F.col("start"))
    first = units.groupBy("a", "b").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    # written first: a join of two plain shuffles is one that adaptive execution can split at a hot digest
    every = units.join(stored(first), ["a", "b"])
    later = every.filter((F.col("_row") != F.col("_first._row")) | (F.col("start") != F.col("_first.start")))
    return later.select("_row", "doc_id", "start", "end", F.col("_first._row").alias("kept_row"),
                        F.col("_first.doc_id").alias("kept_doc_id"), F.col("_first.start").alias("kept_start"))


def _looked_at(docs: DataFrame, row: str, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(row).alias("_row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def repeats(docs: DataFrame, by: str = "line", min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every occurrence that goes: ``_row``, ``doc_id``, ``start``, ``end`` and the row, id and start of the one that
    stays. Ranked by document id, nulls last, then row, then start.

    The smallest place of a digest is found over map-side partials, so a unit that a third of all rows holds moves one
    row a task; the join back splits such a unit by adaptive execution, since the other side has one row for each digest.
    """
    row = free(docs, "_row")
    return _repeats(_looked_at(numbered(docs.select(doc_id, text), row), row, doc_id, text), by, min_words)


def without_repeats(docs: DataFrame, by: str = "line", min_words: int = MIN_WORDS, doc_id: str = "doc_id", text: str = "text",
                    into: str = "units") -> DataFrame:
    """``docs`` with ``text`` less its repeated units, and a struct ``into``: ``n_units`` (all units, blank ones too),
    ``n_removed`` and ``spans``, the removed (start, end) in code points of the original text, in order.

    Lines and paragraphs that stay are joined by one break (a line feed, or two for paragraphs); sentences that stay are put
    together as they were. A text without removals is passed on unchanged, null as null. Repeated rows are repeats of one
    another: the first keeps its units. An empty table gives an empty result. Texts of any length are cut whole, in batches of
    bounded size. Rows are numbered and written once, and other columns keep their names and values, whatever these are; but a
    column named as ``into`` is replaced.
    """
    row, cut, left = free(docs, "_row"), free(docs, "_gone"), free(docs, "_rest")
    whole = numbered(docs, row)
    gone = _repeats(_looked_at(whole, row, doc_id, text), by, min_words).groupBy("_row").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias(cut)).withColumnRenamed("_row", row)
    joint = {"line": "\n", "paragraph": "\n\n", "sentence": ""}[by]

    @F.pandas_udf("text string, n_units int")
    def rest(column: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for value, held in zip(column, spans):
            drop = set() if held is None else {x["start"] for x in held}
            units = list(places(value or "", by))
            out.append((value if not drop else joint.join(value[s:e] for s, e in units if s not in drop or s == e), len(units) if value else 0))
        return pd.DataFrame(out, columns=["text", "n_units"])

    joined = whole.join(gone, row, "left").withColumn(left, rest(F.col(f"`{text}`").cast("string"), F.col(cut)))
    none = F.array().cast("array<struct<start:int,end:int>>")
    spans = F.coalesce(F.col(cut), none)
    summary = F.struct(F.col(f"{left}.n_units").alias("n_units"), F.size(spans).alias("n_removed"), spans.alias("spans"))
    columns = [(F.col(f"{left}.text") if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns if c != into]
    return joined.select(*columns, summary.alias(into))
