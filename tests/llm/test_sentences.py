"""Substring dedup by sentences against brute force, and numbers and names that must hold between jobs."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from rosterlake.llm import units
from tests.llm.test_operators import SCHEMA, clashing, prose


def sentences(text):
    """Units that make up the text: after a line feed or a full-width stop, and before a blank that follows a stop."""
    out, at = [], 0
    for i in range(1, len(text)):
        if text[i - 1] in "\n。！？" or text[i - 1] in ".!?" and text[i] in " \t":
            out.append((at, i))
            at = i
    return out + [(at, len(text))] if text[-1:] not in ("\n", "。", "！", "？") else out + [(at, len(text)), (len(text), len(text))]


def slow_units(text, least=80, together=160):
    """Sentences of ``least`` and more stand alone; the others between two of these make stretches, by where each begins."""
    groups, run = [], 0
    before = 0
    for s, e in sentences(text):
        v = re.sub(r"[\W_]+", " ", text[s:e].lower()).strip()
        if len(v) >= least:
            run, before = run + 1, 0
            groups.append(((run, "own"), s, e, v))
        else:
            groups.append(((run, before // together), s, e, v))
            before += len(v) + 1 if v else 0
    out = []
    for key in dict.fromkeys(g[0] for g in groups):
        own = [g for g in groups if g[0] == key]
        if own[-1][2] > own[0][1]:
            out.append((own[0][1], own[-1][2], " ".join(g[3] for g in own if g[3])))
    return out


def slow_sentences(rows, least=80, context=200):
    """What goes from each row, in order of id (null last), row and place."""
    seen, out = set(), {}
    for r in sorted(rows, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["_row"])):
        found = [f for f in slow_units(r["text"] or "") if f[2]]
        keys = []
        for i, (s, e, v) in enumerate(found):
            key = (v,)
            if len(v) < least:
                a = b = i
                while a > 0 and len("\n".join(f[2] for f in found[a : b + 1])) < context:
                    a -= 1
                while b < len(found) - 1 and len("\n".join(f[2] for f in found[a : b + 1])) < context:
                    b += 1
                key = (i - a, "\n".join(f[2] for f in found[a : b + 1]))
            keys.append(key)
        out[r["_row"]] = []
        for (s, e, _), key in zip(found, keys):
            if key in seen:
                out[r["_row"]].append((s, e))
            seen.add(key)
    return out


def fixture(rng):
    def sentence():
        return prose(rng, rng.choice([1, 2, 3, 9, 20])).capitalize() + rng.choice([".", "!", "?", "...", ""])

    def text(n):
        return "".join(sentence() + rng.choice([" ", " ", "\n", "  ", "\n\n"]) for _ in range(n))

    passage = text(9)
    texts = [text(rng.randint(1, 12)) for _ in range(40)] + [prose(rng, 4) + ". " + passage + text(3) for _ in range(5)]
    texts += texts[:5] + ["Yes.", "Yes.", "No. Yes.", "那是很久以前的事情，那时候大家都还住在河边的小村子里。" * 4, "好。那是很久以前的事情，那时候大家都还住在河边的小村子里。" * 4,
                          "", None, ".", " \n", "a.b.c", "x. ", passage, "word " * 4000, "word " * 4000]
    rows = [(i, t, "en", "s", None) for i, t in enumerate(texts)]
    return rows + [rows[2], rows[2], (None, texts[3], None, None, None), (None, None, None, None, None)]


def test_sentences_match_brute_force(spark, tmp_path):
    spark.createDataFrame(fixture(random.Random(6)), SCHEMA).repartition(3).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    rows = docs.withColumn("_row", F.monotonically_increasing_id()).collect()
    want = slow_sentences(rows)
    got = units.repeats(docs, "sentence").collect()
    assert Counter((r["_row"], r["start"], r["end"]) for r in got) == Counter((k, s, e) for k, v in want.items() for s, e in v)
    left = Counter((r["doc_id"], r["text"] if not want[r["_row"]] else "".join(r["text"][s:e] for s, e, _ in slow_units(r["text"]) if (s, e) not in want[r["_row"]])) for r in rows)
    out = units.without_repeats(clashing(docs), "sentence").collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == left
    assert {r["text"].strip() for r in out if r["doc_id"] in (45, 46)} == {""}  # later copies go whole
    assert [r["text"] for r in out if r["doc_id"] == 50] == ["Yes."] and [r["text"] for r in out if r["doc_id"] == 52] == ["No. Yes."]


def test_rows_keep_their_numbers_when_splits_change(spark, tmp_path, monkeypatch):
    """An executor that comes or goes between two jobs changes how files are split."""
    rng = random.Random(9)
    rows = [(i, t, "en", "s", None) for i, t in enumerate([prose(rng, 30) + "\n" + prose(rng, 30) for _ in range(60)] * 2)]
    spark.createDataFrame(rows, SCHEMA).repartition(6).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    made = units.stored

    def changes(df, *options):
        out = made(df, *options)
        spark.conf.set("spark.sql.files.minPartitionNum", "12")
        return out

    monkeypatch.setattr(units, "stored", changes)
    spark.conf.set("spark.sql.files.minPartitionNum", "2")
    try:
        out = units.without_repeats(docs).collect()
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert {r["doc_id"]: r["text"] for r in out} == {i: t if i < 60 else "" for i, t, *_ in rows}


def test_columns_of_any_name_come_through(spark, tmp_path):
    names = ("_row", "_gone", "_rest", "_row_", "units_", "a", "b", "_n", "_first")
    rows = spark.createDataFrame([(i, "one line\ntwo lines", "en", "s", None) for i in range(3)], SCHEMA).withColumns({c: F.col("doc_id") + 7 for c in names})
    rows.write.parquet(str(tmp_path / "d"))
    out = units.without_repeats(spark.read.parquet(str(tmp_path / "d")))
    assert out.columns == [*rows.columns, "units"]
    assert all(r[c] == r["doc_id"] + 7 for r in out.collect() for c in names)
    assert sorted(r["text"] for r in out.collect()) == ["", "", "one line\ntwo lines"]
