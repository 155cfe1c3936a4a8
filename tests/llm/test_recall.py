"""What the benchmark index finds against exact similarity without fingerprints, and operators on a cluster that changes."""

import os
import random
import re
from collections import Counter

import pytest

from rosterlake.llm import common, decontam, lines, simhash, substrings
from tests.llm.test_operators import SCHEMA, prose

FOLDER = "/root/testdata/sf0.001"


def shingled(words, size):
    return [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def exact_leaks(docs, items, least=0.8):
    """All pairs of a document and an item with a window of the item's words that is similar enough; five words a shingle."""
    out = set()
    for doc, text in docs:
        words = re.findall(r"[^\W_]+", (text or "").lower())
        here = set(shingled(words, 5))
        for item, asked in items:
            own = re.findall(r"[^\W_]+", (asked or "").lower())
            size = min(5, len(own))
            want = Counter(shingled(own, size))
            if not own or size == 5 and not here & want.keys():
                continue
            for at in range(max(1, len(words) - len(own) + 1)):
                window = Counter(shingled(words[at : at + len(own)], size))
                shared = (window & want).total()
                if shared and shared >= least * (window.total() + want.total() - shared):
                    out.add((doc, item))
                    break
    return out


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")
def test_leaks_reach_what_exact_similarity_finds(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rng = random.Random(5)
    for n in range(60):  # trimmed and altered copies of items, at the edge of what counts as similar
        own = (items[n % len(items)][1] or "").split()
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(len(own))] = "altered"
        own = own[rng.randint(0, 2) : len(own) - rng.randint(0, 2)]
        docs.append((10_000 + n, " ".join([prose(rng, 20), *own, prose(rng, 20)])))
    want = exact_leaks(docs, items)
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(df, bench).collect()}
    assert got <= want and len(want) > 20
    assert len(got) >= 0.95 * len(want)


@pytest.mark.parametrize("name", ["lines", "near", "clean", "suffix"])
def test_results_do_not_depend_on_how_files_are_split(spark, tmp_path, monkeypatch, name):
    rng = random.Random(9)
    texts = [prose(rng, 60) + "\nSubscribe to us\n" + prose(rng, 60) for _ in range(40)]
    item = prose(rng, 30)
    texts = texts + texts[:15] + [f"{prose(rng, 20)} {item} {t}" for t in texts[:5]]
    spark.createDataFrame([(i, t, "en", f"h{i % 2}", None) for i, t in enumerate(texts)], SCHEMA).repartition(6).write.parquet(str(tmp_path / "d"))
    docs, bench = spark.read.parquet(str(tmp_path / "d")), spark.createDataFrame([(1, item)], "item_id long, text string")
    run = {"lines": lambda: lines.drop_boilerplate(docs), "near": lambda: simhash.one_of_each(docs), "clean": lambda: decontam.clean(docs, bench),
           "suffix": lambda: substrings.without_repeated(docs).select("doc_id", "n_removed", "kept_sha256")}[name]
    want = sorted(map(str, run().collect()))
    made = common.stored

    def changes(df, *options):
        out = made(df, *options)
        spark.conf.set("spark.sql.files.minPartitionNum", "12")
        return out

    monkeypatch.setattr(common, "stored", changes)
    spark.conf.set("spark.sql.files.minPartitionNum", "2")
    try:
        assert sorted(map(str, run().collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
