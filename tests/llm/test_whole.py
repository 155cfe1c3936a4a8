"""Cases in which an operator once did less than its whole job."""

import random

import corpus_pipeline
from rosterlake.llm import decontam, units
from tests.llm.test_operators import SCHEMA, prose


def written(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(path))
    return spark.read.parquet(str(path))


def test_copies_of_a_page_are_not_boilerplate(spark, tmp_path):
    rng = random.Random(4)
    page = "\n".join(prose(rng, 12) for _ in range(6))
    texts = [page] * 15 + ["\n".join(prose(rng, 12) for _ in range(6)) for _ in range(25)]
    rows = [(i, f"{t}\nAll rights reserved", "en", "host", None) for i, t in enumerate(texts)]
    out = corpus_pipeline.line_dedup(spark, written(spark, tmp_path / "d", rows), "").collect()
    assert {r["doc_id"]: r["text"] for r in out} == dict(enumerate(texts))
    left = corpus_pipeline.near_dedup(spark, written(spark, tmp_path / "e", [tuple(r) for r in out]), "").collect()
    assert sorted(r["doc_id"] for r in left if r["text"] == page) == [0]


def test_trimmed_nameless_and_clashing_items_are_found(spark, tmp_path):
    rng = random.Random(8)
    items = [prose(rng, 59) for _ in range(4)]
    texts = [" ".join(items[0].split()[:55]), f"{prose(rng, 20)} {items[1]}", items[2], items[3], prose(rng, 55), " ".join(items[0].split()[:40])]
    docs = written(spark, tmp_path / "d", [(i, t, "en", "s", None) for i, t in enumerate(texts)])
    bench = spark.createDataFrame([(1, items[0]), (1, items[1]), (1, items[1]), (None, items[2]), (None, items[3])], "item_id long, text string")
    want = [(0, 1, 0, 55, 51 / 55), (1, 1, 20, 59, 1.0), (2, None, 0, 59, 1.0), (3, None, 0, 59, 1.0)]
    for at_once in (100, 1):
        got = decontam.leaks(docs, bench, items=at_once, nameless=True).drop("_row").collect()
        assert sorted(map(tuple, got)) == want
    assert sorted(r["doc_id"] for r in decontam.clean(docs, bench).collect()) == [4, 5]


def test_short_lines_and_scripts_without_spaces_are_units(spark, tmp_path):
    texts = ["Short line\nYes.\n***", "yes\nshort  LINE\n***\nno", "那是很久以前的事情，那时候大家都还住在河边的小村子里。\nยังไม่มีใครรู้"]
    rows = [(i, t, "en", "s", None) for i, t in enumerate([*texts, texts[2]])]
    out = units.without_repeats(written(spark, tmp_path / "d", rows)).collect()
    assert {r["doc_id"]: r["text"] for r in out} == {0: texts[0], 1: "***\nno", 2: texts[2], 3: ""}
