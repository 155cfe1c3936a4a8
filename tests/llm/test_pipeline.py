"""The pipeline against a brute-force version, and the queries against their SQL."""

import os

import pytest

import corpus_pipeline
from rosterlake.llm import decontam, lines, packing, quality, queries, simhash

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


def brute_force(spark, folder):
    docs = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]

    def passes(text):
        m = dict(zip(quality.MEASURES, quality.measurements(text)))
        w = m["n_words"]
        return not (w < 50 or m["n_repeat_words"] * 2 > w or m["n_symbols"] * 10 > w or m["n_dup_lines"] * 100 > 40 * m["n_lines"]
                    or not 2 * w <= m["word_chars"] <= 14 * w or m["n_upper_words"] * 2 > w or m["n_marks"] * 2 > w)

    docs = [d for d in docs if passes(d["text"])]
    pages, often = {}, {}
    for source, text in {(d["source"], d["text"]) for d in docs}:
        pages[source] = pages.get(source, 0) + 1
        for x in {x.strip(lines.SPACES) for x in text.split("\n")} - {""}:
            often[source, x] = often.get((source, x), 0) + 1
    gone = {k for k, n in often.items() if n >= lines.MIN_PAGES and n > pages[k[0]] * lines.RATIO}
    for d in docs:
        d["text"] = "\n".join(x for x in d["text"].split("\n") if (d["source"], x.strip(lines.SPACES)) not in gone)
    docs.sort(key=lambda d: d["doc_id"])
    prints = [simhash.fingerprint(d["text"]) for d in docs]
    root = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= simhash.RADIUS:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    docs = [d for i, d in enumerate(docs) if root[i] == i]
    index = decontam.Index(bench)
    docs = [d for d in docs if not index.found(d["text"])]
    out = set()
    encode = packing.Encoder(queries.tokenizer_file()).encode
    for d in docs:
        n = len(encode([d["text"]])[0]) // 4 + 1
        out |= {(d["doc_id"], p, p * 2048, min(2048, n - p * 2048)) for p in range(-(-n // 2048))}
    return out


def test_pipeline_matches_brute_force(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert {(r["doc_id"], r["piece"], r["start"], r["length"]) for r in rows} == brute_force(spark, FOLDER)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= total / 2048 * 1.05 + 1


def test_columns_of_any_name_come_through_every_stage(spark, tmp_path):
    """Names that operators use inside, and splits that change between jobs."""
    from pyspark.sql import functions as F

    names = ("_row", "_row_", "_gone", "_drops", "_text", "_fp", "_kept", "ledger", "ledger_", "_page", "_keys", "key", "_least")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs.withColumns({c: F.col("doc_id") * 3 + i for i, c in enumerate(names)}).repartition(5).write.parquet(str(tmp_path / "d"))
    more = spark.read.parquet(str(tmp_path / "d"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, FOLDER)
        assert out.columns == more.columns
        plain = {(r["doc_id"], r["text"]) for r in stage(spark, docs, FOLDER).collect()}
        rows = out.collect()
        assert {(r["doc_id"], r["text"]) for r in rows} == plain
        assert all(r[c] == r["doc_id"] * 3 + i for r in rows for i, c in enumerate(names))


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "best_fit_packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
    nothing = spark.createDataFrame([], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, FOLDER).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, name):
    from tools.check_queries import connect, rows_of

    df = queries.QUERIES[name](spark, FOLDER)
    rel = connect(FOLDER).execute(queries.ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in rel.description], rel.fetchall())


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES) - {"pipeline", "op13_nearest_neighbours"}))
def test_queries_keep_every_row(spark, name):
    df = queries.QUERIES[name](spark, FOLDER)
    table, key = ("pages", "page_id") if name.startswith("op5") else ("documents", "doc_id")
    ids = {r[key] for r in df.collect()}
    want = {r[key] for r in spark.read.parquet(f"{FOLDER}/{table}.parquet").collect()}
    assert ids <= want if name.startswith("op6") else ids == want
