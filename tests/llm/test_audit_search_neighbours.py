"""Filter interaction audit, ranked search and nearest neighbours against brute force, and what they must survive."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import interaction, neighbours, queries, search
from tests.llm.test_operators import SCHEMA, clashing, fixture, prose

FOLDER = "/root/testdata/sf0.001"


def tagged(rng, n):
    """Prose that fails some of the filters."""
    text = prose(rng, n)
    if rng.random() < 0.4:
        text = " ".join(text.split()[:20] * (n // 20 + 1))
    if rng.random() < 0.3:
        text = text.upper()
    return text + rng.choice(["", "", " #", " 5%"])


@pytest.fixture(scope="module")
def texts(spark, tmp_path_factory):
    rng = random.Random(12)
    rows = fixture() + [(100 + i, tagged(rng, rng.choice([30, 250, 400])), "en", rng.choice(["a", "b", None]), None) for i in range(60)]
    rows += [(300 + i, rows[60][1], "en", "hot", None) for i in range(40)]
    path = str(tmp_path_factory.mktemp("new") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def labels(spark):
    rng = random.Random(2)
    rows = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 340, 2)]
    return spark.createDataFrame(rows + [(None, 1, 1), (4, 1, 1), (4, 0, 0), (6, None, None)], "doc_id long, quality int, toxic int")


# filter interaction audit


def slow_audit(docs, labels):
    known = defaultdict(lambda: [False, False])
    for r in labels:
        known[r["doc_id"]][0] |= r["quality"] == 1
        known[r["doc_id"]][1] |= r["toxic"] == 1
    known[None] = [False, False]
    ids = defaultdict(list)
    for r in docs:
        if r["doc_id"] is not None:
            ids[r["text"] or ""].append(r["doc_id"])
    parts = defaultdict(list)
    for r in docs:
        t = r["text"] or ""
        w = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
                 "D": bool(re.search("[#$%&*|]", t)), "E": r["doc_id"] is not None and min(ids[t]) < r["doc_id"]}
        parts[r["source"] or ""].append(({f for f in fails if fails[f]}, *known[r["doc_id"]]))
    out = {}
    for part, held in parts.items():
        shapley = Counter()
        for order in permutations("ABCDE"):
            for step, f in enumerate(order):
                before, row = set(order[:step]), Counter()
                for failed, good, toxic in held:
                    gone, fails = bool(failed & before), f in failed
                    row["kept"] += not gone and not fails
                    row["removed"] += not gone and fails
                    row["redundant"] += gone and fails
                    row["unique_fails"] += failed == {f}
                    row["good_lost"] += not gone and fails and good
                    row["toxic_lost"] += not gone and fails and toxic
                shapley[f] += row["removed"]
                out[part, "".join(order), step + 1] = row
        for (p, order, step), row in out.items():
            if p == part:
                row["shapley"] = shapley[order[step - 1]]
    return out


def test_audit_matches_brute_force(spark, texts, labels):
    got = interaction.audit(clashing(texts).withColumns({c: F.lit(1) for c in ("part", "mask", "digest", "packed", "flags", "first_id")}), labels)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = {(r["part"], r["filter_order"], r["step"]): r.asDict() for r in got.collect()}
    want = slow_audit(texts.collect(), labels.collect())
    assert set(rows) == set(want) and len({k[0] for k in rows}) == 7
    for key, row in want.items():
        assert {c: rows[key][c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")} == dict(row), key


def test_fields_never_run_into_each_other():
    rng = random.Random(1)
    counts = {m: rng.randint(0, 900) for m in range(128)}
    width = sum(counts.values()).bit_length()
    fields = interaction.unpacked(sum(n * interaction.packed(m, width) for m, n in counts.items()), width)
    want = [0] * interaction.FIELDS
    for m, n in counts.items():
        for field in interaction.outcomes(m):
            want[field] += n
    assert fields == want
    full = interaction.unpacked(7 * interaction.packed(0, 3), 3)  # as many documents as a field can hold
    assert set(full[: interaction.STEPS]) == {7} and not any(full[interaction.STEPS :])


def test_audit_of_nothing(spark, labels):
    assert interaction.audit(spark.createDataFrame([], SCHEMA), labels).count() == 0
    rows = interaction.audit(spark.createDataFrame([(None, None, None, None, None)], SCHEMA), labels.limit(0)).collect()
    assert len(rows) == interaction.STEPS and all((r["part"], r["kept"] + r["removed"] + r["redundant"]) == ("", int(r["redundant"] or r["removed"] or r["kept"])) for r in rows)
    assert sum(r["removed"] for r in rows) == len(interaction.ORDERS)


# ranked search


def slow_terms(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def slow_search(docs, items, best=10):
    held = [(r["doc_id"], Counter(slow_terms(r["text"]))) for r in docs]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for r in items:
        asked, scores = set(slow_terms(r["text"])), []
        for doc, c, n in held:
            m = 100 - 90 + (90 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in asked if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(r["item_id"], rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores, key=lambda s: s[:3])[:best], 1)]
    return sorted(out, key=str)


def test_search_matches_brute_force(spark, texts):
    rng = random.Random(4)
    docs = texts.collect()
    asked = [" ".join(rng.sample((r["text"] or "x").split(" "), min(12, len((r["text"] or "x").split(" "))))) for r in rng.sample(docs, 12)]
    items = [(i, t) for i, t in enumerate(asked)] + [(None, asked[0].upper() + "!"), (3, asked[1]), (3, asked[1]), (90, None), (91, ""), (92, "?! -"), (93, "unheardof"), (94, "é" * 150)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = slow_search(docs, [r.asDict() for r in bench.collect()])
    names = {c: F.lit(1) for c in ("m", "tf", "terms", "block", "item", "rank", "_at", "df")}
    for kind in ({}, {"block": 40, "first": 2}, {"slice_terms": 20, "block": 300}):
        got = search.search(clashing(texts).withColumns(names), bench.withColumns(names), **kind)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert sorted(map(tuple, got.collect()), key=str) == want, kind


def test_bounds_hold_and_strata_are_skipped(spark, texts):
    """No score passes the bound of its block, and with floors from the highest blocks most visits fall away."""
    docs, asked = texts.collect(), sorted(set(search.terms(texts.collect()[5]["text"])))
    vocabulary = {t: i for i, t in enumerate(asked)}
    items = search.Items([{"item": 0, "item_id": 0, "terms": asked}], vocabulary)
    held = search.counted(texts, vocabulary)
    documents, length = held.agg(F.count("n"), F.sum("n")).first()
    assert documents == sum(bool(slow_terms(r["text"])) for r in docs)
    df = search.holding(held, len(vocabulary))
    items.weights = np.array([search.weight(documents, df.get(i, 0)) for i in range(len(vocabulary))])[items.terms]
    blocks = search.index(held, documents, length, block=60).collect()
    floors = search._floors(search.index(held, documents, length, block=60), items, 10, 4)
    seen = skipped = 0
    for row in blocks:
        block = search.Block(row.asDict())
        places = block.places(items)
        bound = block.bounds(items, places)[0]
        assert block.scores(items, 0, places).max() <= bound
        seen += len(block.docs)
        skipped += bound < floors[0]
    assert seen == held.filter("length(terms) > 0").count() and len({r["m"] for r in blocks}) > 20
    assert skipped > len(blocks) // 8


def test_search_of_nothing(spark, texts):
    empty = spark.createDataFrame([], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "al ta")], "item_id long, text string")
    assert search.search(texts, none).count() == search.search(empty, some).count() == search.search(empty, none).count() == 0
    assert search.search(empty, some).columns == ["item_id", "rank", "doc_id", "score"]


# nearest neighbours

VECTORS = "vec_id long, embedding array<float>, label int"


def slow_nearest(rows, k=20):
    held = sorted({(r["vec_id"], tuple(x + 0.0 for x in r["embedding"])) for r in rows})
    ids, x = np.array([h[0] for h in held]), np.array([h[1] for h in held], "float64")
    out = {}
    for at in np.flatnonzero(ids % 20 == 0):
        score = neighbours.products(np.broadcast_to(x[at], x.shape), x)
        order = [i for i in np.lexsort((ids, -score)) if i != at][:k]
        out.setdefault(ids[at], []).append([(int(ids[i]), float(score[i])) for i in order])
    return out


def recall(got, want):
    found = defaultdict(list)
    for r in got:
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hit = total = 0
    assert set(found) <= set(want)
    for q, lists in want.items():
        own = sorted(found[q])
        assert len(own) == sum(map(len, lists))
        if len(lists) == 1:
            assert [r for r, _, _ in own] == list(range(1, len(own) + 1))
            assert [(-s, v) for _, v, s in own] == sorted((-s, v) for _, v, s in own) and len({v for _, v, _ in own}) == len(own)
            exact = dict(lists[0])
            assert all(exact.get(v, s) == s for _, v, s in own)
        hit += (Counter((v, s) for _, v, s in own) & Counter(x for y in lists for x in y)).total()
        total += sum(map(len, lists))
    return hit / total


def made(seed, n, d, spread):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)).astype("float32")
    return x * rng.uniform(1 - spread, 1 + spread, (n, 1)).astype("float32")


@pytest.mark.parametrize("d, spread", [(64, 0.0), (24, 0.0), (20, 0.6)])
def test_neighbours_are_found(spark, d, spread):
    x = made(3, 1500, d, spread)
    if not spread:
        x /= np.linalg.norm(x, axis=1)[:, None]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    want = slow_nearest([{"vec_id": r[0], "embedding": r[1]} for r in rows])
    assert recall(neighbours.nearest(df, F.col("vec_id") % 20 == 0).collect(), want) >= 0.9


def test_finer_cells_reach_the_target(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(60, 16))
    x = (centres[rng.integers(0, 60, 3000)] + 0.15 * rng.normal(size=(3000, 16))).astype("float32")
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3)
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, cell=8, block=50, query_block=7)
    assert recall(got.collect(), slow_nearest([{"vec_id": r[0], "embedding": r[1]} for r in rows])) >= 0.9


def test_copies_and_odd_vectors(spark):
    """A third of all rows are one vector; everything is small enough that all cells are looked into."""
    rng = np.random.default_rng(5)
    x = rng.integers(-2, 3, (240, 4)).astype("float32")
    x[::3] = x[0] = [1, 2, 0, 1]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x) if v.any()]
    odd = [(1000, None, 0), (1020, [0.0] * 4, 0), (1040, [1.0, None, 0.0, 0.0], 0), (1060, [float("nan"), 1.0, 0.0, 0.0], 0),
           (1080, [float("inf"), 0.0, 0.0, 1.0], 0), (1100, [1.0, 2.0], 0), (None, [1.0, 0.0, 0.0, 0.0], 0), (1120, [], 0)]
    more = [rows[1], rows[1], (40, [-0.0, 0.0, 1.0, 1.0], 0), (40, [0.0, 0.0, 1.0, 1.0], 0), (40, [0.0, 2.0, 1.0, 1.0], 0)]
    df = spark.createDataFrame(rows + odd + more, VECTORS).repartition(3)
    names = {c: F.lit(1) for c in ("rep", "cell", "table", "digest", "score", "rank", "query", "ids", "vector", "asks")}
    want = slow_nearest([{"vec_id": r[0], "embedding": r[1]} for r in rows + more])
    got = neighbours.nearest(df.withColumns(names), F.col("vec_id") % 20 == 0, target=1.0, block=16, query_block=3)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert recall(got.collect(), want) == 1.0


def test_neighbours_of_few_and_none(spark):
    none = spark.createDataFrame([], VECTORS)
    assert neighbours.nearest(none, F.col("vec_id") % 20 == 0).count() == 0
    bad = spark.createDataFrame([(20, None, 1), (40, [], 1)], VECTORS)
    assert neighbours.nearest(bad, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0], 1)], VECTORS)
    assert neighbours.nearest(one, F.col("vec_id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(20, [1.0, 2.0], 1), (21, [3.0, 1.0], 1)], VECTORS)
    assert [tuple(r) for r in neighbours.nearest(two, F.col("vec_id") % 20 == 0).collect()] == [(20, 1, 21, 5.0)]
    unasked = spark.createDataFrame([(1, [1.0, 2.0], 1), (3, [1.0, 2.0], 1)], VECTORS)
    assert neighbours.nearest(unasked, F.col("vec_id") % 20 == 0).count() == 0


def test_registered_neighbours(spark):
    got = queries.QUERIES["op13_nearest_neighbours"](spark, FOLDER).collect()
    assert recall(got, slow_nearest(spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect())) >= 0.9
