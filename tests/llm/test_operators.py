"""Operators against brute force on small fixtures, and the cases every operator must survive."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterlake.llm import collection, decontam, extract, lines, packing, pii, quality, sharding, simhash, substrings, units
from rosterlake.llm.queries import tokenizer_file

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [w + e for w in ("al", "ber", "cor", "dun", "es", "fil", "gor") for e in ("ta", "no", "mi", "rel", "sok")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def fixture(seed=3):
    """Texts with exact and near copies, shared passages, nulls, empties, one long text and repeated ids."""
    rng = random.Random(seed)
    shared = prose(rng, 60)
    docs = [prose(rng, rng.randint(1, 120)) + "\n" + prose(rng, rng.randint(0, 90)) for _ in range(40)]
    docs += docs[:4] + [d + " tail" for d in docs[4:8]] + [prose(rng, 5) + " " + shared + " " + prose(rng, 9) for _ in range(4)]
    docs += ["", None, "é" * 150, "é" * 150 + "x", "ab" * 400, "one", prose(rng, 3000), docs[0][:199], docs[0][:200], docs[0][:201], "\n\n  \n"]
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, None) for i, t in enumerate(docs)]
    return rows + [rows[0], rows[0], (None, docs[1], None, None, 1), (None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("llm") / "documents.parquet")
    spark.createDataFrame(fixture(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def clashing(df):
    """Extra columns with names that operators use inside."""
    return df.withColumns({c: F.lit(7) for c in ("start", "length", "n", "spans", "hit", "bytes", "kind", "size", "score", "key",
                                                      "_row", "_gone", "_drops", "_text", "_base", "_added", "_rest", "ledger_")})


def by_text(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


# quality rules


def slow_measures(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {i + d for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for d in range(3)}
    found = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", " ".join(words))), len(found), len(found) - len(set(found)), len(repeated)


def test_measures_match_brute_force():
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a", "a b c a b c", "x\x1cy\x85z\xa0w", "a\n a\na\n\nb"] + [
        "".join(rng.choice("ab \n#é|") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    for text in texts:
        assert quality.measurements(text)[:6] == slow_measures(text), text


def test_ledger_and_policies(spark, docs, empty):
    rows = quality.ledger(clashing(docs)).collect()
    assert len(rows) == docs.count() and all(r["start"] == 7 for r in rows)
    for r in rows:
        words = r["ledger"]["n_words"]
        assert bool(r["ledger"]["failures"] & 1) == (words < 50)
    kept = quality.apply_policy(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["ledger"]["failures"] == 0 for r in rows)
    assert quality.ledger(empty).count() == 0


def test_symbols_and_capitals_fail():
    rows = {"plain": prose(random.Random(1), 80), "signs": " ".join(w + "***" for w in WORDS * 3), "loud": " ".join(w.upper() + "!!" for w in WORDS * 3)}
    bits = {k: quality.measurements(v) for k, v in rows.items()}
    named = {k: dict(zip(quality.MEASURES, v)) for k, v in bits.items()}
    assert named["plain"]["n_symbols"] == named["plain"]["n_marks"] == 0
    assert named["signs"]["n_symbols"] == 3 * len(WORDS) * 3
    assert named["loud"]["n_upper_words"] == named["loud"]["n_words"]


def test_ablations(spark):
    entries = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,)], "f long").select(F.struct(F.col("f").alias("failures")).alias("ledger"))
    got = {(r["policy"], r["rule"]): (r["n_rejected"], r["n_failed"], r["n_only"], r["fired_beside"]) for r in quality.ablations(entries).collect()}
    assert got["base", "few_words"] == (3, 3, 2, 2)
    assert got["base", "repeated_words"] == (3, 1, 0, 1)
    assert got["2024-1", "symbols"] == (4, 1, 1, 0)
    assert len(got) == sum(bin(m).count("1") for m in quality.POLICIES.values())


# line and paragraph dedup


def slow_units(rows, by="line"):
    ranked = sorted(range(len(rows)), key=lambda i: (rows[i]["doc_id"] is None, rows[i]["doc_id"] or 0, rows[i]["_row"]))
    seen, out = set(), {}
    for i in ranked:
        text = rows[i]["text"] or ""
        gone = []
        for s, e in units.places(text, by):
            unit = units.normalised(text[s:e])
            if unit and len(unit.split()) >= units.MIN_WORDS:
                if unit in seen:
                    gone.append((s, e))
                seen.add(unit)
        out[rows[i]["_row"]] = gone
    return out


@pytest.mark.parametrize("by", ["line", "paragraph"])
def test_units_match_brute_force(docs, by):
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    want = slow_units(numbered.collect(), by)
    got = units.repeats(docs, by).collect()
    assert Counter((r["_row"], r["start"], r["end"]) for r in got) == Counter((k, s, e) for k, v in want.items() for s, e in v)
    out = units.without_repeats(clashing(docs), by).collect()
    assert Counter(len(r["units"]["spans"]) for r in out) == Counter(len(v) for v in want.values())
    assert sum(r["text"] is None for r in out) == sum(r["text"] is None for r in docs.collect())


def test_units_of_nothing(empty):
    assert units.without_repeats(empty).count() == 0


# exact substrings


def slow_substrings(texts, k):
    found = Counter(t[i : i + k] for t in texts for i in range(len(t) - k + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - k + 1):
            if found[t[i : i + k]] > 1:
                gone[i : i + k] = True
        runs = int(np.sum(np.diff(gone.astype(int), prepend=0) == 1))
        out.append((len(t), int(gone.sum()), runs, hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def test_collection_matches_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        k, letters = rng.randint(1, 6), rng.choice([b"ab", b"abc", b"abcdefgh"])
        strings = sorted({bytes(rng.choice(letters) for _ in range(rng.randint(1, 20))) for _ in range(rng.randint(1, 12))})
        found = Counter(s[i : i + k] for s in strings for i in range(len(s) - k + 1))
        got = collection.repeated_places(strings, k)
        for i, s in enumerate(strings):
            n = max(0, len(s) - k + 1)
            assert got[i][:n].tolist() == [found[s[j : j + k]] > 1 for j in range(n)]
            assert not got[i][n:].any()


@pytest.mark.parametrize("length, seed, crowded", [(200, 100, 4096), (40, 8, 4096), (40, 8, 0)])
def test_substrings_match_brute_force(docs, monkeypatch, length, seed, crowded):
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    rows = docs.collect()
    want = Counter(zip((r["doc_id"] for r in rows), slow_substrings([(r["text"] or "").encode() for r in rows], length)))
    got = substrings.without_repeated(clashing(docs), length, seed).collect()
    assert Counter((r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got) == want


def test_anchors_over_stretches(monkeypatch):
    data = prose(random.Random(2), 600).encode()
    monkeypatch.setattr(substrings, "STRETCH", 500)
    starts, counts, _ = substrings.anchored(data, 40, 8)
    assert starts[0] == 0 and (starts[1:] == starts[:-1] + counts[:-1]).all() and starts[-1] + counts[-1] == len(data) - 39


def test_substrings_of_nothing(empty):
    assert substrings.without_repeated(empty).count() == 0


# site-relative lines


def slow_lines(rows, ratio, least):
    different = {(r["source"], r["text"] or "") for r in rows}
    pages, often = Counter(source for source, _ in different), Counter()
    for source, text in different:
        often.update({(source, x.strip(lines.SPACES)) for x in text.split("\n") if x.strip(lines.SPACES)})
    drop = {k for k, n in often.items() if n >= least and n > ratio * pages[k[0]]}
    return Counter((r["doc_id"], None if r["text"] is None else "\n".join(
        x for x in r["text"].split("\n") if (r["source"], x.strip(lines.SPACES)) not in drop)) for r in rows)


def test_lines_match_brute_force(spark, docs, empty, tmp_path):
    boiler = F.when(F.col("text").isNotNull() & (F.col("doc_id") % 4 == 0), F.concat("text", F.lit("\nSubscribe  now \r\n\nlast"))).otherwise(F.col("text"))
    docs.withColumn("text", boiler).write.parquet(str(tmp_path / "d"))
    whole = spark.read.parquet(str(tmp_path / "d"))
    rows = whole.collect()
    for ratio, least in ((0.1, 5), (0.02, 2)):
        out = lines.drop_boilerplate(clashing(whole), ratio=ratio, min_pages=least)
        assert by_text(out.collect()) == slow_lines(rows, ratio, least)
    assert lines.drop_boilerplate(whole).columns == whole.columns
    assert lines.drop_boilerplate(empty).count() == 0


# main text


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>if (a < b) "</p>"</script></head><body class="page with-sidebar">
<header id="masthead"><div class="logo">The Site</div></header><nav><ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul></nav>
<div class="cookie-notice">We use cookies on this site, a great many of them, for ever and ever, to show you what you have seen before.</div>
<div id="main-content">%s<h1>A title</h1><p>First &amp; foremost, this paragraph&nbsp;has
  <b>some</b> words <a href="x">linked</a> in it, enough of them to make a surge in the lengths of lines.</p>
<div class="ad">Buy this now, for it is cheap and it will make you happy, at least until you have it and see what it is.</div>
<p>Second paragraph, with a break<br>in it &#8212; and it is long as well, because articles are made of long paragraphs.<p>End.
%s</div><aside><p>Most read this week: a long list of things that have nothing to do with the article, at length.</p></aside>
<form><label>Your mail</label><input name=q></form><section class="comments"><p>What a great article, I have read it three times and will again soon.</p></section>
<footer>&copy; The Site</footer></body></html>"""
TEXT = ("A title\n\nFirst & foremost, this paragraph has some words linked in it, enough of them to make a surge in the lengths of lines.\n\n"
        "Second paragraph, with a break in it — and it is long as well, because articles are made of long paragraphs.\n\nEnd.")


def test_main_text():
    assert extract.main_text(PAGE % ("<article>", "</article>")) == TEXT
    body = extract.main_text(PAGE % ("", ""))
    assert "First & foremost" in body and "End." in body and "cookies" not in body and "great article" not in body and "Most read" not in body
    for page in (None, "", "   ", "<html><body></body></html>", "<script>x", "<!-- a"):
        assert extract.main_text(page) == ""
    assert extract.main_text("just a line") == "just a line"
    linked = "<article><p>%s</p><p><a href=x>one link</a></p><figure><figcaption>A figure.</figcaption></figure><ul>%s</ul></article>"
    menu = "<li><a href=y>menu</a></li>" * 4
    assert extract.main_text(linked % ("long " * 30, "<li>item</li>")) == ("long " * 30).strip() + "\n\none link\n\nA figure.\n\nitem"
    assert extract.main_text(linked % ("long " * 30, menu)) == ("long " * 30).strip() + "\n\none link\n\nA figure."
    assert extract.main_text("<article><h1>T</h1><p>cut o") == "T\n\ncut o"


def test_surge_and_dive():
    assert extract.stretches([0, 0, 90, 10, 200, 0, 0, 0, 5]) == [(2, 5)]
    assert extract.stretches([100, 0, 0, 100]) == [(0, 4)]
    assert extract.stretches([5, 5]) == []


def test_extract_rows(spark):
    rows = [(1, "u", PAGE % ("<article>", "</article>"), 3), (1, "u", None, 3), (None, None, "", None)]
    out = extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert sorted(r["text"] for r in out) == ["", "", TEXT]


# benchmark


def slow_leaks(rows, items):
    out = Counter()
    for r in rows:
        document = decontam.words(r["text"])
        for item, text in items:
            own = decontam.words(text)
            size = min(decontam.SHINGLE, len(own))
            if not own:
                continue
            want, mark = Counter(decontam.shingles(own)), decontam.simhash([decontam._hash(s) for s in decontam.shingles(own)])
            best = 0.0
            for at in range(len(document) - len(own) + 1):
                window = decontam.shingles(document[at : at + len(own)], size)
                score = decontam.similarity(Counter(window), want)
                if score >= decontam.SIMILARITY and (decontam.simhash([decontam._hash(s) for s in window]) ^ mark).bit_count() <= decontam.RADIUS:
                    best = max(best, score)
            if best:
                out[r["doc_id"], item, round(best, 9)] += 1
    return out


def test_leaks_match_brute_force(spark, docs, empty):
    rng = random.Random(9)
    rows = [r for r in docs.collect()]
    texts = [r["text"] for r in rows if r["text"] and len(r["text"].split()) > 70]
    items = [(i, " ".join(t.split()[10 : 10 + 12 + 3 * i])) for i, t in enumerate(texts[:12])]
    items += [(50, "one"), (51, ""), (52, None), (53, prose(rng, 30)), (54, items[0][1].upper().replace(" ", ", ")), (None, items[1][1])]
    items += [(55, " ".join(texts[3].split()[5:59] + ["zzz"]))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = slow_leaks(rows, [(i, t) for i, t in items if i is not None])
    assert any(k[2] < 1 for k in want)
    for at_once in (100, 5):
        got = decontam.leaks(clashing(docs), bench, items=at_once).collect()
        assert Counter((r["doc_id"], r["item_id"], round(r["similarity"], 9)) for r in got) == want
    clean = decontam.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() < docs.count()
    assert decontam.leaks(docs, bench.limit(0)).count() == 0 and decontam.clean(empty, bench).count() == 0


# packing


def whole_tokens(text):
    from tokenizers import Tokenizer

    if not hasattr(whole_tokens, "known"):
        whole_tokens.known = Tokenizer.from_file(tokenizer_file())
    return [*whole_tokens.known.encode(text or "", add_special_tokens=False).ids, 0]


TRICKY = ["It's 3.5%!! <|endoftext|> a<|startoftext|>b", "café ́x  y z", "  \t\r\n ", "a​b\x1cc\x85d", "ß ẞ İ ı ǅ", "日本語 テキスト 1234567",
          "don't  'S WE'LL", "﻿x", "e ́", "à́ \n̂b"]


def test_encoder_equals_the_tokenizer():
    rows = [t for _, t, *_ in fixture() if t] + TRICKY
    made = packing.Encoder(tokenizer_file()).encode(rows)
    for text, data in zip(rows, made):
        assert np.frombuffer(data, "<u4").tolist() == whole_tokens(text)[:-1], text


def test_packing(spark, docs, empty):
    extra = spark.createDataFrame([(900 + i, t, None, None, None) for i, t in enumerate(TRICKY)], SCHEMA)
    every = clashing(docs.unionByName(extra))
    rows = packing.pack(packing.pieces(every, tokenizer_file(), capacity=256), capacity=256).collect()
    want = Counter()
    for r in every.select("doc_id", "text").collect():
        ids = whole_tokens(r["text"])
        for at in range(0, len(ids), 256):
            part = np.asarray(ids[at : at + 256], "<u4").tobytes()
            want[r["doc_id"], at // 256, at, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    used = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r["length"] for r in rows)
    assert len(used) <= -(-total // 256) * 1.05 + 1
    assert packing.pack(packing.pieces(empty, tokenizer_file())).count() == 0


def test_plan_packs_every_length():
    rng = random.Random(4)
    for _ in range(30):
        histogram = Counter(rng.randint(1, 64) for _ in range(rng.randint(0, 400)))
        made = packing.plan(dict(histogram), 64)
        used = Counter()
        for held, times in made:
            assert sum(held) <= 64
            for length in held:
                used[length] += times
        assert used == histogram
    assert packing.plan({40: 1, 24: 1, 14: 1, 9: 1}, 64) == [([40, 24], 1), ([14, 9], 1)]
    # greedy holds 40 and 20; two that were left fill the place of 20 and the gap
    assert packing.plan({40: 1, 20: 1, 13: 1, 11: 1}, 64)[0] == ([40, 13, 11], 1)


# near duplicates


def slow_fingerprint(text):
    from xxhash import xxh64_intdigest

    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def slow_components(values, radius):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


@pytest.mark.parametrize("radius", [2, 20])
def test_near_duplicates_match_brute_force(docs, radius):
    rows = docs.collect()
    prints = [slow_fingerprint(r["text"]) for r in rows]
    roots = slow_components(sorted(set(prints)), radius)
    least = {}
    for r, p in zip(rows, prints):
        ids = [x for x in (least.get(roots[p]), r["doc_id"]) if x is not None]
        least[roots[p]] = min(ids) if ids else None
    want = Counter((r["doc_id"], f"{p:016x}", least[roots[p]]) for r, p in zip(rows, prints))
    got = simhash.near_duplicates(clashing(docs), radius=radius).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    kept = simhash.one_of_each(docs, radius=radius)
    assert kept.columns == docs.columns and kept.count() == len(set(roots.values()))


def test_small_tiles_lose_no_link(spark):
    rng = random.Random(8)
    values = [rng.getrandbits(64) for _ in range(60)]
    values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values[:40]]
    values += [v ^ (1 << rng.randrange(64)) for v in values[60:90]]
    nodes = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in set(values)], "_fp long")
    got = {(r["node"] % (1 << 64)): r["root"] % (1 << 64) for r in simhash.components(simhash.forests(nodes, 2, tile=3)).collect()}
    want = slow_components(sorted(set(values)), 2)
    groups = Counter(want.values())
    assert set(got) == {v for v in want if groups[want[v]] > 1}
    assert len({(want[v], got[v]) for v in got}) == len({want[v] for v in got})


def test_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (5, 5)], "u long, v long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 99: 99, 100: 99}


def test_near_duplicates_of_nothing(empty):
    assert simhash.near_duplicates(empty).count() == 0


# sharding


def test_permutation_is_one(spark):
    for total in (1, 2, 3, 7, 50, 101, 1000, 1025):
        numbers = spark.range(total).select(sharding.permuted(F.col("id"), total, 77).alias("p")).collect()
        assert sorted(r["p"] for r in numbers) == list(range(total))


def test_sharding(spark, docs, empty):
    rows = sharding.shuffled(clashing(docs), 8).collect()
    source = docs.collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in source)
    assert sorted(r["row_number"] for r in rows) == list(range(len(source)))
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    counts = [len(slots.get(s, ())) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    again = sharding.shuffled(docs.repartition(5, "lang"), 8).collect()
    key = lambda r: (r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"])
    assert Counter(map(key, rows)) == Counter(map(key, again))
    assert Counter(r["shard"] for r in sharding.shuffled(docs, 8, key=1).collect()) == Counter(r["shard"] for r in rows)
    assert sharding.shuffled(empty).count() == 0


# personal data


def slow_base(text):
    def luhn(d):
        return sum((int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))) for i, c in enumerate(reversed(d))) % 10 == 0

    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
                "card": r"[0-9]([\x20-]?[0-9])+".replace("[\\x20-]", "[\x20-]"), "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    out = []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (16 <= len(d) <= 19 and luhn(d)) \
                    or kind == "phone" and not 8 <= len(d) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


CARD, IBAN = "4111 1111 1111 1111", "DE89 3704 0044 0532 0130 00"
PRIVATE = [
    "a.b%c@d-e.f.g%h@i.j, x@y, a@b@c.d", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 9999999999999999999999.1.1.1", f"{CARD} 4111-1111-1111-1112 {CARD} 1",
    "4111111111111111x 4111111111111111", "+1 (743) 555-3824. +12 +1234567 +12345678 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", f"x {IBAN} y {IBAN[:-1]}1",
    "\U0001f600 a@b.cd \U0001f600 1.1.1.1", "ssn 123-45-6789", "nothing 123-45-6789", "phone: (743) 555-3824", "see (743) 555-3824", "a@b.c" * 3, "@" * 50,
    "." * 3000 + "@", "1" * 5000, "a" * 5000 + "@b.c", "1 " * 3000, "+1" * 2000, "a@b" + ".c" * 3000, None, "", "4111 1111  1111 1111", "+1-+2-345678901",
]


def test_spans_match_brute_force(spark):
    rng = random.Random(6)
    texts = PRIVATE + ["".join(rng.choice("a1@.+- 4(") for _ in range(rng.randint(0, 70))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in pii.find_spans(clashing(rows)).collect()}
    for i, text in enumerate(texts):
        assert [s for s in got[i] if s[0] in pii.BASE] == slow_base(text), text


def test_validators_and_context(spark):
    rows = spark.createDataFrame([(t,) for t in PRIVATE if t], "text string")
    got = {r["text"]: {s["kind"]: s for s in r["spans"]} for r in pii.find_spans(rows).collect()}
    assert "social" in got["ssn 123-45-6789"] and not got["nothing 123-45-6789"]
    assert "local_phone" in got["phone: (743) 555-3824"] and not got["see (743) 555-3824"]
    ibans = next(v for t, v in got.items() if t.startswith("x DE89"))
    assert ibans["iban"]["hit"] == IBAN and ibans["iban"]["start"] == 2
    assert got["phone: (743) 555-3824"]["local_phone"]["score"] > 30


def test_redaction(spark):
    rows = spark.createDataFrame([("mail a@b.cd or 1.1.1.1!",), ("",), (None,)], "text string")
    out = pii.find_spans(rows).select(pii.redact(F.coalesce("text", F.lit("")), F.col("spans")).alias("t")).collect()
    assert [r["t"] for r in out] == ["mail <email> or <ip>!", "", ""]


def test_spans_of_nothing(empty):
    assert pii.find_spans(empty).count() == 0
