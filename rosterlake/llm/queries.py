"""The registered queries of this subpackage, and the SQL that checks those SQL can express."""

from __future__ import annotations

import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterlake.llm import decontam, extract, interaction, lines, neighbours, packing, pii, quality, search, sharding, simhash, substrings, units
from rosterlake.llm.common import table

TOKENIZERS = "/opt/tokenizers"


def tokenizer_file(name: str = "word_bpe_49k.json", folder: str = TOKENIZERS) -> str:
    """Where a public vocabulary file is."""
    if folder not in sys.path:
        sys.path.append(folder)
    try:
        import public_tokenizers
    except ImportError:
        return f"{folder}/{name}"
    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return entries.select(
        "doc_id", *[F.col(f"ledger.{m}").alias(m) for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        (~quality.passes("base")).alias("base_failed"), (quality.passes("base") & quality.passes()).alias("kept"),
        F.col("ledger.failures").alias("failures"), F.lit(quality.CURRENT).alias("policy"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = units.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), by="sentence")
    spans = F.array_join(F.transform("units.spans", lambda s: F.concat_ws(":", s["start"], s["end"])), ",")
    return out.select("doc_id", F.col("units.n_units").cast("long").alias("n_units"), F.col("units.n_removed").cast("long").alias("n_removed"),
                      spans.alias("removed_spans"), F.col("text").alias("kept_text"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.without_repeated(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("spans")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    before = docs.withColumn("n_lines", F.size(F.split("text", "\n", -1)).cast("long"))
    out = lines.drop_boilerplate(before)
    left = F.when(F.col("text") == "", 0).otherwise(F.size(F.split("text", "\n", -1)))
    return out.select("doc_id", "source", "n_lines", left.cast("long").alias("n_kept"), F.col("text").alias("kept_text"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.leaks(docs, table(spark, sf_dir, "benchmark"), nameless=True).drop("_row")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file())
    return packing.pack(cut).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "fingerprint", "component_id")


def op9_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.shuffled(table(spark, sf_dir, "documents").select("doc_id", "text"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number")


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def listed(kinds: tuple[str, ...] | None):
        spans = F.col("spans") if kinds is None else F.filter("spans", lambda s: s["kind"].isin(*kinds))
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select("doc_id", *[count(k) for k in pii.BASE], F.sha2(listed(pii.BASE).cast("binary"), 256).alias("base_sha256"), listed(None).alias("spans"),
                        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"))


def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_substring_dedup, op3_suffix_dedup, op4_line_dedup, op5_html_extraction, op6_benchmark_decontamination,
        op7_best_fit_packing, op8_simhash_near_dedup, op9_feistel_sharding, op10_personal_data, op11_filter_interaction_audit, op12_ranked_search,
        op13_nearest_neighbours, pipeline)
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_BLANKS = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"

ORACLES: dict[str, str] = {
    "op1_quality_rules": f"""
        WITH split AS (
          SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
                 list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, {_BLANKS}) <> '') AS l
          FROM documents),
        places AS (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM split WHERE len(w) >= 3),
        windows AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM places),
        twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM windows) WHERE n > 1),
        repeated AS (SELECT r, count(DISTINCT i + d) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS d) GROUP BY r),
        measured AS (
          SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
                 length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
                 coalesce(repeated.n, 0) AS n_repeat_words,
                 len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper,
                 length(regexp_replace(t, '[^!]', '', 'g')) AS n_marks
          FROM split LEFT JOIN repeated USING (r)),
        judged AS (
          SELECT *, (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (100 * n_symbols > 10 * n_words)::INT
                 + 8 * (100 * n_dup_lines > 40 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 14 * n_words)::INT
                 + 64 * (100 * n_upper > 50 * n_words)::INT + 128 * (100 * n_marks > 50 * n_words)::INT AS failures
          FROM measured)
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, (failures & 3) <> 0 AS base_failed,
               failures = 0 AS kept, failures::BIGINT AS failures, '{quality.CURRENT}' AS policy
        FROM judged""",
    "op2_substring_dedup": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
        cut AS (SELECT r, doc_id, string_split(regexp_replace(regexp_replace(text, '([\\n。！？])', '\\1' || chr(1), 'g'),
                                                              '([.!?])([ \\t])', '\\1' || chr(1) || '\\2', 'g'), chr(1)) AS u FROM docs WHERE text <> ''),
        placed AS (SELECT r, doc_id, unnest(u) AS unit, unnest(generate_series(1, len(u))) AS k FROM cut),
        pieces AS (SELECT *, length(v) >= {units.MIN_CHARS} AS own FROM (
          SELECT *, sum(length(unit)) OVER (PARTITION BY r ORDER BY k) AS upto, trim(regexp_replace(lower(unit), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) AS v FROM placed)),
        runs AS (SELECT *, sum(own::INT) OVER (PARTITION BY r ORDER BY k) AS run FROM pieces),
        stretches AS (SELECT *, coalesce(sum(CASE WHEN own OR v = '' THEN 0 ELSE length(v) + 1 END) OVER (
                        PARTITION BY r, run ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // {units.TOGETHER} AS stretch FROM runs),
        spans AS (SELECT r, doc_id, min(k) AS k, string_agg(unit, '' ORDER BY k) AS unit, max(upto) AS e, coalesce(string_agg(v, ' ' ORDER BY k) FILTER (v <> ''), '') AS v
                  FROM stretches GROUP BY r, doc_id, run, own, stretch HAVING string_agg(unit, '') <> ''),
        counted AS (SELECT r, doc_id, k, e - length(unit) AS s, v, row_number() OVER (PARTITION BY r ORDER BY k) AS i,
                           sum(length(v) + 1) OVER (PARTITION BY r ORDER BY k) AS total FROM spans WHERE v <> ''),
        lists AS (SELECT r, list(v ORDER BY i) AS vs, list_prepend(0, list(total ORDER BY i)) AS sums FROM counted GROUP BY r),
        firsts AS (SELECT c.*, vs, sums, greatest(1, len(list_filter(sums, lambda x: x <= total - 1 - {units.CONTEXT}))) AS f FROM counted c JOIN lists USING (r)),
        keyed AS (SELECT r, doc_id, k, s, CASE WHEN length(v) >= {units.MIN_CHARS} THEN v ELSE (i - f) || chr(2) || array_to_string(
                           vs[f:CASE WHEN total - sums[f] > {units.CONTEXT} THEN i
                                     ELSE greatest(i, least(len(vs), len(list_filter(sums, lambda x: x < {units.CONTEXT} + 1)))) END], chr(10)) END AS key FROM firsts),
        gone AS (SELECT r, k FROM (SELECT r, k, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS LAST, r, s) AS nth FROM keyed) WHERE nth > 1),
        kept AS (SELECT p.r, count(*) AS n_units, count(g.k) AS n_removed,
                        string_agg((p.e - length(p.unit))::BIGINT || ':' || p.e::BIGINT, ',' ORDER BY p.k) FILTER (g.k IS NOT NULL) AS removed_spans,
                        string_agg(p.unit, '' ORDER BY p.k) FILTER (g.k IS NULL) AS kept_text
                 FROM spans p LEFT JOIN gone g ON p.r = g.r AND p.k = g.k GROUP BY p.r)
        SELECT doc_id, coalesce(n_units, 0)::BIGINT AS n_units, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(removed_spans, '') AS removed_spans,
               CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept_text, '') END AS kept_text
        FROM docs LEFT JOIN kept USING (r)""",
    "op4_line_dedup": f"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
        placed AS (SELECT r, source, unnest(l) AS line, unnest(generate_series(1, len(l))) AS k FROM docs),
        trimmed AS (SELECT *, trim(line, {_BLANKS}) AS v FROM placed),
        first AS (SELECT source, min(r) AS r FROM docs GROUP BY source, coalesce(text, '')),
        pages AS (SELECT source, count(*) AS pages FROM first GROUP BY source),
        often AS (SELECT t.source, t.v FROM trimmed t JOIN first f ON t.r = f.r JOIN pages p ON t.source IS NOT DISTINCT FROM p.source
                  WHERE t.v <> '' GROUP BY t.source, t.v, p.pages
                  HAVING count(DISTINCT t.r) >= {lines.MIN_PAGES} AND count(DISTINCT t.r) > p.pages * {lines.RATIO}::DOUBLE),
        marked AS (SELECT t.*, o.v IS NOT NULL AS gone FROM trimmed t LEFT JOIN often o ON t.source IS NOT DISTINCT FROM o.source AND t.v = o.v),
        kept AS (SELECT r, string_agg(line, chr(10) ORDER BY k) FILTER (NOT gone) AS kept_text FROM marked GROUP BY r)
        SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE len(l) END::BIGINT AS n_lines,
               CASE WHEN text IS NULL THEN NULL WHEN coalesce(kept_text, '') = '' THEN 0
                    ELSE len(string_split(kept_text, chr(10))) END::BIGINT AS n_kept,
               CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept_text, '') END AS kept_text
        FROM docs JOIN kept USING (r)""",
    "op11_filter_interaction_audit": f"""
        WITH docs AS (SELECT coalesce(source, '') AS part, doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
        first AS (SELECT t, min(doc_id) AS first_id FROM docs GROUP BY t),
        marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
        masks AS (
          SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                 (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
                 + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
                 + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > first_id, false)::INT AS mask
          FROM docs JOIN first USING (t) LEFT JOIN marks USING (doc_id)),
        counted AS (SELECT part, good, toxic, mask, count(*) AS n FROM masks GROUP BY ALL),
        letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
        orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
                   FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31
                   AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
        steps AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
                  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        tried AS (
          SELECT part, filter_order, step, bit, coalesce(sum(n) FILTER (mask & (before + bit) = 0), 0) AS kept,
                 coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0) AS removed,
                 coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0) AS redundant,
                 coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
                 coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0 AND good), 0) AS good_lost,
                 coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0 AND toxic), 0) AS toxic_lost
          FROM counted, steps GROUP BY ALL)
        SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
               unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
               (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
        FROM tried""",
    "op12_ranked_search": r"""
        WITH cut AS (SELECT row_number() OVER () AS r, doc_id,
                            regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        docs AS (SELECT r, doc_id, w, len(w) AS n FROM cut WHERE len(w) > 0),
        size AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM docs),
        postings AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t),
        weights AS (SELECT t, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
                    FROM postings, size GROUP BY t),
        items AS (SELECT row_number() OVER () AS item, item_id,
                         list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms FROM benchmark),
        asked AS (SELECT item, item_id, unnest(terms) AS t FROM items),
        scored AS (
          SELECT item, item_id, r, doc_id,
                 sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))))::BIGINT AS score
          FROM asked JOIN postings USING (t) JOIN weights w USING (t) JOIN docs USING (r), size GROUP BY ALL),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
        SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
