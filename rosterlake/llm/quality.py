"""Quality rules as a bitmask ledger.

Every measurement of a document is taken once, every rule is evaluated once, and what is kept is one integer of failure
bits beside the measurements. A policy is a version name and a mask over those bits, so changing a policy, comparing two
or asking what a rule costs never touches the texts again: it is bitwise arithmetic over the ledger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import SPACES, free, small_batches

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words", "n_marks")
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """One rule: its bit in the ledger and the condition, over a getter of measurements, under which a document fails."""

    bit: int
    name: str
    fails: Callable[[Callable[[str], Column]], Column]


def _over(part: str, percent: int, whole: str) -> Callable[[Callable[[str], Column]], Column]:
    return lambda m: m(part) * 100 > m(whole) * percent


#: Bits are for ever: a new rule takes the next bit, a changed threshold is a new rule.
RULES = (
    Rule(0, "few_words", lambda m: m("n_words") < 50),
    Rule(1, "repeated_words", _over("n_repeat_words", 50, "n_words")),
    Rule(2, "symbols", _over("n_symbols", 10, "n_words")),
    Rule(3, "repeated_lines", _over("n_dup_lines", 40, "n_lines")),
    Rule(4, "short_words", lambda m: m("word_chars") < m("n_words") * 2),
    Rule(5, "long_words", lambda m: m("word_chars") > m("n_words") * 14),
    Rule(6, "capitals", _over("n_upper_words", 50, "n_words")),
    Rule(7, "exclamations", _over("n_marks", 50, "n_words")),
)


def mask(*names: str) -> int:
    known = {r.name: r.bit for r in RULES}
    return sum(1 << known[n] for n in set(names))


#: Versioned policies; ``base`` is what any other policy contains.
POLICIES = {
    "base": mask("few_words", "repeated_words"),
    "2024-1": mask("few_words", "repeated_words", "symbols", "repeated_lines"),
    "2024-2": mask(*(r.name for r in RULES)),
}
CURRENT = "2024-2"


def measurements(text: str | None) -> tuple[int, ...]:
    """What the rules look at, in the order of ``MEASURES``."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    count = len(words)
    if not count:
        return (0,) * len(MEASURES)
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    windows = list(zip(words, words[1:], words[2:]))
    found: dict = {}
    repeated: set[int] = set()
    if len(set(windows)) < len(windows):
        for i, window in enumerate(windows):
            first = found.setdefault(window, i)
            if first != i:
                repeated.update((first, first + 1, first + 2, i, i + 1, i + 2))
    return (
        count, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
        len(repeated), sum(map(bytes.isupper, words)), text.count("!"),
    )


def ledger(docs: DataFrame, text: str = "text", into: str = "ledger") -> DataFrame:
    """``docs`` with a struct ``into``: the measurements and ``failures``, a bit for each rule that fails.

    One narrow pass over the texts and no shuffle. Null and empty texts measure zero everywhere and fail ``few_words``.
    Texts of any length are measured whole; an empty table gives an empty ledger. Repeated rows each get their own entry;
    every other column, whatever its name, is passed through, but a column named as ``into`` is replaced.
    """
    small_batches(docs.sparkSession)

    @F.pandas_udf(", ".join(f"{m} long" for m in MEASURES))
    def taken(column: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measurements(t) for t in column], columns=list(MEASURES), dtype="int64")

    measured = docs.withColumn(into, taken(F.col(f"`{text}`").cast("string")))

    def measure(name: str) -> Column:
        return F.col(f"`{into}`.{name}")

    failures = F.lit(0).cast("long")
    for rule in RULES:
        failures = failures.bitwiseOR(F.when(rule.fails(measure), F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn(into, F.struct(*[measure(m).alias(m) for m in MEASURES], failures.alias("failures")))


def passes(policy: str = CURRENT, failures: str = "ledger.failures") -> Column:
    """Whether a document keeps clear of every rule of a policy."""
    return F.col(failures).bitwiseAND(F.lit(POLICIES[policy])) == 0


def apply_policy(docs: DataFrame, policy: str = CURRENT, text: str = "text") -> DataFrame:
    """The documents a policy keeps, with the columns they came with."""
    into = free(docs, "ledger")
    return ledger(docs, text, into).filter(passes(policy, f"{into}.failures")).select(*[F.col(f"`{c}`") for c in docs.columns])


def ablations(entries: DataFrame, policies: dict[str, int] | None = None) -> DataFrame:
    """For each policy and each of its rules: documents it rejects, those that fail the rule, those that fail only this
    rule (what dropping the rule would bring back), and the other rules that fire beside it.

    The ledger is first counted by its failure bits, at most two to the number of rules rows whatever its size.
    """
    policies = POLICIES if policies is None else policies
    spark = entries.sparkSession
    masks = entries.groupBy(F.col("ledger.failures").alias("failures")).agg(F.count(F.lit(1)).alias("n"))
    tried = spark.createDataFrame(
        [(v, m, r.name, 1 << r.bit) for v, m in policies.items() for r in RULES if m >> r.bit & 1],
        "policy string, mask long, rule string, rule_bit long",
    )
    lists = F.array(*[
        F.struct(F.lit(v).alias("policy"), F.lit(m).cast("long").alias("mask"), F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("rule_bit"))
        for v, m in policies.items() for r in RULES if m >> r.bit & 1
    ])
    hit = F.col("failures").bitwiseAND(F.col("mask"))
    fired = hit.bitwiseAND(F.col("rule_bit")) != 0
    counts = masks.select("failures", "n", F.inline(lists)).groupBy("policy", "rule", "rule_bit").agg(
        F.sum(F.when(hit != 0, F.col("n")).otherwise(0)).alias("n_rejected"),
        F.sum(F.when(fired, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(hit == F.col("rule_bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.bit_or(F.when(fired, hit.bitwiseXOR(F.col("rule_bit"))).otherwise(F.lit(0).cast("long"))).alias("fired_beside"),
    )
    zero = F.lit(0).cast("long")
    return tried.select("policy", "rule", "rule_bit").join(counts, ["policy", "rule", "rule_bit"], "left").select(
        "policy", "rule", *[F.coalesce(F.col(c), zero).alias(c) for c in ("n_rejected", "n_failed", "n_only", "fired_beside")],
    )
