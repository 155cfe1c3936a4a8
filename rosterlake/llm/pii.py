"""Personal data: patterns propose spans, validators confirm them, words nearby raise or lower the score.

All of it is Spark expressions over one text column: no shuffle, no Python. Patterns are written so that they run in time
linear in the text: a run of characters is entered at its start only and is taken possessively, which finds the same
leftmost matches as the plain pattern.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterlake.llm.common import free, text_or_empty

SPAN = "struct<kind:string,start:long,end:long,hit:string,score:int>"

#: A span of a kind that needs it must reach this score.
THRESHOLD = 60
#: Characters on either side in which context words count.
NEARBY = 48


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """The mod-10 checksum over a string of digits."""
    def step(total: Column, at: Column) -> Column:
        value = F.substring(digits, F.length(digits) - at, F.lit(1)).cast("int")
        twice = value * 2
        return total + F.when(at % 2 == 0, value).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), step) % 10 == 0


def mod97(code: Column) -> Column:
    """The account number checksum: country and check digits go last, letters count from 10, the rest must be 1."""
    plain = F.regexp_replace(code, " ", "")
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))

    def step(rest: Column, at: Column) -> Column:
        value = F.ascii(F.substring(moved, at, F.lit(1)))
        return F.when(value < 58, (rest * 10 + value - 48) % 97).otherwise((rest * 100 + value - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _phone_digits(hit: Column) -> Column:
    return F.length(_digits(hit)).between(8, 15)


def _social(hit: Column) -> Column:
    return ~hit.rlike("^(?:000|666|9)|-00-|-0000$")


@dataclass(frozen=True)
class Kind:
    """One kind of span. ``confirmed`` must hold; a kind that is ``scored`` must reach the threshold as well."""

    name: str
    pattern: str
    confirmed: Callable[[Column], Column]
    base: int
    context: str
    scored: bool = False


#: The order of the kinds is the order of the spans. Octets of an address may have leading zeros.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda _: F.lit(True), 90,
         "mail|contact|write to|correo|kontakt"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda h: h.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"), 60, r"\bip\b|address|host|server|login"),
    Kind("card", r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}(?![ -]?[0-9])", lambda h: luhn(_digits(h)), 80,
         "card|visa|master|amex|credit|debit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", _phone_digits, 70, "phone|call|tel|mobile|fax|whatsapp"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", mod97, 70,
         "iban|bank|account|transfer|konto|cuenta|compte", scored=True),
    Kind("social", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", _social, 30, "ssn|social security|tax id|taxpayer", scored=True),
    Kind("local_phone", r"(?<![0-9+(])(?<![0-9+] )\([0-9]{3}\) ?[0-9]{3}[ -][0-9]{4}(?![0-9])", lambda _: F.lit(True), 30,
         "phone|call|tel|mobile|fax|whatsapp", scored=True),
)
BASE = ("email", "ip", "card", "phone")
#: Words nearby that speak against a span of any kind.
AGAINST = "example only|sample|dummy|fictitious|version|isbn|order no"


def _located(text: Column, kind: Kind) -> Column:
    """Matches with their places: the pieces between matches and the matches themselves are measured in turn."""
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.split(text, kind.pattern, -1)
    pairs = F.arrays_zip(hits.alias("hit"), F.slice(gaps, F.lit(1), F.size(hits)).alias("gap"))
    none = F.lit(None).cast("string")
    empty = F.filter(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.lit(0).cast("long").alias("end"), none.alias("hit"))), lambda _: F.lit(False))

    def step(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(start.cast("long").alias("start"), end.cast("long").alias("end"), pair["hit"].alias("hit"))
        return F.struct(end.cast("long").alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    found = F.aggregate(pairs, F.struct(F.lit(0).cast("long").alias("at"), empty.alias("out")), step, lambda s: s["out"])
    return F.when(text.rlike(kind.pattern), found).otherwise(empty)


def _scored(text: Column, kind: Kind, span: Column) -> Column:
    """The kind's own score, plus 30 for a context word nearby, less 30 for a word that speaks against it."""
    before = F.substring(text, F.greatest(span["start"] - NEARBY, F.lit(0)).cast("int") + 1,
                         F.least(span["start"], F.lit(NEARBY)).cast("int"))
    after = F.substring(text, span["end"].cast("int") + 1, F.lit(NEARBY))
    near = F.lower(F.concat(before, F.lit("\n"), after))
    return (F.lit(kind.base) + F.when(near.rlike(kind.context), 30).otherwise(0) - F.when(near.rlike(AGAINST), 30).otherwise(0)).cast("int")


def _spans(text: Column, kind: Kind) -> Column:
    confirmed = F.filter(_located(text, kind), lambda s: kind.confirmed(s["hit"]))
    scored = F.transform(confirmed, lambda s: F.struct(
        F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["hit"].alias("hit"), _scored(text, kind, s).alias("score")))
    return F.filter(scored, lambda s: s["score"] >= THRESHOLD) if kind.scored else scored


def find_spans(docs: DataFrame, text: str = "text", into: str = "spans") -> DataFrame:
    """``docs`` with an array of spans (kind, start, end, hit, score); places count code points, the end is exclusive.

    Kinds of ``BASE`` are reported whenever their check passes, the score tells how sure it is; the other kinds must
    reach ``THRESHOLD`` and must not overlap a base span. Null and empty texts have no spans. Repeated rows each get
    theirs. A column named like ``into`` is replaced, all others pass through.
    """
    whole, first, more = free(docs, "_text"), free(docs, "_base"), free(docs, "_added")
    found = docs.withColumn(whole, text_or_empty(f"`{text}`"))
    base = [k for k in KINDS if k.name in BASE]
    added = [k for k in KINDS if k.name not in BASE]
    found = found.withColumn(first, F.concat(*[_spans(F.col(whole), k) for k in base]))
    found = found.withColumn(more, F.concat(*[_spans(F.col(whole), k) for k in added]))
    clear = F.filter(more, lambda s: ~F.exists(first, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return found.withColumn(into, F.concat(first, clear)).drop(whole, first, more)


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans are joined by the first."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        new = s["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.when(new, F.concat(state["out"], gap, F.lit("<"), s["kind"], F.lit(">"))).otherwise(state["out"]).alias("out"))

    return F.aggregate(ordered, F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")), step,
                       lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))))
