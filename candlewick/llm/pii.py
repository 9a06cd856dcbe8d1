"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Only built-in expressions. Per kind, matches are leftmost and do not overlap; a match that its
validator refuses is dropped and not tried again at other lengths. Positions are code points, ends
exclusive. The repetitions are possessive, which changes no match here (nothing follows them) and
keeps the regular-expression engine from recursing on long runs; ``\\G`` and the look-behind let a
run be tried from its start only, so long runs cost linear time.

Null and empty texts have no spans. Rows are judged one by one, so repeated rows and ties repeat
their result; an empty table gives an empty one. ``find`` replaces a column that has the result's name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Code points before and after a span in which context words count.
CONTEXT = 32

#: Spans with at least this score are kept.
ACCEPTED = 50

FOUND = "array<struct<start:int,end:int,match:string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(match: Column) -> Column:
    """The Luhn checksum over the digits."""
    return F.call_function("luhn_check", _digits(match))


def mod97(match: Column) -> Column:
    """ISO 7064 mod 97-10 over an account number: first four characters last, letters as 10 to 35."""
    plain = F.regexp_replace(match, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    values = F.transform(F.split(moved, ""), F.ascii)

    def step(rest: Column, code: Column) -> Column:
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(values, F.lit(0), step) == 1


def _digits_between(least: int, most: int) -> Callable[[Column], Column]:
    return lambda match: F.length(_digits(match)).between(least, most)


@dataclass(frozen=True)
class Kind:
    """``hint`` must occur in a text for the pattern to be tried. A span has the score ``score``, and
    ``raised`` more where ``context`` matches nearby."""

    name: str
    hint: str
    pattern: str
    valid: Callable[[Column], Column]
    score: int
    context: str
    raised: int
    base: bool = True


_LOCAL = "[A-Za-z0-9._%+-]"

KINDS = (
    Kind(
        "email", "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True), 80, r"(?i)mail|contact|write to", 20,
    ),
    Kind(
        "ip", "[0-9]\\.[0-9]", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: F.forall(F.split(m, r"\."), lambda x: x.rlike("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$")),
        60, r"(?i)\bip\b|host|server|address", 30,
    ),
    Kind(
        "card", "[0-9]{2}|[0-9][ -][0-9]", r"[0-9](?:[ -]?[0-9])++",
        lambda m: _digits_between(16, 19)(m) & luhn(m), 70, r"(?i)card|visa|karte|carte|tarjeta", 30,
    ),
    Kind(
        "phone", r"\+[0-9]", r"\+[0-9][ ().0-9-]+[0-9]",
        _digits_between(8, 15), 60, r"(?i)tel|phone|mobil|call|fax", 30,
    ),
    Kind(
        "iban", "[A-Z]{2}[0-9]{2}", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b",
        mod97, 60, r"(?i)iban|account|konto|compte|cuenta", 30, base=False,
    ),
    Kind(
        "card_short", "[0-9]{2}|[0-9][ -][0-9]", r"[0-9](?:[ -]?[0-9])++",
        lambda m: _digits_between(13, 15)(m) & luhn(m), 30, r"(?i)card|visa|karte|carte|tarjeta", 40, base=False,
    ),
    Kind(
        "phone_local", "[0-9]{2}|[0-9][ -][0-9]", r"[0-9](?:[ ./-]?[0-9])++",
        _digits_between(7, 12), 20, r"(?i)\b(?:tel|phone|telephone|telefon|t[ée]l[ée]phone|tel[ée]fono|mobile|fax)\b", 40,
        base=False,
    ),
)


def matches(text: Column, pattern: str) -> Column:
    """All matches of a pattern with their places. The gaps between them are what a split leaves."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    each = F.transform(found, lambda m, i: F.struct(F.length(F.get(gaps, i)).alias("gap"), m.alias("match")))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {FOUND})").alias("spans"))

    def step(state: Column, item: Column) -> Column:
        begins = state["at"] + item["gap"]
        ends = begins + F.length(item["match"])
        span = F.struct(begins.alias("start"), ends.alias("end"), item["match"].alias("match"))
        return F.struct(ends.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    return F.aggregate(each, start, step, lambda state: state["spans"])


def _scored(text: Column, kind: Kind) -> Column:
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int,score:int>>)")
    kept = F.filter(matches(text, kind.pattern), lambda x: kind.valid(x["match"]))

    def scored(span: Column) -> Column:
        before = F.greatest(span["start"] - CONTEXT, F.lit(0))
        left = F.substr(text, before + 1, span["start"] - before)
        right = F.substr(text, span["end"] + 1, F.lit(CONTEXT))
        near = F.concat(left, F.lit("\n"), right).rlike(kind.context)
        score = F.lit(kind.score) + F.when(near, F.lit(kind.raised)).otherwise(F.lit(0))
        return F.struct(
            F.lit(kind.name).alias("kind"), span["start"].alias("start"), span["end"].alias("end"), score.alias("score")
        )

    accepted = F.filter(F.transform(kept, scored), lambda x: x["score"] >= ACCEPTED)
    return F.when(text.rlike(kind.hint), accepted).otherwise(none)


def find(docs: DataFrame, text: str = "text", result: str = "personal") -> DataFrame:
    """All rows with an array of (kind, start, end, score), by kind in the order of ``KINDS``, then start.

    Spans of the kinds that are not base give way to any base span that they touch.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    base = F.concat(*[_scored(body, kind) for kind in KINDS if kind.base])
    more = F.concat(*[_scored(body, kind) for kind in KINDS if not kind.base])
    with_both = docs.withColumn("_candidates", F.struct(base.alias("base"), more.alias("more")))
    free = F.filter(
        F.col("_candidates.more"),
        lambda x: ~F.exists(F.col("_candidates.base"), lambda y: (x["start"] < y["end"]) & (y["start"] < x["end"])),
    )
    return with_both.withColumn(result, F.concat(F.col("_candidates.base"), free)).drop("_candidates")


def base_kinds() -> list[str]:
    return [kind.name for kind in KINDS if kind.base]
