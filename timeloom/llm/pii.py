"""Personal data in texts, with DataFrame functions only (operator 4).

Regular expressions propose spans, checksums and ranges confirm them (Luhn,
mod 97, octets, digit counts), and words near a span raise its score. Base
kinds (email, ip, card, phone) stay once confirmed; the added kinds (iban, ssn)
stay from a score on. Positions count code points, ends are exclusive.

The patterns are the plain ones with possessive quantifiers and a guard at the
start, so that a long run of one kind of character costs linear time: a match
can begin only where a run begins, or where the last match ended.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE_KINDS = KINDS[:4]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
#: A text without a match for this has no span of the kind.
HINTS = {"email": r"@[A-Za-z0-9-]", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]"}
#: Score of a confirmed span, and words that raise it within NEAR code points before it.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7, "iban": 0.8, "ssn": 0.4}
CONTEXT = {
    "email": "mail|contact|write", "ip": "ip|address|host|server", "card": "card|visa|credit|karte|carte|tarjeta", "phone": "phone|call|tel|mobile",
    "iban": "iban|account|bank|konto|compte|cuenta", "ssn": "ssn|social|security",
}
NEAR, RAISE, ACCEPT = 48, 0.2, 0.6
#: Length of the runs that prefix sums are built from, and of the pieces that a text with spans is read in.
RUN, PIECE = 128, 2048


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body with value computed once."""
    return F.transform(F.array(value), body)[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_valid(digits: Column) -> Column:
    """Does a string of digits pass Luhn's check?"""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def mod97_valid(iban: Column) -> Column:
    """Does an IBAN without spaces leave 1 modulo 97?"""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(rest: Column, ch: Column) -> Column:
        code = F.ascii(ch)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        def octet(part: Column) -> Column:
            short = F.regexp_replace(part, "^0+", "")
            return (F.length(short) <= 3) & (F.coalesce(F.when(F.length(short) <= 3, short).try_cast("int"), F.lit(0)) <= 255)

        return F.forall(F.split(match, r"\."), octet)
    if kind == "card":
        n = F.length(_digits(match))
        return F.when(n.between(14, 19), _let(_digits(match), luhn_valid)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return _let(F.replace(match, F.lit(" "), F.lit("")), lambda m: F.when(F.length(m).between(15, 34), mod97_valid(m)).otherwise(F.lit(False)))
    if kind == "ssn":
        return ~match.rlike("^(000|666|9)") & ~match.rlike("^...-00") & ~match.rlike("0000$")
    return F.lit(True)


def _before(values: Column, pick: Callable[[Column, Column], Column]) -> Column:
    """For each of values (whole numbers from 0 on) what pick makes of all before it, 0 for the first: in runs, so that many values cost little more than a few."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), pick)

    def from_values(v: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / RUN).cast("int")), lambda r: total(F.slice(v, r * RUN + 1, F.lit(RUN))))
        bases = _let(runs, lambda t: F.transform(t, lambda _, r: total(F.slice(t, F.lit(1), r))))
        return _let(bases, lambda b: F.transform(v, lambda _, i: pick(F.element_at(b, F.floor(i / RUN).cast("int") + 1), total(F.slice(v, F.floor(i / RUN).cast("int") * RUN + 1, i % RUN)))))

    return _let(values, from_values)


def _starts(found: Column, gaps: Column) -> Column:
    """Code point at which each match begins."""
    steps = F.transform(found, lambda m, i: F.length(gaps[i]) + F.length(m))
    return _let(_before(steps, lambda a, x: a + x), lambda before: F.transform(before, lambda at, i: at + F.length(gaps[i])))


def _pieces(text: Column) -> Column:
    """text in pieces of PIECE code points: a part of it is then read without going through all that stands before."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def _part(pieces: Column, start: Column, end: Column) -> Column:
    """Code points start to end (exclusive) of a text in pieces."""

    def cut(i: Column) -> Column:
        lo = F.greatest(start - i * PIECE, F.lit(0))
        return F.substr(F.element_at(pieces, i + 1), lo + 1, F.least(end - i * PIECE, F.lit(PIECE)) - lo)

    first, last = F.floor(start / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
    inner = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return F.when(end <= start, F.lit("")).when(first == last, cut(first)).otherwise(F.concat(cut(first), inner, cut(last)))


def _spans_of(kind: str, text: Column) -> Column:
    """array<struct<start, ord, kind, end, value, score>> of one kind."""
    pattern, order = PATTERNS[kind], KINDS.index(kind)

    def located(p: Column) -> Column:
        found, gaps = p["found"], p["gaps"]

        def span(begin: Column, i: Column) -> Column:
            value = found[i]
            near = F.lower(_part(p["pieces"], F.greatest(begin - NEAR, F.lit(0)), begin))
            score = F.lit(SCORES[kind]) + F.when(near.rlike(rf"\b(?:{CONTEXT[kind]})"), F.lit(RAISE)).otherwise(F.lit(0.0))
            return F.struct(begin.alias("start"), F.lit(order).alias("ord"), F.lit(kind).alias("kind"), (begin + F.length(value)).alias("end"), value.alias("value"), F.least(score, F.lit(1.0)).alias("score"))

        return _let(_starts(found, gaps), lambda s: F.transform(s, span))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = _let(found, lambda f: F.when(F.size(f) > 0, _let(F.struct(f.alias("found"), F.split(text, pattern, -1).alias("gaps"), _pieces(text).alias("pieces")), located)))
    kept = F.filter(spans, lambda s: _confirmed(kind, s["value"]) & ((s["score"] >= ACCEPT) if kind not in BASE_KINDS else F.lit(True)))
    return F.when(text.rlike(HINTS[kind]), kept)


def find_private_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with a column pii_spans: array of struct (start, ord, kind, end, value, score), by start, then kind as in KINDS.

    Null and empty texts have no spans. A column pii_spans of docs is replaced.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    found = [F.coalesce(_spans_of(k, body), F.array().cast("array<struct<start:int,ord:int,kind:string,end:int,value:string,score:double>>")) for k in KINDS]
    return docs.withColumn("pii_spans", F.array_sort(F.concat(*found)))


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redacted(text: Column, spans: Column) -> Column:
    """text with each span replaced by its kind in brackets; of overlapping spans the first names the whole."""

    def joined(pieces: Column) -> Column:
        # What overlaps is one span from the first one's start to the furthest end.
        ends = _before(F.transform(spans, lambda s: s["end"]), lambda a, x: F.greatest(a, x))
        marked = F.transform(F.arrays_zip(spans.alias("s"), ends.alias("done")), lambda x: F.struct(x["done"].alias("done"), x["s"]["start"].alias("start"), x["s"]["kind"].alias("kind")))
        marks = F.transform(F.filter(marked, lambda x: x["start"] >= x["done"]), lambda x: F.concat(_part(pieces, x["done"], x["start"]), F.lit("["), F.upper(x["kind"]), F.lit("]")))
        return F.concat(F.array_join(marks, ""), _part(pieces, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text)))

    return F.when(F.size(spans) > 0, _let(_pieces(text), joined)).otherwise(text)
