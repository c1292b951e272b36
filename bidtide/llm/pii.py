"""Personal data: patterns propose spans, checksums confirm them, context words adjust their score. Expressions only.

Base kinds are email, ip, card (Luhn) and phone, leftmost and non-overlapping each; a proposal that fails its check is
dropped as a whole. The method adds iban (mod-97) and ssn (needs a context word near it). Base spans always stay.

The patterns are the plain ones made safe for texts of any length: repeated groups are possessive, which Java matches
in a loop, and a run of characters is entered only at its first one (or where the last match ended), so a long run is
read once. Positions count code points, from the lengths of what lies between matches.

Defined results: null and empty texts have no spans; overlapping spans of different kinds are all given; repeated rows
are judged alike; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LOCAL = "[A-Za-z0-9._%+-]"
_CARD_START = r"(?<![0-9])(?<![0-9][\x20-])"
_CONTEXT = 40
_THRESHOLD = 0.6
_SPAN = "array<struct<kind:string,start:int,end:int,score:double>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _number(chars: Column, step) -> Column:
    return F.aggregate(F.split(chars, ""), F.lit(0), step)


def luhn(match: Column) -> Column:
    """Whether a match's digits pass the Luhn check; every second one counts double, from the right."""
    def step(total: Column, digit: Column) -> Column:
        # The sum and whether the next digit is doubled, in one number.
        value, odd = digit.cast("int"), total % 2
        doubled = F.when(value > 4, value * 2 - 9).otherwise(value * 2)
        return total + F.when(odd == 1, doubled).otherwise(value) * 2 + F.when(odd == 1, -1).otherwise(1)

    return F.floor(_number(F.reverse(_digits(match)), step) / 2) % 10 == 0


def mod97(match: Column) -> Column:
    """Whether an account number leaves 1 when divided by 97, its first four characters moved to the end."""
    plain = F.upper(F.regexp_replace(match, " ", ""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    return _number(turned, lambda n, c: F.when(c.rlike("[0-9]"), n * 10 + F.coalesce(c.try_cast("int"), F.lit(0))).otherwise(n * 100 + F.ascii(c) - 55) % 97) == 1


@dataclass(frozen=True)
class Kind:
    """A pattern, a cheap test that a text may hold it, a check of matches, and how matches score."""

    name: str
    pattern: str
    hint: str
    check: object
    score: float
    context: str | None = None


BASE = [
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda m: F.lit(True), 1.0),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]", lambda m: m.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9]?)(?:\.|$)){4}$"), 0.9),
    Kind("card", _CARD_START + r"[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])", r"[0-9](?:[\x20-]?[0-9]){12}", luhn, 1.0),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", lambda m: F.length(_digits(m)).between(9, 15), 0.9),
]
ADDED = [
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", mod97, 0.9, r"\b(?:iban|account|konto|compte|cuenta)\b"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "[0-9]{3}-[0-9]{2}-[0-9]{4}", lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"), 0.4, r"\b(?:ssn|social security|tax id)\b"),
]


def _spans(text: Column, kind: Kind) -> Column:
    gaps, hits = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    none = F.array().cast(_SPAN)
    start = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def place(done: Column, pair: Column) -> Column:
        begin = done["at"] + F.length(pair["gap"])
        end = begin + F.length(pair["hit"])
        score = F.lit(kind.score)
        if kind.context:
            near = F.lower(F.substring(text, F.greatest(begin - _CONTEXT, F.lit(0)) + 1, F.lit(2 * _CONTEXT) + F.length(pair["hit"])))
            score = score + F.when(near.rlike(kind.context), 0.3).otherwise(0.0)
        span = F.struct(F.lit(kind.name).alias("kind"), begin.alias("start"), end.alias("end"), score.alias("score"))
        # Appending costs the spans before it, so failing proposals add nothing.
        return F.struct(end.alias("at"), F.when(kind.check(pair["hit"]), F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    found = F.aggregate(pairs, start, place, lambda done: F.filter(done["spans"], lambda s: s["score"] >= _THRESHOLD))
    hint = text.contains(kind.hint) if kind.hint == "@" else text.rlike(kind.hint)
    return F.when(hint, found).otherwise(none)


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document: doc_id and, for every kind, an array of (kind, start, end, score)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", text.alias("text")).select("doc_id", *[_spans(F.col("text"), kind).alias(kind.name) for kind in BASE + ADDED])


def listed(kinds: list[Kind]) -> Column:
    """``kind:start:end`` of all spans, comma-joined in the kinds' order."""
    every = F.concat(*[F.col(k.name) for k in kinds])
    return F.concat_ws(",", F.transform(every, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(docs: DataFrame, column: str = "redacted") -> DataFrame:
    """doc_id and the text with every span (overlapping ones as one) replaced by its kind in angle brackets."""
    found = personal_data(docs.withColumn("doc_id", F.struct("doc_id", F.coalesce("text", F.lit("")).alias("text")))).withColumnRenamed("doc_id", "of")
    spans = F.array_sort(F.transform(F.concat(*[F.col(k.name) for k in BASE + ADDED]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.col("of.text")

    def cut(done: Column, s: Column) -> Column:
        fresh = F.concat(done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit("<"), s["kind"], F.lit(">"))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.when(s["start"] >= done["at"], fresh).otherwise(done["out"]).alias("out"))

    whole = F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), cut, lambda done: F.concat(done["out"], F.substr(text, done["at"] + 1)))
    return found.select("of.doc_id", whole.alias(column))
