"""Personal data: patterns propose spans, validators confirm them, context words adjust a score.

Spans are in code points, end exclusive. The positions come from the text between the matches: the pieces
that `split` leaves and the matches that `regexp_extract_all` finds alternate, so running sums of
their lengths are the offsets. Everything runs on column functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, let, table, whole

#: Characters before and after a span in which context words count.
NEAR = 40
#: Added kinds stay from this score on; base kinds always stay.
ENOUGH = 0.5


@dataclass(frozen=True)
class Kind:
    name: str
    #: What a match is.
    pattern: str
    #: A cheap test that every text with a match passes.
    guard: str
    score: float
    context: str
    added: bool = False
    #: The same matches, found without backtracking: a run of characters is tried at its start only, as its other
    #: places fail in the same way, and repeated groups don't give back what they took.
    fast: str = ""


# The patterns of the four base kinds.
KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "@", 0.9, "mail|contact|write|address",
         fast=r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)++"),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]\.[0-9]", 0.6, "ip|host|server|address",
         fast=r"(?:\G|(?<![0-9]))[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", r"[0-9][\x20-]?[0-9]", 0.8, "card|visa|credit|pay|account",
         fast=r"[0-9]([\x20-]?[0-9])++"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, "phone|tel|call|mobile|fax"),
    Kind("iban", r"\b[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]{4}){2,7}(\x20?[A-Z0-9]{1,3})?\b", r"[A-Z]{2}[0-9]{2}", 0.9, "iban|bank|account|konto", True),
    Kind("ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", r"[0-9]-[0-9]{2}-[0-9]", 0.3, "ssn|social|security", True),
)
BASE = tuple(k.name for k in KINDS if not k.added)


def digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substr(number, F.char_length(number) - i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.sequence(F.lit(0), F.char_length(number) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code passes the mod-97 check: four characters moved to the end, letters as 10 to 35."""
    moved = F.concat(F.substring(code, 5, 1000), F.substring(code, 1, 4))

    def step(rest: Column, c: Column) -> Column:
        value = F.conv(c, 36, 10).cast("int")
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.split(moved, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(step(r, c))) == 1


def valid(kind: str, found: Column) -> Column:
    count = F.char_length(digits(found))
    if kind == "ip":
        # Of any number of digits: without leading zeros at most three, and those at most 255.
        part = lambda p: F.regexp_replace(p, "^0+", "")
        small = lambda p: (F.char_length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(found, r"\."), small)
    if kind == "card":
        return F.when(count.between(13, 19), luhn(digits(found))).otherwise(False)
    if kind == "phone":
        return count.between(9, 15)
    if kind == "iban":
        return mod97(F.replace(found, F.lit(" "), F.lit("")))
    return F.lit(True)


def spans_of(kind: Kind, text: Column) -> Column:
    """Array of (kind, start, end, score) of the confirmed matches, by start."""

    def located(found: Column, pieces: Column) -> Column:
        # (position after the last match, spans so far); pieces and matches alternate.
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,match:string,i:int>>").alias("out"))

        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.char_length(F.get(pieces, i))
            end = begin + F.char_length(F.get(found, i))
            span = F.struct(begin.alias("start"), end.alias("end"), F.get(found, i).alias("match"), i.alias("i"))
            return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

        order = F.when(F.size(found) > 0, F.sequence(F.lit(0), F.size(found) - 1)).otherwise(F.array().cast("array<int>"))
        every = F.aggregate(order, start, step, lambda acc: acc["out"])
        confirmed = F.filter(every, lambda s: valid(kind.name, s["match"]))

        def scored(s: Column) -> Column:
            around = F.concat(F.right(F.get(pieces, s["i"]), F.lit(NEAR)), F.lit(" "), F.left(F.get(pieces, s["i"] + 1), F.lit(NEAR)))
            near = F.rlike(ascii_lower(around), F.lit(rf"\b({kind.context})"))
            score = F.round(F.least(F.lit(1.0), kind.score + F.when(near, 0.3).otherwise(0.0)), 2)
            return F.struct(F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score.alias("score"))

        spans = F.transform(confirmed, scored)
        return F.filter(spans, lambda s: s["score"] >= ENOUGH) if kind.added else spans

    pattern = kind.fast or kind.pattern
    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    proposed = let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: let(F.split(text, pattern, -1), lambda pieces: located(found, pieces)),
    )
    guard = F.contains(text, F.lit("@")) if kind.guard == "@" else F.rlike(text, F.lit(kind.guard))
    return F.when(guard, proposed).otherwise(none)


def find(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: `id` and `spans`, an array of (kind, start, end, score).

    Spans are ordered by kind as in KINDS and then by start. Null and empty texts have none; rows that repeat are
    handled one by one; other columns are ignored; no rows give no rows.
    """
    text = whole(text_col)
    return df.select(F.col(id_col).alias("id"), F.concat(*(spans_of(k, text) for k in KINDS)).alias("spans"))


def listed(spans: Column, with_score: bool = False) -> Column:
    def one(s: Column) -> Column:
        parts = [s["kind"], s["start"].cast("string"), s["end"].cast("string")]
        return F.concat_ws(":", *parts, *([s["score"].cast("string")] if with_score else []))

    return F.array_join(F.transform(spans, one), ",")


def op3_pii(spark, sf_dir) -> DataFrame:
    rows = find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return rows.select(
        F.col("id").alias("doc_id"),
        *(count(kind) for kind in BASE),
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        listed(F.col("spans"), True).alias("scored"),
    )
