"""Personal data: regular expressions propose spans, checksums confirm them, context adjusts a score.

DataFrame functions only. A span's place comes from splitting the text at a pattern: what stands
between the matches, and the matches themselves, laid end to end give each start. Patterns are
written without nested repeats that call themselves (possessive groups), and look behind where a run
could be tried from each of its characters, so that a text of any length takes time in proportion.

Kinds of the base rules come first (email, ip, card, phone) and stay whatever their score. Two kinds
are added: `iban`, which must pass the mod-97 check, and `nid`, a national number of nine digits in
groups, which has no check digit and needs a context word nearby.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL = "[A-Za-z0-9._%+-]"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str  # a pattern that the text must hold, tested first
    score: float
    helps: str  # words nearby that raise the score
    hurts: str  # words nearby that lower it
    least: float  # a span counts from this score on; 0 for the base rules


KINDS = (
    Kind("email", rf"(?:(?<!{LOCAL})|\G){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.8, "mail|contact|write", "example|test", 0.0),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, r"\bip\b|host|address|server", "version|release|section", 0.0),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", "[0-9]", 0.8, "card|visa|credit|payment", "isbn|order|serial", 0.0),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, "phone|call|tel|mobile|fax", "score|diff", 0.0),
    Kind("iban", r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b", "[A-Z]{2}[0-9]{2}", 0.8, "iban|account|bank", "order|serial", 0.5),
    Kind("nid", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "[0-9]-[0-9]{2}-[0-9]", 0.3, "ssn|social|security|insurance|national", "part|model|serial", 0.5),
)
BASE = tuple(k.name for k in KINDS[:4])
NEAR = 48
PART, PAGE = 256, 4096
HELP, HURT = 0.3, 0.2


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(s: Column) -> Column:
    """The digits, every second from the right doubled and its digits added, sum to a multiple of 10."""
    d = F.reverse(s)

    def step(total: Column, i: Column) -> Column:
        x = F.substring(d, i, F.lit(1)).cast("int")
        double = x * 2 - F.when(x > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, double).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), step) % 10 == 0


def mod97(s: Column) -> Column:
    """The first four characters moved to the end and letters read as 10 to 35, the number leaves 1."""
    plain = F.replace(s, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        c = F.substring(turned, i, F.lit(1))
        letter = F.ascii(c) - 55
        return F.when(letter >= 10, (rest * 100 + letter) % 97).otherwise((rest * 10 + c.cast("int")) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def small_part(s: Column) -> Column:
    """A part of an address: at most 255, leading zeros or not."""
    return s.rlike("^0*+(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$") | s.rlike("^0++$")


def confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), small_part)
    if kind == "card":
        return F.length(digits(m)).between(16, 19) & luhn(digits(m))
    if kind == "phone":
        return F.length(digits(m)).between(8, 15)
    if kind == "iban":
        return mod97(m)
    return m.isNotNull()


def matches(text: Column, kind: Kind) -> Column:
    """array<struct<start, end>> of the confirmed matches, in order, in code points."""
    between = F.split(text, kind.pattern, -1)
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["m"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        # Only a confirmed match lengthens the list: matches that fail may be very many.
        spans = F.when(confirmed(kind.name, x["m"]), F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    def moved(state: Column, x: Column) -> Column:
        spans = F.transform(x["spans"], lambda s: F.struct((s["start"] + state["at"]).alias("start"), (s["end"] + state["at"]).alias("end")))
        return F.struct((state["at"] + x["at"]).alias("at"), F.concat(state["spans"], spans).alias("spans"))

    def walked(p: Column) -> Column:
        """Runs of PART matches by themselves, then moved to their places: no list is copied for every match."""
        start = F.struct(F.lit(0).alias("at"), none.alias("spans"))
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / PART).cast("int")), lambda k: F.aggregate(F.slice(p, k * PART + 1, F.lit(PART)), start, step))
        return F.when(F.size(p) > 0, F.aggregate(parts, start, moved, lambda s: s["spans"])).otherwise(none)

    pairs = F.filter(F.zip_with(found, between, lambda m, gap: F.struct(m.alias("m"), gap.alias("gap"))), lambda p: p["m"].isNotNull())
    return F.when(text.rlike(kind.hint), F.transform(F.array(pairs), walked)[0]).otherwise(none)


def pages(text: Column) -> Column:
    """The text in pieces of PAGE code points, so that what stands at a place is found without a walk from the start."""
    return F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / PAGE).cast("int")), lambda k: F.substring(text, k * PAGE + 1, F.lit(PAGE)))


def scored(paged: Column, spans: Column, kind: Kind) -> Column:
    """The spans with their scores, those under the kind's least score left out."""

    def part(at: Column, length: Column) -> Column:
        page = F.floor(at / PAGE).cast("int")
        both = F.concat(F.get(paged, page), F.coalesce(F.get(paged, page + 1), F.lit("")))
        return F.substring(both, at - page * PAGE + 1, length)

    def rate(s: Column) -> Column:
        first = F.greatest(s["start"] - NEAR, F.lit(0))
        near = F.lower(F.concat_ws(" ", part(first, s["start"] - first), part(s["end"], F.lit(NEAR // 2))))
        up = F.when(near.rlike(kind.helps), HELP).otherwise(0.0)
        down = F.when(near.rlike(kind.hurts), HURT).otherwise(0.0)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), F.round(F.least(F.lit(kind.score) + up - down, F.lit(1.0)), 2).alias("score"))

    rated = F.transform(spans, rate)
    return F.filter(rated, lambda s: s["score"] >= kind.least) if kind.least else rated


def listed(kind: Kind) -> Column:
    return F.transform(F.col(kind.name), lambda s: F.concat_ws(":", F.lit(kind.name), s["start"].cast("string"), s["end"].cast("string")))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_email, n_ip, n_card, n_phone, n_iban, n_nid, base_sha256, spans, scores.

    `spans` lists kind:start:end by kind, then start, in code points; `scores` belongs to it, in
    the same order; `base_sha256` hashes the base kinds alone. A null or empty text has no spans and
    the hash of the empty string. Rows are independent: null or repeated ids stay as they are, one
    row each. Only the two named columns are read; an empty table gives no rows; long texts are
    searched whole.
    """
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select("*", pages(F.col("text")).alias("pages"), *(matches(F.col("text"), k).alias(f"raw_{k.name}") for k in KINDS))
    rows = rows.select(id_col, *(scored(F.col("pages"), F.col(f"raw_{k.name}"), k).alias(k.name) for k in KINDS))
    rows = rows.select("*", F.concat(*(listed(k) for k in KINDS[:4])).alias("base"), F.concat(*(listed(k) for k in KINDS)).alias("all"))
    counts = [F.size(k.name).cast("long").alias(f"n_{k.name}") for k in KINDS]
    scores = F.concat(*(F.transform(F.col(k.name), lambda s: s["score"]) for k in KINDS))
    return rows.select(id_col, *counts, F.sha2(F.array_join("base", ",").cast("binary"), 256).alias("base_sha256"), F.array_join("all", ",").alias("spans"), F.array_join(F.transform(scores, lambda x: x.cast("string")), ",").alias("scores"))
