"""Personal data in texts, with SQL functions only.

Regular expressions propose spans: e-mail addresses, IPv4 addresses, payment
cards, phone numbers and IBANs. Validators confirm them: address parts, digit
counts, the Luhn checksum, mod 97. Words shortly before a span raise or lower
its score; a confirmed span stays whatever its score, callers may filter.

Positions come from the pieces between the matches (``split`` by the same
pattern): a match starts where the pieces and matches before it end. Starts
and ends are code points, the end exclusive. The patterns use possessive
quantifiers and only start where a run of their first characters starts (or
where the last match ended), so a long run is read once; the matches are those
of the plain patterns. A cheap test keeps texts without a kind from its
patterns.

Everything is a projection of the row: no shuffle, no Python.

Edge cases: a null text counts as empty; both have no spans; repeated rows
each get theirs; other columns pass through (columns named like the added
ones are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

KINDS = ("email", "ip", "card", "phone", "iban")
#: The base patterns, as the contract states them, in possessive form.
PATTERN = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
}
#: A text that does not contain this has no match of the kind.
GATE = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": "+", "iban": r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"}
SCORE = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.95}
#: Words that, up to CONTEXT code points before a span, speak for or against its kind.
CONTEXT = 40
FOR = {"email": "mail|contact|write|reach", "ip": "address|host|server|login|client", "card": "card|visa|master|amex|pay|credit|debit", "phone": "phone|call|tel|mobile|fax|dial|contact", "iban": "iban|bank|account|transfer"}
AGAINST = {"email": "example|sample", "ip": "version|release|build|section|chapter", "card": "isbn|order|serial|tracking|part", "phone": "isbn|serial|version|coordinate", "iban": "part|model|serial"}


def _found(text: Column, kind: str) -> Column:
    gate = F.contains(text, F.lit(GATE[kind])) if kind in ("email", "phone") else text.rlike(GATE[kind])
    none = F.expr("cast(array() as array<string>)")
    return F.when(gate, F.struct(F.regexp_extract_all(text, F.lit(PATTERN[kind]), F.lit(0)).alias("m"), F.split(text, PATTERN[kind], -1).alias("g"))).otherwise(F.struct(none.alias("m"), none.alias("g")))


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _mod97(plain: Column) -> Column:
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    step = lambda a, c: F.when(c.between("0", "9"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(F.split(turned, ""), F.lit(0), step) == 1


def _confirmed(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return m.rlike(rf"^{part}(?:\.{part}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(m, r"[\x20-]", "")
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)
    if kind == "iban":
        plain = F.replace(m, F.lit(" "), F.lit(""))
        return F.when(F.length(plain).between(15, 34), _mod97(plain)).otherwise(False)
    return F.lit(True)


def _spans(kind: str, found: Column) -> Column:
    """Confirmed spans of a kind as array<struct<kind, start, end, score>>."""
    m, g = found["m"], found["g"]
    sizes = F.transform(m, lambda x, i: F.struct(F.length(F.get(g, i)).cast("bigint").alias("gap"), F.length(x).cast("bigint").alias("size")))
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.expr("cast(array() as array<bigint>)").alias("starts"))
    starts = F.aggregate(sizes, none, lambda a, s: F.struct((a["at"] + s["gap"] + s["size"]).alias("at"), F.array_append(a["starts"], a["at"] + s["gap"]).alias("starts")))["starts"]
    before = F.transform(m, lambda _, i: F.lower(F.right(F.get(g, i), F.lit(CONTEXT))))
    joined = F.arrays_zip(m.alias("m"), starts.alias("start"), before.alias("before"))
    joined = F.filter(joined, lambda x: _confirmed(kind, x["m"]))

    def one(x):
        score = F.lit(SCORE[kind]) + F.when(x["before"].rlike(FOR[kind]), 0.05).otherwise(0.0) - F.when(x["before"].rlike(AGAINST[kind]), 0.3).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), (x["start"] + F.length(x["m"])).alias("end"), F.round(score, 2).alias("score"))

    return F.transform(joined, one)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus pii: the spans by kind (as in ``KINDS``), then start."""
    t = F.coalesce(F.col(text), F.lit(""))
    name = {(p, k): fresh(docs, f"_{p}_{k}") for p in "fs" for k in KINDS}
    found = docs.withColumns({name["f", k]: _found(t, k) for k in KINDS})
    found = found.withColumns({name["s", k]: _spans(k, F.col(name["f", k])) for k in KINDS})
    return found.withColumn("pii", F.concat(*[F.col(name["s", k]) for k in KINDS])).drop(*name.values())


def mask(docs: DataFrame, text: str = "text", least: float = 0.0) -> DataFrame:
    """``docs`` with each span of at least ``least`` replaced by its kind in angle brackets; needs the column pii of ``find_pii``.

    Of overlapping spans the first to start (then the longer) is taken.
    """
    spans = F.array_sort(F.filter("pii", lambda x: x["score"] >= least), lambda a, b: F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1)).otherwise((b["end"] - a["end"]).cast("int")))
    t = F.col(text)
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(a, x):
        piece = F.concat(a["out"], F.substr(t, (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), F.lit("<"), x["kind"], F.lit(">"))
        return F.when(x["start"] < a["at"], a).otherwise(F.struct(x["end"].alias("at"), piece.alias("out")))

    done = F.aggregate(spans, none, step, lambda a: F.concat(a["out"], F.substr(t, (a["at"] + 1).cast("int"))))
    return docs.withColumn(text, F.when(F.size(spans) > 0, done).otherwise(t))
