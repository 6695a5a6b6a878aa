"""Personal data in whole texts, with DataFrame functions only.

Regular expressions propose spans, validators confirm them (parts of an address
at most 255, Luhn for cards, digit counts for phones, mod-97 for account
numbers), and context words in front of a span adjust its score.

A span's place comes from splitting the text by the same expression: the
lengths of the pieces between matches and of the matches themselves add up to
code point offsets. The expressions are written so that Java's matcher runs
through a text once: runs are possessive, and a run is only entered at its first
character (or where the last match ended), which finds the same leftmost
matches as the plain form and is not quadratic in long runs.

Defined results: a null or empty text has no spans; repeated rows are kept as
they are; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in their order, each with its expression (see above for the form).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
             r"(?:(?!\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])*+",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:(?![\x20-](?![0-9]))[0-9\x20-])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Kinds that the method adds.
ADDED = {
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
}
KINDS = [*BASE, *ADDED]
# A text without this character class cannot hold the kind.
NEEDS = {"email": "@", "phone": "+"}
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write)\b",
    "ip": r"(?i)\b(?:ip|host|address|server|client)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment)\b",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax)\b",
    "iban": r"(?i)\b(?:iban|account|bank|konto|compte|cuenta)\b",
    "ssn": r"(?i)\b(?:ssn|social|security|insurance)\b",
}
# Confidence of a confirmed span without and with a context word in the window in front of it.
PLAIN = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7, "iban": 0.8, "ssn": 0.3}
BOOST = 0.25
WINDOW = 48
#: An added kind counts from this score on; base kinds always count.
THRESHOLD = 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn checksum."""
    figures = F.split(F.reverse(digits), "")
    doubled = F.split(F.translate(F.reverse(digits), "0123456789", "0246813579"), "")
    total = F.aggregate(
        F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 0, F.get(figures, i))
        .otherwise(F.get(doubled, i)).cast("int"))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number passes its checksum: first four characters last, letters as 10..35."""
    plain = F.regexp_replace(account, " ", "")
    moved = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(moved, ""), F.lit(0),
        lambda acc, c: F.when(c.rlike("[0-9]"), (acc * 10 + c.cast("int")) % 97)
        .otherwise((acc * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def confirmed(kind: str, match: Column) -> Column:
    """The validator of a kind."""
    digits = _digits(match)
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: part.cast("double") <= 255)
    if kind == "card":
        return F.length(digits).between(12, 19) & luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def spans_of(text: Column, kind: str) -> Column:
    """Confirmed spans of one kind: array of (start, end, kind, base, score), end exclusive."""
    expression = {**BASE, **ADDED}[kind]

    def place(x: Column) -> Column:
        step = lambda acc, m, gap: F.struct(
            (acc["at"] + F.length(gap) + F.length(m)).alias("at"),
            F.array_append(acc["s"], F.struct(
                (acc["at"] + F.length(gap)).alias("start"),
                (acc["at"] + F.length(gap) + F.length(m)).alias("end"),
                m.alias("m"), F.right(gap, F.lit(WINDOW)).alias("before"))).alias("s"))
        return F.aggregate(
            F.arrays_zip(x["found"], x["gaps"]),
            F.struct(F.lit(0).alias("at"),
                     F.array().cast("array<struct<start:int,end:int,m:string,before:string>>").alias("s")),
            lambda acc, z: step(acc, z["found"], z["gaps"]))["s"]

    def with_gaps(found: Column) -> Column:
        return F.struct(found.alias("found"), F.slice(
            F.split(text, expression, -1), 1, F.size(found)).alias("gaps"))

    # One-element arrays bind a value once: the matches, then the matches with the gaps in front of them.
    found = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    bound = F.transform(F.filter(F.array(found), lambda f: F.size(f) > 0), with_gaps)
    placed = F.flatten(F.transform(bound, place))
    spans = F.transform(
        F.filter(placed, lambda s: confirmed(kind, s["m"])),
        lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.lit(KINDS.index(kind)).alias("kind_no"), F.lit(kind).alias("kind"),
            F.least(F.lit(1.0), F.lit(PLAIN[kind]) + F.when(
                s["before"].rlike(CONTEXT[kind]), BOOST).otherwise(0.0)).alias("score"),
            s["m"].alias("match")))
    return spans if kind in BASE else F.filter(spans, lambda s: s["score"] >= THRESHOLD)


SPAN = "array<struct<start:int,end:int,kind_no:int,kind:string,score:double,match:string>>"


def find_pii(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, spans): all confirmed spans of each text, by start and then kind.

    A kind is looked for only where the text holds a character it needs.
    """
    text = F.coalesce(F.col("t"), F.lit(""))
    src = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    empty = F.array().cast(SPAN)
    has_digit = F.col("t").rlike("[0-9]")

    def gated(kind: str) -> Column:
        needs = text.contains(NEEDS[kind]) if kind in NEEDS else F.lit(True)
        if kind != "email":
            needs = needs & F.col("digit")
        return F.when(needs, spans_of(text, kind)).otherwise(empty)

    return (
        src.withColumn("digit", F.coalesce(has_digit, F.lit(False)))
        .withColumn("spans", F.array_sort(F.concat(*[gated(k) for k in KINDS])))
        .select("id", "spans"))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; overlapping spans merge into the first."""
    out = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("s")),
        lambda acc, x: F.when(x["start"] < acc["at"], F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"), acc["s"].alias("s"))).otherwise(F.struct(
                x["end"].alias("at"),
                F.concat(acc["s"], F.substr(text, acc["at"] + 1, x["start"] - acc["at"]),
                         F.lit("["), x["kind"], F.lit("]")).alias("s"))))
    return F.concat(out["s"], F.substr(text, out["at"] + 1, F.length(text)))


def pii_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the number of spans of each base kind, a digest of the base spans and all spans."""
    found = find_pii(df, id_col, text_col)
    base = F.filter("spans", lambda s: s["kind_no"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select(
        F.col("id").alias(id_col), *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))
