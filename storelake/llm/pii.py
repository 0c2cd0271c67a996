"""Personal data spans (operator 1), in Spark built-in functions only.

Regular expressions propose spans, checks confirm them (Luhn for cards, mod 97 for bank accounts,
number ranges for addresses) and context words near a span move its score. Positions come without
Python: the text is split at the same expression, so the lengths of the pieces and of the matches
add up to the start of each match, in code points.

The expressions are written with possessive quantifiers and a look-behind on their first
character. They match what the plain forms match, but the matcher neither recurses per repetition
nor rescans a long run from each of its characters.

Null or empty texts have no spans. Rows with equal ``doc_id`` are answered row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import text_or_empty

# fixed values: kinds in the order in which they are listed, base kinds first
BASE_KINDS = ["email", "ip", "card", "phone"]
EXTRA_KINDS = ["iban", "ssn"]

PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# a text without a match of this has no span of the kind: cheap, and spares the two passes
HINTS = {"email": "@", "phone": "+"}
CONTEXT_WORDS = {
    "email": "mail|contact|write|reply|e-mail",
    "ip": "ip|address|host|server|login|client",
    "card": "card|visa|master|amex|credit|debit|payment|pay",
    "phone": "phone|tel|call|mobile|cell|fax|dial",
    "iban": "iban|bank|account|transfer|konto|cuenta|compte",
    "ssn": "ssn|social|security|taxpayer",
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.3}
CONTEXT_GAIN = 0.4      # added when a context word is near
CONTEXT_CHARS = 40      # code points looked at before a span
PART = 256              # matches whose spans are gathered together
EXTRA_MIN_SCORE = 0.5   # spans of the extra kinds below this are not reported

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digits(c: Column) -> Column:
    return F.translate(c, " -+().", "")


def luhn_ok(digits: Column) -> Column:
    """Luhn check of a string of digits."""
    d = F.split(F.reverse(digits), "")
    doubled = F.transform(d, lambda x, i: F.when(i % 2 == 1, x.cast("int") * 2).otherwise(x.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def mod97_ok(account: Column) -> Column:
    """ISO 7064 mod 97-10 check of an account number without blanks."""
    moved = F.concat(F.substring(account, 5, 40), F.substring(account, 1, 4))
    def step(acc, ch):
        n = F.instr(F.lit(_ALPHABET), ch)
        return F.when(n > 0, acc * 100 + n + 9).otherwise(acc * 10 + ch.cast("int")) % 97
    return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        return m.rlike(r"^(?:0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])?(?:\.|$)){4}$")
    if kind == "card":
        d = _digits(m)
        n = F.length(d)
        return F.when((n >= 12) & (n <= 19), luhn_ok(d)).otherwise(F.lit(False))
    if kind == "phone":
        n = F.length(_digits(m))
        return (n >= 9) & (n <= 15)
    if kind == "iban":
        return mod97_ok(F.translate(m, " ", ""))
    if kind == "ssn":
        return ~m.rlike("^(?:000|666|9)") & ~m.rlike("-00-") & ~m.rlike("-0000$")
    return F.lit(True)


def _once(x: Column, use) -> Column:
    """``use(x)`` with ``x`` computed once, however often it reads it."""
    return F.get(F.transform(F.array(x), use), F.lit(0))


def _spans(kind: str, text: Column) -> Column:
    """Array of (start, rank, end, score) of the confirmed spans of one kind."""
    pat = PATTERNS[kind]
    rank = (BASE_KINDS + EXTRA_KINDS).index(kind)
    pieces = F.split(text, pat, -1)
    found = F.regexp_extract_all(text, F.lit(pat), F.lit(0))
    near = rf"(?i)(?:{CONTEXT_WORDS[kind]})"

    def step(acc, pair):
        start = acc["at"] + F.length(pair["p"])
        end = start + F.length(pair["m"])
        before = F.right(pair["p"], F.lit(CONTEXT_CHARS))
        score = F.least(F.lit(1.0), F.lit(PRIOR[kind]) + F.when(before.rlike(near), CONTEXT_GAIN).otherwise(0.0))
        ok = (pair["m"] != "") & _valid(kind, pair["m"])
        if kind in EXTRA_KINDS:
            ok = ok & (score >= EXTRA_MIN_SCORE)
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), score.alias("score"))
        return F.struct(end.alias("at"),
                        F.when(F.coalesce(ok, F.lit(False)), F.array_append(acc["got"], span))
                         .otherwise(acc["got"]).alias("got"))

    empty = F.from_json(F.lit("[]"), "array<struct<start:int,rank:int,end:int,score:double>>")
    # one piece more than matches: the last pair has no match
    pairs = F.zip_with(pieces, found, lambda p, m: F.struct(p.alias("p"), F.coalesce(m, F.lit("")).alias("m")))

    def parts(p):
        """Spans of ``PART`` matches at a time, counted from the part's own start: appending to an array copies it."""
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(p) - 1) / PART).cast("int")), lambda k: F.aggregate(
            F.slice(p, k * PART + 1, F.lit(PART)), F.struct(F.lit(0).alias("at"), empty.alias("got")), step))

    def placed(c):
        """All spans, moved by what stands before their part."""
        starts = F.aggregate(c, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")), lambda acc, x: F.struct(
            (acc["at"] + x["at"]).alias("at"), F.array_append(acc["all"], acc["at"]).alias("all")), lambda acc: acc["all"])
        return F.flatten(F.zip_with(c, starts, lambda x, by: F.transform(x["got"], lambda s: F.struct(
            (s["start"] + by).alias("start"), s["rank"].alias("rank"), (s["end"] + by).alias("end"), s["score"].alias("score")))))

    spans = _once(_once(pairs, parts), placed)
    hint = F.contains(text, F.lit(HINTS[kind])) if kind in HINTS else text.rlike("[0-9]{2}")
    if kind == "ip":
        hint = text.rlike(r"[0-9]\.[0-9]")
    if kind == "card":
        hint = text.rlike(r"[0-9][\x20-]?[0-9]")
    return F.when(hint, spans).otherwise(empty)


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in BASE_KINDS + EXTRA_KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` plus ``pii_spans``: array of (start, rank, end, score) of confirmed spans, by start
    and then by kind; ``rank`` is the kind's place in BASE_KINDS + EXTRA_KINDS."""
    body = text_or_empty(text)
    spans = F.array_sort(F.concat(*[_spans(k, body) for k in BASE_KINDS + EXTRA_KINDS]))
    return docs.withColumn("pii_spans", spans)


def redact(docs: DataFrame, text: str = "text", mark: str = "[removed]") -> DataFrame:
    """Texts with every confirmed span replaced by ``mark`` (overlapping spans become one)."""
    found = find_pii(docs, text)
    t = text_or_empty(text)
    def step(acc, s):
        gap = F.substring(t, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        hit = F.concat(acc["out"], gap, F.lit(mark))
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, hit).otherwise(acc["out"]).alias("out"))
    done = F.aggregate("pii_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, 2147483647)))
    return found.withColumn(text, F.when(F.col(text).isNotNull(), done)).drop("pii_spans")


def pii_report(docs: DataFrame) -> DataFrame:
    """One row per document: counts per base kind, digest of the base spans, all spans, scores."""
    d = find_pii(docs.select("doc_id", "text")).select("doc_id", "pii_spans")
    base = F.filter("pii_spans", lambda s: s["rank"] < len(BASE_KINDS))
    def count(rank):
        return F.size(F.filter("pii_spans", lambda s: s["rank"] == rank)).cast("long")
    counts = [count(r).alias(f"n_{k}") for r, k in enumerate(BASE_KINDS)]
    scores = F.array_join(F.transform("pii_spans", lambda s: F.format_string("%.1f", s["score"])), ",")
    return d.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                    _joined(F.col("pii_spans")).alias("spans"), scores.alias("scores"))
