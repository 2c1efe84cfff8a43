"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust their score.

Base kinds are reported whenever their check holds; the added kinds ``iban`` (mod-97) and ``ssn`` only if their score reaches
the threshold. Everything is a projection of built-in functions. The patterns find the same spans as the plain ones
beside them, without trying every start inside a run of fitting characters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm import spans

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
# fixed values: plain patterns, in the order of KINDS
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\b",
    "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
}
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": PLAIN["phone"],
    "iban": r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9_])",
    "ssn": r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
}
# a text without this holds no match
GUARDS = {
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "iban": r"[A-Z]{2}[0-9]{2}[ A-Z0-9]{9}",
    "ssn": r"[0-9]-[0-9]{2}-[0-9]",
}
# score of a span that passed its check, what a context word adds, and the words
SCORES = {"email": 0.8, "ip": 0.6, "card": 0.8, "phone": 0.5, "iban": 0.7, "ssn": 0.3}
CONTEXT_BONUS = 0.2
CONTEXT_CHARS = 40
CONTEXT = {
    "email": ("mail", "contact", "address"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "payment", "credit"),
    "phone": ("phone", "tel", "call", "mobile", "fax"),
    "iban": ("iban", "account", "bank", "konto"),
    "ssn": ("ssn", "social security"),
}
THRESHOLD = 0.5


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    place = F.transform(F.split(F.reverse(number), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2))
    total = F.aggregate(place, F.lit(0), lambda a, d: a + F.when(d > 9, d - 9).otherwise(d))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number passes ISO 7064 mod 97-10 after its first four characters moved to the end."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))
    values = F.transform(F.split(turned, ""), lambda c: F.when(F.ascii(c) >= 65, F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    return F.aggregate(values, F.lit(0), lambda a, v: (a * F.when(v > 9, 100).otherwise(10) + v) % 97) == 1


def _checked(kind: str, span: Column) -> Column:
    value = span["value"]
    if kind == "ip":
        # a part of any length, without leading zeros, is at most 255
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        number = digits(value)
        return F.length(number).between(14, 19) & F.coalesce(luhn(number), F.lit(False))
    if kind == "phone":
        return F.length(digits(value)).between(10, 15)
    if kind == "iban":
        return mod97(value)
    return F.lit(True)


def _guard(kind: str, text: Column) -> Column:
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    return text.rlike(GUARDS[kind])


def _score(kind: str, text: Column, span: Column) -> Column:
    before = F.lower(F.substring(text, F.greatest(F.lit(1), span["start"] - CONTEXT_CHARS + 1), F.least(F.lit(CONTEXT_CHARS), span["start"])))
    near = F.array_contains(F.transform(F.array(*[F.lit(w) for w in CONTEXT[kind]]), lambda w: F.contains(before, w)), True)
    return F.lit(SCORES[kind]) + F.when(near, CONTEXT_BONUS).otherwise(0.0)


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans(kind, start, end, value, score) by kind and start.

    ``docs`` has doc_id and text; other columns are not read. Places are code points, the end exclusive. Null and empty
    texts have no spans; rows that repeat are kept; an empty table gives an empty result.
    """
    text = F.col("text")

    def checked(kind: str) -> Column:
        passed = F.filter(spans.found(text, PATTERNS[kind], kind), lambda s: _checked(kind, s))
        return F.coalesce(F.when(_guard(kind, text), passed), spans.none()).alias(kind)

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select("doc_id", "text", *map(checked, KINDS))

    def scored(kind: str) -> Column:
        all_ = F.transform(F.col(kind), lambda s: F.struct(s["kind"], s["start"], s["end"], s["value"], _score(kind, text, s).alias("score")))
        return all_ if kind in BASE else F.filter(all_, lambda s: s["score"] >= THRESHOLD)

    return rows.select("doc_id", F.concat(*[scored(kind) for kind in KINDS]).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash of the base spans and list of all spans per row of ``find``."""
    all_ = F.col("spans")
    base = F.filter(all_, lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[spans.count(all_, kind).alias(f"n_{kind}") for kind in BASE],
        F.sha2(spans.joined(base, KINDS).cast("binary"), 256).alias("base_sha256"),
        spans.joined(all_, KINDS).alias("spans"),
    )


def _sql() -> str:
    plain = {k: spans.sql_found("t", PLAIN[k], k) for k in KINDS}
    number = "regexp_replace(s.value, '[^0-9]', '', 'g')"
    luhn_sum = (
        f"list_sum(list_transform(range(1, length({number}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN substr(reverse({number}), i, 1)::INT "
        f"ELSE substr(reverse({number}), i, 1)::INT * 2 - CASE WHEN substr(reverse({number}), i, 1)::INT > 4 THEN 9 ELSE 0 END END))"
    )
    turned = "substr(replace(s.value, ' ', ''), 5) || substr(replace(s.value, ' ', ''), 1, 4)"
    code = "instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', c) - 1"
    mod = f"list_reduce(list_prepend(0::BIGINT, list_transform(string_split({turned}, ''), lambda c: ({code})::BIGINT)), lambda a, v: (a * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1"
    keep = {
        "email": "true",
        "ip": "len(list_filter(string_split(s.value, '.'), lambda p: NOT regexp_full_match(p, '0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])'))) = 0",
        "card": f"length({number}) BETWEEN 14 AND 19 AND {luhn_sum} % 10 = 0",
        "phone": f"length({number}) BETWEEN 10 AND 15",
        "iban": mod,
        "ssn": "(" + " OR ".join(f"contains(lower(substr(t, greatest(1, s.start - 39), least(40, s.start))), '{w}')" for w in CONTEXT["ssn"]) + ")",
    }
    columns = ", ".join(f"{plain[k]} AS {k}_" for k in KINDS)
    kept = ", ".join(f"list_filter({k}_, lambda s: {keep[k]}) AS {k}" for k in KINDS)
    base = " || ".join(BASE)
    counts = ", ".join(f"len({k})::BIGINT AS n_{k}" for k in BASE)
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
matched AS (SELECT doc_id, t, {columns} FROM texts),
kept AS (SELECT doc_id, {kept} FROM matched)
SELECT doc_id, {counts}, sha256({spans.sql_joined(base, KINDS)}) AS base_sha256,
       {spans.sql_joined(" || ".join(KINDS), KINDS)} AS spans FROM kept
"""


SQL = _sql()
