"""Secrets in texts: fixed patterns, and a battery of randomness tests on long tokens with false-discovery control.

The base kinds ``assign``, ``access`` and ``hex`` are reported whenever they match. The kind ``random`` adds tokens of 16 and
more characters that look drawn at random from their encoding's alphabet:

* runs of token characters are cut into parts at every inner ``=``. A part of both cases is one token, measured without
  leading single-case words (``sk_live_``); if it has one case only, or holds a single-case piece of token length, each
  piece between ``-``, ``_``, ``/`` and ``+`` is a token of its own;
* the encoding (hex, base32, base36, base64) is inferred from the characters, which must mix letters and digits; every
  token that does has one;
* chi-squared uniformity over the alphabet, a runs test about the alphabet's middle and a lag-one serial correlation test
  must each not reject randomness (``BATTERY_Z``);
* the probability of so even a spread under text-like frequencies, which falls with the length of the token, must pass a
  Benjamini-Hochberg threshold at ``FALSE_DISCOVERIES``, taken over all tokens of the table with the same encoding and
  length band. The thresholds come from counts per bin of the logarithm of that probability.

Everything is a projection or an aggregation of built-in functions; formulas are SQL text that DuckDB reads as well. The
SQL twin still takes runs of 24 characters (``TOKEN``) as uncut tokens, so its ``random`` spans are fewer.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm import spans
from lexispark.operators.scale import settle

KINDS = ("assign", "access", "hex", "random")
BASE = KINDS[:3]
# fixed values: patterns, alphabets, and sums of squared and cubed frequencies of text-like strings
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_=-]{24,}"
LEAST_TOKEN = 16
RUN = rf"[A-Za-z0-9+/_=-]{{{LEAST_TOKEN},}}"
PART = r"[^=]+(?:=+$)?"
PIECE = rf"[A-Za-z0-9]{{{LEAST_TOKEN},}}"
SINGLE = rf"(?<![A-Za-z0-9])(?:[0-9a-z]{{{LEAST_TOKEN},}}|[0-9A-Z]{{{LEAST_TOKEN},}})(?![A-Za-z0-9])"
WORDS = r"^(?:(?:[a-z]{2,20}|[A-Z]{2,20})[-_/]){1,4}"
ALPHABETS = {
    "hex": "0123456789abcdef",
    "base32": "abcdefghijklmnopqrstuvwxyz234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
}
TEXT_SQUARES = {"hex": 0.12, "base32": 0.0655, "base36": 0.0655, "base64": 0.0655}
TEXT_CUBES = {"hex": 0.02, "base32": 0.0055, "base36": 0.0055, "base64": 0.0055}
LEAST_GROUP = 8
BATTERY_Z = 3.0
FALSE_DISCOVERIES = 0.05
BINS_PER_DECADE, LAST_BIN = 20, 400

_ENCODING = """CASE WHEN NOT (regexp_like(v, '[0-9]') AND regexp_like(v, '[A-Za-z]')) THEN NULL
 WHEN regexp_like(v, '^([0-9a-f]+|[0-9A-F]+)$') THEN 'hex'
 WHEN regexp_like(v, '^[A-Z2-7]+$') THEN 'base32'
 WHEN regexp_like(v, '^([0-9a-z]+|[0-9A-Z]+)$') THEN 'base36'
 WHEN regexp_like(v, '[a-z]') AND regexp_like(v, '[A-Z]') THEN 'base64' END"""


def _by_encoding(values: dict) -> str:
    return "CASE e " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in values.items()) + " END"


_SIZE = _by_encoding({k: len(a) for k, a in ALPHABETS.items()})
_S2, _S3 = _by_encoding(TEXT_SQUARES), _by_encoding(TEXT_CUBES)
# over n characters with codes: q sum of squared counts, r runs, h codes in the upper half, x sum of neighbouring
# products, s sum of codes, w sum of squared codes, f and l the first and last code
_CHI = f"({_SIZE} * q * 1.0 / n - n)"
_CHI_Z = f"(power(greatest({_CHI}, 0.0) / ({_SIZE} - 1), 1.0 / 3) - (1 - 2.0 / (9 * ({_SIZE} - 1)))) / sqrt(2.0 / (9 * ({_SIZE} - 1)))"
_RUNS_MEAN = "(1 + 2.0 * h * (n - h) / n)"
_RUNS_VAR = f"(({_RUNS_MEAN} - 1) * ({_RUNS_MEAN} - 2) / (n - 1))"
_RUNS_Z = f"CASE WHEN {_RUNS_VAR} > 0 THEN abs(r - {_RUNS_MEAN}) / sqrt({_RUNS_VAR}) ELSE 99.0 END"
_MEAN = "(s * 1.0 / n)"
_SERIAL_Z = f"CASE WHEN w - s * {_MEAN} > 0 THEN abs((x - {_MEAN} * (2.0 * s - f - l) + (n - 1) * {_MEAN} * {_MEAN}) / (w - s * {_MEAN})) * sqrt(n * 1.0) ELSE 99.0 END"
_TEXT_MEAN = f"(n + n * (n - 1.0) * {_S2})"
_TEXT_VAR = f"(2.0 * n * (n - 1) * ({_S2} + 2 * (n - 2) * {_S3} - (2.0 * n - 3) * {_S2} * {_S2}))"
_TEXT_Z = f"((q - {_TEXT_MEAN}) / sqrt(greatest({_TEXT_VAR}, 1.0)))"
# minus the natural logarithm of the normal probability below z, by a logistic approximation
_TEXT_LOG = f"ln(1 + exp(least(700.0, -(1.5976 * {_TEXT_Z} + 0.07056 * power({_TEXT_Z}, 3)))))"
BIN = f"CAST(least({LAST_BIN}, floor({_TEXT_LOG} / ln(10.0) * {BINS_PER_DECADE})) AS INT)"
PASSES = f"({_CHI_Z} <= {BATTERY_Z} AND {_RUNS_Z} <= {BATTERY_Z} AND {_SERIAL_Z} <= {BATTERY_Z})"
BAND = "CASE WHEN n < 32 THEN 0 WHEN n < 64 THEN 1 ELSE 2 END"


def _codes(value: Column, encoding: Column) -> Column:
    lowered = F.when(encoding == "base64", value).otherwise(F.lower(value))
    alphabet = F.element_at(F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair]), encoding)
    return F.transform(
        F.split(lowered, ""), lambda c: F.call_function("position", c, alphabet) - 1
    )


def _measured(span: Column, encoding: Column, codes: Column) -> Column:
    """The sums of the test battery for one token."""
    one = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    n = F.size(codes)
    half = F.element_at(F.create_map(*[F.lit(x) for k, a in ALPHABETS.items() for x in (k, len(a) // 2)]), encoding)
    after, before = F.slice(codes, F.lit(2), n - 1), F.slice(codes, F.lit(1), n - 1)
    changes = F.zip_with(before, after, lambda a, b: ((a >= half) != (b >= half)).cast("int"))
    squares = F.transform(F.array_distinct(codes), lambda d: F.pow(F.size(F.filter(codes, lambda c: c == d)), F.lit(2)).cast("bigint"))
    return F.struct(
        span["start"].alias("start"), span["end"].alias("end"), encoding.alias("e"), n.alias("n"),
        one(squares).alias("q"), (one(changes) + 1).alias("r"), F.size(F.filter(codes, lambda c: c >= half)).alias("h"),
        one(F.zip_with(before, after, lambda a, b: a * b)).alias("x"), one(codes).alias("s"),
        one(F.transform(codes, lambda c: c * c)).alias("w"), codes[0].alias("f"), F.element_at(codes, -1).alias("l"),
    )


def _base(text: Column) -> list[Column]:
    assign = F.filter(spans.found(text, ASSIGN, "assign", 1), lambda s: F.length(s["value"]) >= 8)
    found = {
        "assign": F.when(F.contains(text, F.lit("=")) | F.contains(text, F.lit(":")), assign),
        "access": F.when(F.contains(text, F.lit("AKIA")), spans.found(text, ACCESS, "access")),
        "hex": F.when(text.rlike(HEX), spans.found(text, HEX, "hex")),
    }
    return [F.coalesce(found[k], spans.none()).alias(k) for k in BASE]


def _within(outer: Column, inner: Column) -> Column:
    """Spans of places within a span, as spans of the text."""
    return F.transform(
        inner, lambda s: F.struct(s["kind"].alias("kind"), (outer["start"] + s["start"]).alias("start"), (outer["start"] + s["end"]).alias("end"), s["value"].alias("value"))
    )


def _parts(run: Column) -> Column:
    """A run of token characters, cut at every ``=`` that is not its padding."""
    return _within(run, spans.found(run["value"], PART, "random"))


def _pieces(part: Column) -> Column:
    """The tokens of a part, their values without padding, in the base64 alphabet and without leading words."""
    value = F.rtrim(part["value"], F.lit("="))
    value = F.regexp_replace(value, WORDS, "")
    one_case = ~(value.rlike("[a-z]") & value.rlike("[A-Z]"))
    whole = F.array(F.struct(part["kind"].alias("kind"), part["start"].alias("start"), part["end"].alias("end"), F.translate(value, "-_", "+/").alias("value")))
    return F.when(one_case | value.rlike(SINGLE), _within(part, spans.found(part["value"], PIECE, "random"))).otherwise(whole)


def scanned(docs: DataFrame, *keep: str) -> DataFrame:
    """Base spans and measured candidate tokens of each row: the kept columns, base(kind, start, end, value), tokens."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*keep, text.alias("_text")).select(*keep, "_text", *_base(F.col("_text")))
    rows = rows.withColumn("base", F.concat(*BASE)).drop(*BASE)
    runs = F.coalesce(F.when(F.col("_text").rlike(RUN), spans.found(F.col("_text"), RUN, "random")), spans.none())
    mixed = lambda t: t["value"].rlike("[0-9]") & t["value"].rlike("[A-Za-z]")
    free = lambda t: ~F.exists(F.col("base"), lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"]))
    rows = rows.withColumn("tokens", F.filter(runs, mixed))
    for cut in (_parts, _pieces):
        rows = rows.withColumn("tokens", F.filter(F.flatten(F.transform("tokens", cut)), lambda t: mixed(t) & (F.length(t["value"]) >= LEAST_TOKEN)))
    rows = rows.withColumn("tokens", F.filter("tokens", free))
    rows = rows.withColumn("tokens", F.expr("transform(tokens, t -> struct(t.start, t.end, t.value, " + _ENCODING.replace("v,", "t.value,") + " AS e))"))
    measured = F.transform("tokens", lambda t: _measured(t, t["e"], _codes(t["value"], t["e"])))
    rows = rows.withColumn("tokens", measured).drop("_text")
    judge = "named_struct('start', t.start, 'end', t.end, 'e', t.e, 'band', " + _of("t", BAND) + ", 'bin', " + _of("t", BIN) + ", 'passes', " + _of("t", PASSES) + ")"
    return rows.withColumn("tokens", F.expr(f"transform(tokens, t -> {judge})"))


def _of(token: str, formula: str) -> str:
    """A formula over the fields of a token."""
    return re.sub(r"(?<![\w.'])([enqrhxswfl])(?![\w('])", rf"{token}.\1", formula)


def thresholds(rows: DataFrame) -> dict[tuple[str, int], int]:
    """Least bin that keeps the expected share of false discoveries, per encoding and length band (at most 12)."""
    token = rows.select(F.explode("tokens").alias("t")).select("t.e", "t.band", "t.bin")
    counts = token.groupBy("e", "band", "bin").count().collect()  # bounded: encodings x bands x bins
    found = {}
    for key in {(r["e"], r["band"]) for r in counts}:
        mine = sorted(((r["bin"], r["count"]) for r in counts if (r["e"], r["band"]) == key), reverse=True)
        total, above = sum(c for _, c in mine), 0
        for bin_, n in mine:
            above += n
            if 10 ** (-bin_ / BINS_PER_DECADE) <= FALSE_DISCOVERIES * above / total:
                found[key] = bin_
    return found


def all_spans(limits: dict[tuple[str, int], int]) -> Column:
    """Base spans and the tokens beyond their threshold, of a row of ``scanned``."""

    def beyond(t: Column) -> Column:
        any_ = F.lit(False)
        for (encoding, band), bin_ in sorted(limits.items()):
            any_ = any_ | ((t["e"] == encoding) & (t["band"] == band) & (t["bin"] >= bin_))
        return any_ & t["passes"]

    extra = F.transform(F.filter("tokens", beyond), lambda t: F.struct(F.lit("random").alias("kind"), t["start"], t["end"]))
    plain = F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return F.concat(plain, extra)


def find(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans(kind, start, end).

    ``docs`` has doc_id and text; other columns are not read. Places are code points, the end exclusive; a ``random`` span
    never overlaps a base span. Null and empty texts have no spans; rows that repeat are kept; an empty table gives an
    empty result.
    """
    rows = settle(scanned(docs, "doc_id"), "secrets")
    return rows.select("doc_id", all_spans(thresholds(rows)).alias("spans"))


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


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[SECRET]``; all rows and columns stay.

    Thresholds come from one scan of the texts, the replacement from a second one, so that no text is shuffled.
    """
    limits = thresholds(scanned(docs))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    packed = docs.select(F.struct(*columns).alias("_row"), "text")
    rows = scanned(packed, "_row").select("_row", F.array_sort(F.transform(all_spans(limits), lambda s: F.struct(s["start"], s["end"]))).alias("_spans"))
    body = F.col("_row.text")
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        # overlapping secrets are one
        begin = F.greatest(s["start"], state["at"])
        kept = F.substring(body, state["at"] + 1, begin - state["at"])
        new = F.concat(state["out"], kept, F.when(s["start"] >= state["at"], "[SECRET]").otherwise(""))
        return F.struct(F.greatest(s["end"], state["at"]).alias("at"), new.alias("out"))

    clean = F.aggregate("_spans", first, step, lambda s: F.concat(s["out"], F.substring(body, s["at"] + 1, F.length(body))))
    text = F.when(F.size("_spans") > 0, clean).otherwise(body)
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def _sql() -> str:
    assign = spans.sql_found("t", ASSIGN, "assign", 1)
    alphabet = _by_encoding(ALPHABETS)
    half = _by_encoding({k: len(a) // 2 for k, a in ALPHABETS.items()})
    encoding = _ENCODING.replace("regexp_like(", "regexp_matches(")
    return f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS id, coalesce(text, '') AS t FROM documents),
base AS MATERIALIZED (
  SELECT doc_id, id, t, list_filter({assign}, lambda s: length(s.value) >= 8) AS a,
         {spans.sql_found("t", ACCESS, "access")} AS k, {spans.sql_found("t", HEX, "hex")} AS x,
         {spans.sql_found("t", TOKEN, "random")} AS tokens
  FROM texts
), free AS (
  SELECT id, unnest(list_filter(tokens, lambda o: len(list_filter(a || k || x, lambda b: b.start < o.end AND o.start < b.end)) = 0)) AS o FROM base
), named AS (
  SELECT id, o.start AS a, o.end AS b, rtrim(translate(o.value, '-_', '+/'), '=') AS v, {encoding} AS e FROM free
), coded AS (
  SELECT id, a, b, e, list_transform(string_split(CASE WHEN e = 'base64' THEN v ELSE lower(v) END, ''), lambda c: instr({alphabet}, c) - 1) AS c
  FROM named WHERE e IS NOT NULL AND length(v) >= 16
), sums AS (
  SELECT id, a, b, e, len(c) AS n, list_sum(list_transform(list_distinct(c), lambda d: len(list_filter(c, lambda y: y = d)) ** 2))::BIGINT AS q,
         1 + list_sum(list_transform(range(2, len(c) + 1), lambda i: ((c[i] >= {half}) <> (c[i - 1] >= {half}))::INT))::BIGINT AS r,
         len(list_filter(c, lambda y: y >= {half})) AS h, list_sum(list_transform(range(2, len(c) + 1), lambda i: c[i] * c[i - 1]))::BIGINT AS x,
         list_sum(c)::BIGINT AS s, list_sum(list_transform(c, lambda y: y * y))::BIGINT AS w, c[1] AS f, c[-1] AS l
  FROM coded
), judged AS (SELECT id, a, b, e, {BAND} AS band, {BIN} AS bin, {PASSES} AS passes FROM sums),
bins AS (SELECT e, band, bin, count(*) AS c FROM judged GROUP BY ALL),
above AS (
  SELECT *, sum(c) OVER (PARTITION BY e, band ORDER BY bin DESC) AS m, sum(c) OVER (PARTITION BY e, band) AS total FROM bins
), limits AS (
  SELECT e, band, min(bin) AS least FROM above WHERE pow(10, -bin * 1.0 / {BINS_PER_DECADE}) <= {FALSE_DISCOVERIES} * m / total GROUP BY e, band
), extra AS (
  SELECT id, list({{'kind': 'random', 'start': a, 'end': b, 'value': ''}}) AS z
  FROM judged JOIN limits USING (e, band) WHERE bin >= least AND passes GROUP BY id
)
SELECT doc_id, len(a)::BIGINT AS n_assign, len(k)::BIGINT AS n_access, len(x)::BIGINT AS n_hex,
       sha256({spans.sql_joined("a || k || x", KINDS)}) AS base_sha256, {spans.sql_joined("a || k || x || coalesce(z, [])", KINDS)} AS spans
FROM base LEFT JOIN extra USING (id)
"""


SQL = _sql()
