"""URL filter: rules first, then the ratio of two character language models, learned from the URLs that the rules decide.

Both models are variable-order: a character's probability interpolates the orders 1 to 5 by Witten-Bell smoothing, where a
context that was never seen leaves the shorter one's estimate as it is. They are built over all distinct URLs with a
rule, except a quarter (by hash) that calibrates the threshold on the mean log-likelihood difference per character. Rules
read host and path; the models read the whole URL, its scheme, query string and fragment included (the SQL twin's models
still read host and path only).
Counts, smoothing and scores are aggregations and joins on the n-gram table; log-ratios are kept in thousandths as
integers, so that sums do not depend on their order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.operators.scale import lookup_join, settle

ORDER = 5
ALPHABET = 256
PAD, END = "\x02", "\x03"
# thousandths of a nat per bin of the calibration
BIN = 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# fixed values: (host, path prefix, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty without ``://``."""
    rest = F.substring(url, F.instr(url, "://") + 3, F.length(url))
    there = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1)
    return F.when(there, host).otherwise(""), F.when(there, path).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for rule_host, prefix, decision in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(prefix))
        rule = F.when(fits, rule_host + prefix).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _grams(urls: DataFrame, *keep: str) -> DataFrame:
    """One row per character of each ``url``, the end included: its n-gram of full order."""
    padded = F.concat(F.lit(PAD * (ORDER - 1)), F.col("url"), F.lit(END))
    place = F.explode(F.sequence(F.lit(1), F.length("url") + 1)).alias("i")
    return urls.select(*keep, padded.alias("padded"), place).select(*keep, F.substring(F.col("padded"), F.col("i"), F.lit(ORDER)).alias("gram"))


def _ratios(trained: DataFrame, wanted: DataFrame) -> DataFrame:
    """``gram -> ratio``: thousandths of ln(p_allow / p_block) of the last character, for each wanted n-gram.

    ``trained``: gram and the number of times it was seen in allowed (``a``) and blocked (``b``) URLs.
    """
    table = wanted.select("gram")
    p = {"a": F.lit(1.0 / ALPHABET), "b": F.lit(1.0 / ALPHABET)}
    for k in range(1, ORDER + 1):
        counts = trained.groupBy(F.substring("gram", ORDER - k + 1, k).alias(f"g{k}")).agg(F.sum("a").alias(f"a{k}"), F.sum("b").alias(f"b{k}"))
        context = F.substring(f"g{k}", 1, k - 1) if k > 1 else F.lit("")
        contexts = counts.groupBy(context.alias(f"c{k}")).agg(
            F.sum(f"a{k}").alias(f"na{k}"), F.sum(f"b{k}").alias(f"nb{k}"),
            F.sum((F.col(f"a{k}") > 0).cast("bigint")).alias(f"ta{k}"), F.sum((F.col(f"b{k}") > 0).cast("bigint")).alias(f"tb{k}"),
        )
        table = table.withColumn(f"g{k}", F.substring("gram", ORDER - k + 1, k)).join(counts, f"g{k}", "left")
        table = table.withColumn(f"c{k}", F.substring("gram", ORDER - k + 1, k - 1) if k > 1 else F.lit("")).join(contexts, f"c{k}", "left")
        for side in ("a", "b"):
            seen = F.coalesce(F.col(f"n{side}{k}"), F.lit(0))
            kinds = F.coalesce(F.col(f"t{side}{k}"), F.lit(0))
            here = (F.coalesce(F.col(f"{side}{k}"), F.lit(0)) + kinds * p[side]) / (seen + kinds)
            table = table.withColumn(f"p{side}{k}", F.when(seen > 0, here).otherwise(p[side]))
            p[side] = F.col(f"p{side}{k}")
    return table.select("gram", F.round(1000 * (F.log(p["a"]) - F.log(p["b"]))).cast("bigint").alias("ratio"))


def _threshold(scores: DataFrame) -> int:
    """The lowest bin of best balanced accuracy on labelled ``(verdict, bin)`` rows; 0 unless both verdicts occur.

    A bin is a hundredth of a nat, so the table that reaches the driver has a bounded number of rows.
    """
    table = scores.groupBy("bin").agg(F.sum((F.col("verdict") == "allow").cast("bigint")).alias("a"), F.sum((F.col("verdict") == "block").cast("bigint")).alias("b")).collect()
    rows = sorted((r["bin"], r["a"], r["b"]) for r in table)
    allowed, blocked = sum(r[1] for r in rows), sum(r[2] for r in rows)
    if not allowed or not blocked:
        return 0
    best, least, a, b = None, 0, allowed, 0
    for bin_, x, y in rows:  # URLs of this bin and above are allowed
        quality = a * blocked + b * allowed
        if best is None or quality > best:
            best, least = quality, bin_
        a, b = a - x, b + y
    return least


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, ratio (thousandths of a nat per character).

    ``pages`` has page_id and url; other columns are not read. Null URLs and those without ``://`` have an empty host and
    path, no rule, and are judged by the models like any other, null as the empty URL. ``ratio`` is null where a rule decides. If no URL of
    one verdict is there to learn from or to calibrate with, the threshold is 0. Repeated rows are kept; an empty
    table gives an empty result.
    """
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict)
    urls = settle(rows.groupBy("url", F.col("by_rule").alias("verdict")).count().drop("count"), "urls")
    held = F.crc32(F.col("url").cast("binary")) % 4 == 0
    learned = urls.where(F.col("verdict").isNotNull() & ~held)
    trained = _grams(learned, "verdict").groupBy("gram").agg(
        F.sum((F.col("verdict") == "allow").cast("bigint")).alias("a"), F.sum((F.col("verdict") == "block").cast("bigint")).alias("b")
    )
    trained = settle(trained, "url-grams")
    scored_urls = urls.where(F.col("verdict").isNull() | held)
    wanted = _grams(scored_urls).distinct()
    ratios = settle(_ratios(trained, wanted), "url-ratios")
    met = lookup_join(_grams(scored_urls, "url", "verdict"), ratios, "gram", ["url"])
    sums = met.groupBy("url", "verdict").agg(F.floor(F.sum("ratio") / F.count("*")).alias("ratio"))
    sums = settle(sums, "url-scores").withColumn("bin", F.floor(F.col("ratio") / BIN))
    least = _threshold(sums.where("verdict is not null"))
    decided = sums.where("verdict is null").select("url", "ratio", F.when(F.col("bin") >= least, "allow").otherwise("block").alias("by_model"))
    judged = rows.withColumn("url", F.when(F.col("by_rule").isNull(), F.col("url"))).join(decided, "url", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("by_rule", "by_model").alias("verdict"), "ratio")


def _sql() -> str:
    host = f"translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}')"
    rule = verdict = "NULL"
    for rule_host, prefix, decision in sorted(RULES, key=lambda r: (len(r[0] + r[1]), r)):
        fits = f"(host = '{rule_host}' OR suffix(host, '.{rule_host}')) AND prefix(path, '{prefix}')"
        rule = f"CASE WHEN {fits} THEN '{rule_host + prefix}' ELSE {rule} END"
        verdict = f"CASE WHEN {fits} THEN '{decision}' ELSE {verdict} END"
    counts = ", ".join(
        f"n{k} AS MATERIALIZED (SELECT right(gram, {k}) AS g, sum(a) AS a, sum(b) AS b FROM trained GROUP BY 1), "
        f"c{k} AS MATERIALIZED (SELECT left(g, {k - 1}) AS c, sum(a) AS na, sum(b) AS nb, count(*) FILTER (a > 0) AS ta, count(*) FILTER (b > 0) AS tb FROM n{k} GROUP BY 1)"
        for k in range(1, ORDER + 1)
    )
    levels = f"l0 AS (SELECT DISTINCT gram, {1 / ALPHABET!r}::DOUBLE AS pa, {1 / ALPHABET!r}::DOUBLE AS pb FROM wanted)"
    for k in range(1, ORDER + 1):
        side = lambda s: f"CASE WHEN coalesce(n{s}, 0) > 0 THEN (coalesce(n.{s}, 0) + t{s} * p{s}) / (n{s} + t{s}) ELSE p{s} END AS p{s}"  # noqa: B023, E731
        levels += f", l{k} AS (SELECT gram, {side('a')}, {side('b')} FROM l{k - 1} LEFT JOIN n{k} n ON n.g = right(gram, {k}) LEFT JOIN c{k} c ON c.c = left(right(gram, {k}), {k - 1}))"
    crc = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(url::BLOB)), lambda i: ('0x' || substr(hex(url::BLOB), 2 * i + 1, 2))::BIGINT)), lambda a, x: {step})"
    fold = "xor(a, x)"
    for _ in range(8):
        fold = f"list_transform([{fold}], lambda y: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)[1]"
    return f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest, coalesce(url, '') AS url FROM pages
), named AS (
  SELECT page_id, url, coalesce({host}, '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1), '') AS path FROM cut
), rows AS MATERIALIZED (SELECT *, {rule} AS rule, {verdict} AS by_rule FROM named),
urls AS MATERIALIZED (
  SELECT url, verdict, xor({crc.format(step=fold)}, 4294967295) % 4 = 0 AS held
  FROM (SELECT DISTINCT url, by_rule AS verdict FROM rows)
), grams AS MATERIALIZED (
  SELECT url, verdict, held, substr(repeat(chr(2), {ORDER - 1}) || url || chr(3), i, {ORDER}) AS gram
  FROM (SELECT *, unnest(range(1, length(url) + 2)) AS i FROM urls)
), trained AS MATERIALIZED (
  SELECT gram, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b
  FROM grams WHERE verdict IS NOT NULL AND NOT held GROUP BY gram
), wanted AS MATERIALIZED (SELECT * FROM grams WHERE verdict IS NULL OR held),
{counts}, {levels},
scores AS MATERIALIZED (
  SELECT url, verdict, floor(sum(round(1000 * (ln(pa) - ln(pb)))::BIGINT) * 1.0 / count(*))::BIGINT AS ratio
  FROM wanted JOIN l{ORDER} USING (gram) GROUP BY url, verdict
), bins AS (
  SELECT floor(ratio / {BIN}.0)::BIGINT AS bin, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b
  FROM scores WHERE verdict IS NOT NULL GROUP BY 1
), totals AS (SELECT coalesce(sum(a), 0) AS ta, coalesce(sum(b), 0) AS tb FROM bins),
quality AS (
  SELECT bin, (sum(a) OVER (ORDER BY bin DESC)) * tb + (tb - sum(b) OVER (ORDER BY bin DESC)) * ta AS q FROM bins, totals
), least AS (
  SELECT CASE WHEN ta > 0 AND tb > 0 THEN (SELECT bin FROM quality ORDER BY q DESC, bin LIMIT 1) ELSE 0 END AS least FROM totals
)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN floor(ratio / {BIN}.0) >= least THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN by_rule IS NULL THEN ratio END AS ratio
FROM rows LEFT JOIN (SELECT url, ratio FROM scores WHERE verdict IS NULL) s ON by_rule IS NULL AND s.url = rows.url, least
"""


SQL = _sql()
