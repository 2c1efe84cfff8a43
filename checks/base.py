"""Registry of the checked queries: each is a Spark function and, where SQL can say it, an equivalent query."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexispark.config import CleanConfig, review_config
from lexispark.functions.tokens import filtered_tokens, join_tokens
from lexispark.operators.scale import settle, spread

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{folder}/{name}.parquet"))


# ------------------------------------------------------------------ SQL fragments
WORD = r"[\p{L}\p{N}_]"
NONWORD = r"[^\p{L}\p{N}_]"
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
NONSPACE = r"[^\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(column: str, pattern: str, replacement: str = " ") -> str:
    return f"regexp_replace({column}, {quoted(pattern)}, {quoted(replacement)}, 'g')"


def sql_contractions(column: str, mapping) -> str:
    for short, long in mapping:
        column = f"replace({column}, {quoted(short)}, {quoted(long)})"
    return column


def sql_numbers(column: str) -> str:
    runs = f"regexp_extract_all({column}, '{WORD}+|{NONWORD}+')"
    return (
        f"array_to_string(list_transform({runs}, "
        r"lambda r: CASE WHEN regexp_full_match(r, '\p{Nd}+') THEN ' ' ELSE r END), '')"
    )


def sql_collapse(column: str) -> str:
    return f"trim({sub(column, SPACE + '+')})"


def clean_steps(config: CleanConfig) -> list[str]:
    """The cleaning of a configuration as expressions over ``text``, to be applied one after the other."""
    steps = []
    if config.lowercase:
        steps.append("lower(text)")
    if config.expand_contractions:
        steps.append(sql_contractions("text", config.contractions))
    if config.remove_html:
        steps += [sub("text", "<[^>]+>"), sub("text", "&[a-z]+;")]
    if config.remove_urls:
        steps.append(sub("text", rf"https?://{NONSPACE}+|www\.{NONSPACE}+"))
    if config.remove_mentions:
        steps.append(sub("text", f"@{WORD}+"))
    steps.append(sub("text", f"#{WORD}+") if config.remove_hashtags else "replace(text, '#', ' ')")
    if config.remove_numbers:
        steps.append(sql_numbers("text"))
    if config.remove_punctuation:
        steps.append(sub("text", r"[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x{85}\p{Z}]"))
    return [*steps, sql_collapse("text")]


def applied(source: str, steps: list[str], column: str = "text") -> str:
    for step in steps:
        source = f"SELECT * REPLACE ({step} AS {column}) FROM ({source})"
    return source


def sql_word_split(column: str) -> str:
    pairs = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"))
    cases = " ".join(f"WHEN '{a}{b}' THEN ['{a}', '{b}']" for a, b in pairs)
    return f"flatten(list_transform({sql_split(column)}, lambda w: CASE w {cases} ELSE [w] END))"


def sql_split(column: str) -> str:
    return f"list_filter(string_split({column}, ' '), lambda w: w <> '')"


def sql_keep(tokens: str, config: CleanConfig) -> str:
    test = f"length(w) BETWEEN {config.min_token_length} AND {config.max_token_length}"
    if config.remove_stopwords:
        test += f" AND NOT list_contains([{', '.join(map(quoted, config.stopwords))}], w)"
    return f"list_filter({tokens}, lambda w: {test})"


def sql_filtered(source: str, config: CleanConfig) -> str:
    """``source`` with a ``text`` column -> the same with ``tokens``; null and blank text gives no tokens."""
    cleaned = applied(source, ["coalesce(text, '')", *clean_steps(config)])
    split = sql_word_split("text") if config.tokenizer == "word" else sql_split("text")
    return f"SELECT * EXCLUDE (text), {sql_keep(split, config)} AS tokens FROM ({cleaned})"


# ------------------------------------------------------------------ shared inputs
SNIPPETS = (
    "It won't work, I can't and they didn't; it's John's",
    "see https://ex.org/a?b=1 and www.ex.org/x now",
    "@some_user thanks #topic_1 #more",
    "5 stars, 3.14 or x9 and 9x",
    "<b>bold</b><br/> &amp; &nbsp; &#39;",
    "I cannot, gonna or wanna go",
    "cities boxes wolves men churches",
)


def snippet_docs(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with a snippet appended, so that no cleaning step is idle, and rows more with a null or blank text."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source", "text")
    number = F.pmod("doc_id", F.lit(len(SNIPPETS))).cast("int")
    texts = docs.withColumn("text", F.concat_ws(" ", "text", F.get(F.array(*[F.lit(s) for s in SNIPPETS]), number)))
    missing = F.when(F.col("doc_id") % 16 == 7, F.lit(None).cast("string")).otherwise("   ")
    more = docs.where(F.col("doc_id") % 8 == 7).select((-1 - F.col("doc_id")).alias("doc_id"), "lang", "source", missing.alias("text"))
    return texts.unionByName(more)


SNIPPET_SQL = (
    f"SELECT doc_id, lang, source, concat_ws(' ', text, CASE doc_id % {len(SNIPPETS)} "
    + " ".join(f"WHEN {i} THEN {quoted(s)}" for i, s in enumerate(SNIPPETS))
    + " END) AS text FROM documents UNION ALL "
    "SELECT -1 - doc_id, lang, source, CASE WHEN doc_id % 16 <> 7 THEN '   ' END FROM documents WHERE doc_id % 8 = 7"
)

# without lemmas and stems, whose tables have checks of their own
PLAIN = review_config().but(lemmatization=False)


def processed(df: DataFrame, *keep: str, config: CleanConfig = PLAIN) -> DataFrame:
    return df.select(*keep, join_tokens(filtered_tokens(F.col("text"), config)).alias("processed"))


@lru_cache(maxsize=4)
def _processed_table(spark: SparkSession, folder: str) -> DataFrame:
    return settle(processed(table(spark, folder, "documents"), "doc_id", "lang", "source"), "processed")


def processed_docs(spark: SparkSession, folder: str) -> DataFrame:
    """The processed corpus, written once like the processed files that all later stages load."""
    return spread(_processed_table(spark, folder))


def sql_processed(source: str, config: CleanConfig = PLAIN) -> str:
    return f"SELECT * EXCLUDE (tokens), array_to_string(tokens, ' ') AS processed FROM ({sql_filtered(source, config)})"


PROCESSED_SQL = sql_processed("SELECT doc_id, lang, source, text FROM documents")


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled processed texts: ``(source, doc_id, processed, label)``."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return processed_docs(spark, folder).join(labels, "doc_id").select("source", "doc_id", "processed", "label")


LABELLED_SQL = (
    f"SELECT p.source, p.doc_id, p.processed, l.quality AS label FROM ({PROCESSED_SQL}) p "
    "JOIN labels l ON p.doc_id = l.doc_id"
)


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Three made-up models over the labelled rows, with tied scores; and ``toxic`` as an answer without a score."""
    labels = table(spark, folder, "labels")
    answers = []
    for model in ("alpha", "beta", "gamma"):
        part = F.conv(F.substring(F.md5(F.concat_ws("|", "doc_id", F.lit(model))), 1, 4), 16, 10).cast("int")
        score = (F.floor(part * 70 / 65536) + 30 * F.col("quality")) / F.lit(100.0)
        answers.append(F.struct(F.lit(model).alias("model"), score.alias("score")))
    return (
        labels.select("doc_id", F.col("quality").alias("label"), F.explode(F.array(*answers)).alias("a"))
        .select("doc_id", "label", "a.model", (F.col("a.score") > 0.5).cast("int").alias("prediction"), "a.score")
    )


PREDICTIONS_SQL = """
SELECT doc_id, label, model, (score > 0.5)::INT AS prediction, score FROM (
  SELECT doc_id, quality AS label, model,
         (floor(('0x' || substr(md5(doc_id || '|' || model), 1, 4))::INT * 70 / 65536) + 30 * quality) / 100.0 AS score
  FROM labels, (VALUES ('alpha'), ('beta'), ('gamma')) m(model))
"""
