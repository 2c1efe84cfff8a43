"""Lemmas and stems as set jobs over the distinct vocabulary, and the composed text processing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.config import NOUN_EXCEPTIONS, CleanConfig
from lexispark.functions.clean import clean
from lexispark.functions.stemming import stem
from lexispark.functions.tokens import filtered_tokens, join_tokens, kept_tokens, raw_tokens
from lexispark.operators.scale import broadcast_parts, lookup_join, settle, spread

# A dictionary of up to so many broadcasts is looked up part by part inside the row
LOOKUP_PARTS = 16

# Noun endings and what may replace them, in the order in which candidates are preferred.
NOUN_ENDINGS = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)


def distinct_terms(df: DataFrame, tokens: str) -> DataFrame:
    """Terms of a token column with their corpus frequency, written once for the passes that follow."""
    # exploding a plain column would make Spark push a size filter, and with it the tokenizing, down to the scan
    held = F.when(F.size(tokens) > 0, F.col(tokens))
    counts = df.select(F.explode(held).alias("term")).groupBy("term").agg(F.count("*").alias("cf"))
    return spread(settle(counts, "terms"), "term")


def corpus_lexicon(terms: DataFrame, min_cf: int = 2) -> DataFrame:
    """The default lexicon: terms that the corpus uses at least ``min_cf`` times."""
    return terms.where(F.col("cf") >= min_cf).select(F.col("term").alias("form"))


def default_exceptions(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(list(NOUN_EXCEPTIONS), "term string, form string")


def _detach(form: Column) -> Column:
    """All forms one ending shorter, in rule order."""
    detached = [
        F.when(form.endswith(ending), F.concat(F.substring(form, F.lit(1), F.length(form) - len(ending)), F.lit(new)))
        for ending, new in NOUN_ENDINGS
    ]
    return F.array_compact(F.array(*detached))


def _candidates(term: Column) -> Column:
    """array<struct<round, place, form>>: the term and its detached forms, then the forms of those, and so on.

    Every ending shortens a word or leaves one that no ending fits, so length(term) rounds reach the end.
    """

    def candidate(number: Column, place: Column, form: Column) -> Column:
        return F.struct(number.alias("round"), place.alias("place"), form.alias("form"))

    def next_round(state: Column, number: Column) -> Column:
        forms = F.flatten(F.transform(state["open"], _detach))
        found = F.transform(forms, lambda form, at: candidate(number, at + 1, form))
        return F.struct(forms.alias("open"), F.concat(state["found"], found).alias("found"))

    start = F.struct(
        F.array(term).alias("open"),
        F.array(candidate(F.lit(1), F.lit(0), term)).alias("found"),
    )
    rounds = F.sequence(F.lit(1), F.greatest(F.length(term), F.lit(1)))
    return F.aggregate(rounds, start, next_round, lambda state: state["found"])


def lemmatize(terms: DataFrame, lexicon: DataFrame, exceptions: DataFrame) -> DataFrame:
    """Noun lemma of each distinct term: ``(term, lemma)``.

    ``terms`` holds each term once. ``lexicon(form)`` holds the known words, ``exceptions(term, form)`` irregular forms, which replace the rules for
    their term. Of the first round of detached endings that holds a known word, the shortest known word wins, then
    the earlier rule. A term without a known form is its own lemma.
    """
    irregular = exceptions.groupBy("term").agg(F.sort_array(F.collect_set("form")).alias("_forms"))
    listed = F.transform(
        F.concat(F.array("term"), F.col("_forms")),
        lambda form, at: F.struct(F.lit(1).alias("round"), at.alias("place"), form.alias("form")),
    )
    inflected = reduce(lambda acc, rule: acc | F.col("term").endswith(rule[0]), NOUN_ENDINGS, F.col("_forms").isNotNull())
    tried = (
        terms.join(irregular, "term", "left")
        .where(inflected)
        .select(
            "term",
            F.explode(F.when(F.col("_forms").isNotNull(), listed).otherwise(_candidates(F.col("term")))).alias("c"),
        )
        .select("term", "c.*")
    )
    known = tried.join(lexicon.select("form").distinct(), "form")
    best = known.groupBy("term").agg(
        F.min_by("form", F.struct("round", F.length("form"), "place")).alias("lemma")
    )
    return terms.join(best, "term", "left").select("term", F.coalesce("lemma", "term").alias("lemma"))


def stem_terms(terms: DataFrame) -> DataFrame:
    """Stem of each distinct term: ``(term, stem)``."""
    return terms.select("term", stem(F.col("term")).alias("stem"))


def replace_terms(df: DataFrame, tokens: str, mapping: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace tokens by a ``(term, new_term)`` mapping, keeping their order; unmapped tokens stay.

    Returns one row per row of ``df`` with the token array, also where keys repeat. Only the mapping's changed terms matter.
    Where their measured size allows, they are a dictionary in every task, or several one after the other, and tokens are
    replaced inside their row; beyond that they are joined, and the tokens of a row meet again in one shuffle on its number.
    """
    changed = _changed(mapping)
    replaced = _in_row(changed)
    if replaced is not None:
        return df.select(*keys, replaced(_held(tokens)).alias(tokens))
    return _joined_terms(df, tokens, changed, keys)


def _changed(mapping: DataFrame) -> DataFrame:
    return settle(mapping.where(F.col("new_term") != F.col("term")).select("term", "new_term"), "term-map")


def _held(tokens: str) -> Column:
    return F.coalesce(F.col(tokens), F.array().cast("array<string>"))


def _in_row(changed: DataFrame):
    """A function of token arrays that replaces the terms of a settled table, or None if they are too many for that."""
    parts = broadcast_parts(changed, LOOKUP_PARTS)
    if parts <= 1:
        return _looked_up(changed) if parts else None
    number = F.pmod(F.xxhash64("term"), F.lit(parts))
    return _looked_up(*(changed.where(number == part) for part in range(parts)))


def _looked_up(*tables: DataFrame):
    """A function of token arrays that looks tokens up in tables ``(term, new_term)``, whose sizes have been checked.

    A whole batch of tokens is looked up at once in a hash table; the built-in functions only have maps that are searched
    from one end. The hash table is that of the batch's distinct tokens and the dictionary is what passes over it, so a
    worker holds no hash table of the dictionary, however large that is. Of several tables, which share no term, a worker
    holds one at a time and reads the next from its local copy.
    """
    sent = [changed.sparkSession.sparkContext.broadcast(changed.toArrow().combine_chunks()) for changed in tables]

    @F.arrow_udf("array<string>")
    def replaced(tokens: pa.Array) -> pa.Array:
        length = pc.list_value_length(tokens).to_numpy(zero_copy_only=False)
        held = tokens.flatten().dictionary_encode()
        words = found = held.dictionary
        for part in sent:
            table = part.value
            if table.num_rows:
                at = pc.index_in(table["term"].combine_chunks(), value_set=words)
                row = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
                source = np.full(len(words), -1)
                source[at.drop_null().to_numpy()[::-1]] = row[::-1]  # of equal terms the first counts
                found = pc.coalesce(table["new_term"].combine_chunks().take(pa.array(source, mask=source < 0)), found)
            if len(sent) > 1:
                part.__dict__.pop("_value", None)  # a worker has no other way to let go of a broadcast
        flat = found.take(held.indices)
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), flat)

    return replaced


def _joined_terms(df: DataFrame, tokens: str, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = df.select(*keys, tokens).withColumn("_row", F.monotonically_increasing_id())
    placed = rows.repartition("_row").select(*keys, "_row", F.posexplode_outer(tokens).alias("pos", "term"))
    joined = lookup_join(placed, changed, "term", ["_row", "pos"], "left", broadcast=False)
    token = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("new_term", "term").alias("term")))
    regrouped = joined.groupBy("_row", *keys).agg(F.sort_array(F.collect_list(token)).alias("_placed"))
    return regrouped.select(*keys, F.col("_placed.term").alias(tokens))


def normalize(
    df: DataFrame,
    tokens: str,
    config: CleanConfig,
    keys: Sequence[str],
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Lemmas or stems for a token column; lemmas win if both are switched on, neither leaves the tokens alone."""
    if not (config.lemmatization or config.stemming):
        return df.select(*keys, tokens)
    # two passes follow; reading written tokens is far cheaper than cleaning the texts again
    df = settle(df.select(*keys, tokens), "tokens")
    return replace_terms(df, tokens, _mapping(df, tokens, config, lexicon, exceptions), keys)


def _mapping(df: DataFrame, tokens: str, config: CleanConfig, lexicon: DataFrame | None, exceptions: DataFrame | None) -> DataFrame:
    """``(term, new_term)``: lemmas or stems of the terms of a written token column."""
    terms = distinct_terms(df, tokens)
    if not config.lemmatization:
        return stem_terms(terms).withColumnRenamed("stem", "new_term")
    lexicon = corpus_lexicon(terms) if lexicon is None else lexicon
    exceptions = default_exceptions(df) if exceptions is None else exceptions
    return lemmatize(terms, lexicon, exceptions).withColumnRenamed("lemma", "new_term")


def process(
    df: DataFrame,
    text: str,
    config: CleanConfig,
    keys: Sequence[str] = ("doc_id",),
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
    out: str = "processed",
) -> DataFrame:
    """Raw text to the space-joined string of normalized tokens: ``keys`` and ``processed``.

    Columns to carry along (labels, sources) may be listed with the keys. Every row gives one row, also where keys repeat.
    """
    tokens = df.select(*keys, filtered_tokens(F.col(text), config).alias("_tokens"))
    normalized = normalize(tokens, "_tokens", config, keys, lexicon, exceptions)
    return normalized.select(*keys, join_tokens(F.col("_tokens")).alias(out))


def process_batch(df: DataFrame, text: str, config: CleanConfig, **options) -> DataFrame:
    """A corpus is processed like a single text: one plan over all rows."""
    return process(df, text, config, **options)


def explain_steps(
    df: DataFrame,
    text: str,
    config: CleanConfig,
    keys: Sequence[str] = ("doc_id",),
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Every intermediate result per row; unlike ``process`` without the blank guard."""
    cleaned = clean(F.col(text), config)
    steps = df.select(*keys, F.col(text).alias("original"), cleaned.alias("after_cleaning"))
    steps = steps.withColumn("tokens_raw", raw_tokens(F.col("after_cleaning"), config))
    steps = steps.withColumn("tokens_normalized", kept_tokens(F.col("tokens_raw"), config))
    if config.lemmatization or config.stemming:
        steps = settle(steps.withColumn("_row", F.monotonically_increasing_id()), "explained")
        changed = _changed(_mapping(steps, "tokens_normalized", config, lexicon, exceptions))
        replaced = _in_row(changed)
        if replaced is not None:
            steps = steps.withColumn("tokens_normalized", replaced(_held("tokens_normalized"))).drop("_row")
        else:
            # only row numbers and tokens pass through the set job; the wide columns come back by one join
            narrow = steps.select(F.col("_row").alias("_step"), "tokens_normalized")
            normalized = _joined_terms(narrow, "tokens_normalized", changed, ["_step"])
            steps = steps.drop("tokens_normalized").join(normalized, F.col("_row") == F.col("_step")).drop("_row", "_step")
    return steps.withColumn("final", join_tokens(F.col("tokens_normalized")))
