"""Tokenizing and token filters as Column -> Column functions over ARRAY<STRING>."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark.config import CleanConfig
from lexispark.functions.clean import clean, has_text
from lexispark.functions.patterns import SPACE, WORD, WORD_END

# rows whose tokens are counted at once
COUNTED_ROWS = 1 << 10

# Fused words that the word tokenizer splits, as (first part, second part).
FUSED_WORDS = (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na"))


def tokenize_whitespace(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def split_fused_words(text: Column) -> Column:
    # the look-behind stands after the literal part, so it is tried at a handful of places only
    heads = "|".join(f"{head}(?={tail}{WORD_END})" for head, tail in FUSED_WORDS)
    return F.regexp_replace(text, f"(?i)({heads})(?<!{WORD}[a-z]{{3}})", "$1 ")


def tokenize_words(text: Column) -> Column:
    """Word tokens of punctuation-free text: whitespace tokens with the fused words split in two."""
    return tokenize_whitespace(split_fused_words(text))


def filter_length(tokens: Column, low: int, high: int) -> Column:
    return F.filter(tokens, lambda token: F.length(token).between(low, high))


def remove_stopwords(tokens: Column, words: Sequence[str]) -> Column:
    return F.filter(tokens, lambda token: ~token.isin(*words)) if words else tokens


def join_tokens(tokens: Column) -> Column:
    return F.array_join(tokens, " ")


def raw_tokens(cleaned: Column, config: CleanConfig) -> Column:
    """Tokens of a cleaned text, whose words are already parted by single spaces."""
    spaced = split_fused_words(cleaned) if config.tokenizer == "word" else cleaned
    return F.array_remove(F.split(spaced, " "), "")


def kept_tokens(tokens: Column, config: CleanConfig) -> Column:
    """Length and stopword filters in one pass over the array."""
    words = config.stopwords if config.remove_stopwords else ()

    def keep(token: Column) -> Column:
        fits = F.length(token).between(config.min_token_length, config.max_token_length)
        return fits & ~token.isin(*words) if words else fits

    return F.filter(tokens, keep)


def filtered_tokens(text: Column, config: CleanConfig) -> Column:
    """Raw text to filtered tokens, with the blank guard; everything before lemmas or stems."""
    tokens = kept_tokens(raw_tokens(clean(text, config), config), config)
    return F.when(has_text(text), tokens).otherwise(F.array().cast("array<string>"))


def term_bag(tokens: Column) -> Column:
    """Distinct terms of one document with their counts, as array<struct<term, tf>>.

    The array is sorted once and cut at the places where the term changes, so a document's counts need neither a
    shuffle nor a pass over the array per term.
    """
    holder = F.array(F.struct(F.sort_array(tokens).alias("terms")))

    def runs(doc: Column) -> Column:
        terms = doc["terms"]
        starts = F.filter(
            F.sequence(F.lit(1), F.size(terms)),
            lambda i: (i == 1) | (F.get(terms, i - 1) != F.get(terms, i - 2)),
        )
        return F.struct(terms.alias("terms"), starts.alias("starts"))

    def counted(doc: Column) -> Column:
        terms, starts = doc["terms"], doc["starts"]
        return F.transform(
            starts,
            lambda start, at: F.struct(
                F.get(terms, start - 1).alias("term"),
                (F.coalesce(F.get(starts, at + 1), F.size(terms) + 1) - start).alias("tf"),
            ),
        )

    # each transform over the one-element holder binds its input once, so the sort is not repeated per term
    return F.when(
        F.size(tokens) > 0, F.get(F.transform(F.transform(holder, runs), counted), F.lit(0))
    ).otherwise(F.array().cast("array<struct<term:string,tf:int>>"))


def token_counts(tokens: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each ``COUNTED_ROWS`` arrays of tokens the distinct terms, and by row and term the row, the term's number and its count."""
    for first in range(0, len(tokens), COUNTED_ROWS):
        part = tokens.slice(first, COUNTED_ROWS)
        length = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
        coded = part.flatten().dictionary_encode()
        most = max(1, len(coded.dictionary))
        key, count = np.unique(np.repeat(np.arange(len(part)), length) * most + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        yield coded.dictionary, key // most, key % most, count


def _bags(tokens: pa.Array) -> pa.Array:
    bags = []
    for terms, row, term, count in token_counts(tokens):
        held = pa.StructArray.from_arrays([terms.take(pa.array(term)), pa.array(count, pa.int32())], ["term", "tf"])
        rows = min(COUNTED_ROWS, len(tokens) - COUNTED_ROWS * len(bags))
        bags.append(pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), held))
    return pa.concat_arrays(bags) if bags else pa.array([], pa.list_(pa.struct([("term", pa.string()), ("tf", pa.int32())])))


def counted_bag(tokens: Column) -> Column:
    """``term_bag`` in no order, made in a Python worker for many rows at once, for plans that explode the bag and shuffle it."""
    return F.arrow_udf(_bags, "array<struct<term:string,tf:int>>")(tokens)
