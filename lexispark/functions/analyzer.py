"""The analyzer shared by counts and TF-IDF: lower-case, fold accents, tokens of two or more word characters,
word n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark.config import VectorConfig
from lexispark.functions.accents import fold_accents
from lexispark.functions.patterns import NOT_WORD


def word_tokens(text: Column, config: VectorConfig) -> Column:
    """Null text yields no tokens."""
    text = F.coalesce(text, F.lit(""))
    text = F.lower(text) if config.lowercase else text
    words = F.split(fold_accents(text, config.strip_accents), f"{NOT_WORD}+")
    return F.filter(words, lambda word: F.length(word) >= 2)


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All runs of ``low`` to ``high`` neighbouring tokens, joined by a space, shorter runs first."""

    def runs_of(words: Column, n: int) -> Column:
        if n == 1:
            return words
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
        runs = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, runs).otherwise(F.array().cast("array<string>"))

    # the outer lambda binds the token array once; inside the inner one it would be evaluated per position
    return F.get(
        F.transform(F.array(tokens), lambda words: F.concat(*[runs_of(words, n) for n in range(low, high + 1)])), F.lit(0)
    )


def analyze(text: Column, config: VectorConfig) -> Column:
    tokens = word_tokens(text, config)
    return tokens if config.ngram_range == (1, 1) else ngrams(tokens, *config.ngram_range)
