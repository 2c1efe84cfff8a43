"""Text cleaning as Column -> Column functions. They nest into one projection, so a scan, the cleaning and the
tokenizing run as one stage without a shuffle and without Python workers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexispark.config import CleanConfig
from lexispark.functions.patterns import NOT_SPACE, NOT_WORD, SPACE, SPACE_CHARS, WORD, WORD_CHARS, WORD_END, WORD_START


def lower_text(text: Column) -> Column:
    return F.lower(text)


def expand_contractions(text: Column, mapping: Sequence[tuple[str, str]]) -> Column:
    """Literal, case-sensitive replacement in list order; earlier entries shadow later ones."""
    return reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), mapping, text)


def strip_html_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", " ")


def strip_entities(text: Column) -> Column:
    """Only lower-case alphabetic names; numeric entities stay."""
    return F.regexp_replace(text, "&[a-z]+;", " ")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?:https?://|www\.){NOT_SPACE}+", " ")


def strip_mentions(text: Column) -> Column:
    return F.regexp_replace(text, f"@{WORD}+", " ")


def drop_hashtags(text: Column) -> Column:
    """Removes the hashtag together with its word."""
    return F.regexp_replace(text, f"#{WORD}+", " ")


def strip_hash_symbol(text: Column) -> Column:
    return F.replace(text, F.lit("#"), F.lit(" "))


def strip_numbers(text: Column) -> Column:
    """Numbers standing alone; digits inside a word stay."""
    return F.regexp_replace(text, WORD_START + r"\p{Nd}+" + WORD_END, " ")


def strip_punctuation(text: Column) -> Column:
    return F.regexp_replace(text, f"[^{WORD_CHARS}{SPACE_CHARS}]", " ")


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


def has_text(text: Column) -> Column:
    """False for null and for blank text."""
    return F.coalesce(text.rlike(NOT_SPACE), F.lit(False))


def blank_guard(text: Column) -> Column:
    """Null or whitespace-only text becomes the empty string."""
    return F.when(has_text(text), text).otherwise(F.lit(""))


def words_only(text: Column) -> Column:
    """``strip_punctuation`` and ``collapse_whitespace`` in one pass: every run of other characters is one space."""
    return F.trim(F.regexp_replace(text, f"{NOT_WORD}+", " "))


def _where_found(needles: Sequence[str], step: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """A step that runs only on texts holding one of its needles. A literal search is far cheaper than a regular
    expression, and most texts hold none."""

    def guarded(text: Column) -> Column:
        found = reduce(lambda acc, needle: acc | F.contains(text, F.lit(needle)), needles, F.lit(False))
        return F.when(found, step(text)).otherwise(text)

    return guarded


def clean_steps(config: CleanConfig) -> list[Callable[[Column], Column]]:
    """The cleaning steps of a configuration in their fixed order."""
    steps = [lower_text] if config.lowercase else []
    if config.expand_contractions and config.contractions:
        needles = {"'"} if all("'" in short for short, _ in config.contractions) else {s for s, _ in config.contractions}
        steps.append(_where_found(sorted(needles), lambda text: expand_contractions(text, config.contractions)))
    if config.remove_html:
        steps += [_where_found(["<"], strip_html_tags), _where_found(["&"], strip_entities)]
    if config.remove_urls:
        steps.append(_where_found(["://", "www."], strip_urls))
    if config.remove_mentions:
        steps.append(_where_found(["@"], strip_mentions))
    steps.append(_where_found(["#"], drop_hashtags if config.remove_hashtags else strip_hash_symbol))
    if config.remove_numbers:
        steps.append(strip_numbers)
    steps.append(words_only if config.remove_punctuation else collapse_whitespace)
    return steps


def clean(text: Column, config: CleanConfig) -> Column:
    """All cleaning steps of a configuration. A lambda over a one-element array binds each intermediate text once,
    so that the guards do not multiply the expression."""
    stepped = reduce(lambda texts, step: F.transform(texts, step), clean_steps(config), F.array(text))
    return F.get(stepped, F.lit(0))
