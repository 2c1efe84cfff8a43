"""Suffix-stripping stemmer (M. F. Porter, 1980, with the widely used extensions for short words and irregular
forms) as Column expressions. It is meant for the distinct vocabulary, see ``operators.normalize.stem_terms``.

A word is described by its shape, one ``c`` (consonant) or ``v`` (vowel) per letter; the rules' conditions are
regular expressions over the shape of the part before the suffix.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Forms that skip the rules, as (form, stem).
IRREGULAR_STEMS = (
    ("sky", "sky"),
    ("skies", "sky"),
    ("dying", "die"),
    ("lying", "lie"),
    ("tying", "tie"),
    ("news", "news"),
    ("innings", "inning"),
    ("inning", "inning"),
    ("outings", "outing"),
    ("outing", "outing"),
    ("cannings", "canning"),
    ("canning", "canning"),
    ("howe", "howe"),
    ("proceed", "proceed"),
    ("exceed", "exceed"),
    ("succeed", "succeed"),
)
# Fixed values: (suffix, replacement); in each list the first suffix that matches decides.
PLURAL_RULES = (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", ""))
DOUBLE_SUFFIX_RULES = (
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
)
ADJECTIVE_RULES = (
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
)
REMOVED_SUFFIXES = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()
)

# conditions on the shape of a stem
MEASURE_POSITIVE = "vc"
MEASURE_ONE = "^c*v+c+v*$"
MEASURE_ABOVE_ONE = "vc+v+c"
HAS_VOWEL = "v"


def shape(word: Column) -> Column:
    """``y`` is a vowel after a consonant and a consonant at the start or after a vowel."""

    def extend(seen: Column, letter: Column) -> Column:
        vowel = letter.isin(*"aeiou") | ((letter == "y") & seen.endswith("c"))
        return F.concat(seen, F.when(vowel, "v").otherwise("c"))

    return F.aggregate(F.split(word, ""), F.lit(""), extend)


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _first_rule(
    word: Column, word_shape: Column, rules: Sequence[tuple[str, str]], condition: Callable[[str, Column, Column], Column]
) -> Column:
    """The first rule whose suffix matches decides; if its condition fails the word stays."""
    result = None
    for suffix, replacement in rules:
        stem, stem_shape = _cut(word, len(suffix)), _cut(word_shape, len(suffix))
        outcome = F.when(condition(suffix, stem, stem_shape), F.concat(stem, F.lit(replacement))).otherwise(word)
        result = (F.when if result is None else result.when)(word.endswith(suffix), outcome)
    return result.otherwise(word)


def _ends_cvc(word: Column, word_shape: Column) -> Column:
    """Consonant, vowel, consonant other than w, x, y; or the two letters vowel, consonant."""
    return (word_shape.endswith("cvc") & ~word.rlike("[wxy]$")) | (word_shape == "vc")


def _plurals(word, _):
    short = F.when(word.rlike("^.ies$"), _cut(word, 1))
    return short.otherwise(_first_rule(word, F.lit(""), PLURAL_RULES, lambda *_: F.lit(True)))


def _past_and_gerund(word, word_shape):
    """Marks a removed ``ed``/``ing`` by a trailing hyphen, so that the repair below sees only those stems."""

    def drop(n):
        return F.when(_cut(word_shape, n).rlike(HAS_VOWEL), F.concat(_cut(word, n), F.lit("-"))).otherwise(word)

    eed = F.when(_cut(word_shape, 3).rlike(MEASURE_POSITIVE), _cut(word, 1)).otherwise(word)
    return (
        F.when(word.rlike("^.ied$"), _cut(word, 1))
        .when(word.endswith("ied"), _cut(word, 2))
        .when(word.endswith("eed"), eed)
        .when(word.endswith("ed"), drop(2))
        .when(word.endswith("ing"), drop(3))
        .otherwise(word)
    )


def _repair(word, word_shape):
    stem, stem_shape = _cut(word, 1), _cut(word_shape, 1)
    double = stem.rlike(r"(.)\1$") & stem_shape.endswith("c")
    short = stem_shape.rlike(MEASURE_ONE) & _ends_cvc(stem, stem_shape)
    repaired = (
        F.when(stem.rlike("(at|bl|iz)$"), F.concat(stem, F.lit("e")))
        .when(double, F.when(stem.rlike("[lsz]$"), stem).otherwise(_cut(stem, 1)))
        .when(short, F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )
    return F.when(word.endswith("-"), repaired).otherwise(word)


def _final_y(word, word_shape):
    after_consonant = (F.length(word) > 2) & _cut(word_shape, 1).endswith("c")
    return F.when(word.endswith("y") & after_consonant, F.concat(_cut(word, 1), F.lit("i"))).otherwise(word)


def _ally(word, word_shape):
    """``-alli`` becomes ``-al`` before the double suffixes are looked at."""
    return F.when(word.endswith("alli") & _cut(word_shape, 4).rlike(MEASURE_POSITIVE), _cut(word, 2)).otherwise(word)


def _double_suffixes(word, word_shape):
    def positive(suffix, stem, stem_shape):
        return stem_shape.rlike(MEASURE_POSITIVE)

    logi = F.when(_cut(word_shape, 3).rlike(MEASURE_POSITIVE), _cut(word, 1)).otherwise(word)
    return F.when(word.endswith("logi"), logi).otherwise(_first_rule(word, word_shape, DOUBLE_SUFFIX_RULES, positive))


def _adjectives(word, word_shape):
    return _first_rule(word, word_shape, ADJECTIVE_RULES, lambda _, stem, stem_shape: stem_shape.rlike(MEASURE_POSITIVE))


def _removals(word, word_shape):
    def removable(suffix, stem, stem_shape):
        long_enough = stem_shape.rlike(MEASURE_ABOVE_ONE)
        return long_enough & stem.rlike("[st]$") if suffix == "ion" else long_enough

    return _first_rule(word, word_shape, [(suffix, "") for suffix in REMOVED_SUFFIXES], removable)


def _final_e(word, word_shape):
    stem, stem_shape = _cut(word, 1), _cut(word_shape, 1)
    droppable = stem_shape.rlike(MEASURE_ABOVE_ONE) | (stem_shape.rlike(MEASURE_ONE) & ~_ends_cvc(stem, stem_shape))
    return F.when(word.endswith("e") & droppable, stem).otherwise(word)


def _final_ll(word, word_shape):
    return F.when(word.endswith("ll") & _cut(word_shape, 1).rlike(MEASURE_ABOVE_ONE), _cut(word, 1)).otherwise(word)


_STEPS = (
    _plurals,
    _past_and_gerund,
    _repair,
    _final_y,
    _ally,
    _double_suffixes,
    _adjectives,
    _removals,
    _final_e,
    _final_ll,
)


def _shaped(word: Column, word_shape: Column) -> Column:
    return F.struct(word.alias("word"), word_shape.alias("shape"))


def _apply(step: Callable[[Column, Column], Column], state: Column) -> Column:
    """One step on a one-element array of word and shape. The lambdas bind both once, so that chaining the steps
    keeps the expression small wherever the optimizer moves it. Only a changed word gets a new shape."""

    def stepped(it: Column) -> Column:
        return F.struct(it["word"].alias("old"), it["shape"].alias("shape"), step(it["word"], it["shape"]).alias("word"))

    return F.transform(
        F.transform(state, stepped),
        lambda it: _shaped(it["word"], F.when(it["word"] == it["old"], it["shape"]).otherwise(shape(it["word"]))),
    )


def stem(term: Column) -> Column:
    irregular = None
    for form, stem_of_form in IRREGULAR_STEMS:
        irregular = (F.when if irregular is None else irregular.when)(F.lower(term) == form, stem_of_form)
    short = F.length(term) <= 2
    start = F.array(_shaped(F.lower(term), shape(F.lower(term))))
    regular = F.get(reduce(lambda state, step: _apply(step, state), _STEPS, start), F.lit(0))
    return irregular.when(short, F.lower(term)).otherwise(regular["word"])
