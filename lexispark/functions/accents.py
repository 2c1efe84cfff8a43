"""Accent folding: compatibility decomposition without combining marks, as a JVM-side Column expression.

Spark has no normalization function. The mapping of single characters is derived from the Unicode character
database when the plan is built and applied with ``translate`` (one hash lookup per character). Characters that
decompose into several (ligatures, Hangul syllables) take a second, guarded path.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_HANGUL = "[\\x{AC00}-\\x{D7A3}]"


@lru_cache(maxsize=1)
def _folding() -> tuple[dict[str, str], str, dict[str, str]]:
    """(one-to-one folds, characters to delete, one-to-many folds without Hangul syllables)."""
    single, dropped, multiple = {}, [], {}
    for code in range(128, sys.maxunicode + 1):
        char = chr(code)
        if 0xD800 <= code <= 0xDFFF or 0xAC00 <= code <= 0xD7A3:
            continue
        if unicodedata.combining(char):
            dropped.append(char)
            continue
        parts = unicodedata.normalize("NFKD", char)
        if parts == char:
            continue
        folded = "".join(part for part in parts if not unicodedata.combining(part))
        if not folded:
            dropped.append(char)
        elif len(folded) > 1:
            multiple[char] = folded
        elif folded != char:
            single[char] = folded
    return single, "".join(dropped), multiple


@lru_cache(maxsize=1)
def _hangul_columns() -> tuple[str, str, str, str]:
    """All syllables, and for each position the jamo they decompose to ('\\0' where there is no third one)."""
    syllables = [chr(code) for code in range(0xAC00, 0xD7A4)]
    parts = [unicodedata.normalize("NFD", syllable).ljust(3, "\0") for syllable in syllables]
    return "".join(syllables), *("".join(part[i] for part in parts) for i in range(3))


def _spell_out(text: Column) -> Column:
    """Fold the characters that become several ones, character by character."""
    _, _, multiple = _folding()
    pairs = F.map_from_arrays(F.split(F.lit("".join(multiple)), ""), F.split(F.lit("\x01".join(multiple.values())), "\x01"))
    syllables, first, second, third = _hangul_columns()

    def spell(char: Column) -> Column:
        jamo = [F.translate(char, syllables, column) for column in (first, second, third)]
        return (
            F.when(char.rlike(_HANGUL), F.replace(F.concat(*jamo), F.lit("\0"), F.lit("")))
            .when(~F.contains(F.lit("".join(multiple)), char), char)
            .otherwise(F.element_at(pairs, char))
        )

    return F.array_join(F.transform(F.split(text, ""), spell), "")


def fold_accents(text: Column, mode: str | None = "unicode") -> Column:
    """``unicode`` strips accents of any script, ``ascii`` also drops what is then still not ASCII."""
    if mode is None:
        return text
    single, dropped, multiple = _folding()
    to_spell_out = "".join(multiple) + _hangul_columns()[0]
    spelled = F.when(F.translate(text, to_spell_out, "") == text, text).otherwise(_spell_out(text))
    folded = F.translate(spelled, "".join(single) + dropped, "".join(single.values()))
    folded = F.when(text.rlike("[^\\x00-\\x7F]"), folded).otherwise(text)
    return F.regexp_replace(folded, "[^\\x00-\\x7F]", "") if mode == "ascii" else folded
