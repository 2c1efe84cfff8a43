"""Language of a text by the rank order of its most frequent character n-grams (n = 1 to 3).

A profile is the list of the ``top`` most frequent n-grams of a language; a text's distance to it adds up how far each of
the text's own most frequent n-grams is out of place, ``top`` for one that the profile lacks. Texts are lower-cased, all
that is not a letter separates words, and n-grams may reach over a word's edge by one space, never over a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOP = 300
# n-grams of texts are added up after so many
GRAMS = 1 << 20
UNKNOWN = "und"
# A text is not in a learned language below this share of the score that all but LOW of that language's texts reach.
SHARE, LOW = 0.5, 0.01


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, packed into 63 bits with 21 per character, and their counts."""
    code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    code = np.where(_letters()[code], code, 32)
    code = np.concatenate([[32], code, [32]])
    space = code == 32
    keep = ~(space & np.append(False, space[:-1]))
    code, space = code[keep], space[keep]
    if len(code) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    two = code[:-1] << 21 | code[1:]
    three = (two[:-1] << 21 | code[2:])[~space[1:-1]]
    return np.unique(np.concatenate([code[~space], two, three]), return_counts=True)


def ranked(gram: np.ndarray, count: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by n-gram."""
    return gram[np.lexsort((gram, -count))[:top]]


class Profiles:
    def __init__(self, rows: list[tuple[str, int, int]], top: int):
        """``rows``: language, n-gram, rank from 0."""
        self.top, self.names, self.tables = top, sorted({r[0] for r in rows}), []
        for name in self.names:
            gram, rank = np.array([(g, r) for n, g, r in rows if n == name], np.int64).T
            order = np.argsort(gram)
            self.tables.append((gram[order], rank[order]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """Nearest language (the first by name of equals) and one minus its distance as a share of the largest possible."""
        mine = ranked(*gram_counts(text), self.top)
        if not len(mine) or not self.names:
            return UNKNOWN, 0.0
        place, best = np.arange(len(mine)), None
        for name, (gram, rank) in zip(self.names, self.tables):
            at = np.minimum(np.searchsorted(gram, mine), len(gram) - 1)
            distance = int(np.where(gram[at] == mine, np.abs(rank[at] - place), self.top).sum())
            if best is None or distance < best[1]:
                best = (name, distance)
        return best[0], 1.0 - best[1] / (self.top * len(mine))


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that nothing is learned from: crc32 of the id as text, mod 3, is 1; and those without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(True))


def learn(docs: DataFrame, top: int = TOP) -> Profiles:
    """Profiles from text and lang of all documents that are not held out."""
    chosen = docs.where(~held_out() & F.col("lang").isNotNull()).select("lang", "text")

    def added(found: dict[str, list]) -> Iterator[pa.RecordBatch]:
        for lang, parts in found.items():
            gram, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            count = np.bincount(at, np.concatenate([p[1] for p in parts]), len(gram)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(gram), pa.string()), pa.array(gram), pa.array(count)], ["lang", "gram", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {}
            held = 0
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                grams = gram_counts(text)
                found.setdefault(lang, []).append(grams)
                held += len(grams[0])
                if held >= GRAMS:
                    yield from added(found)
                    found, held = {}, 0
            yield from added(found)

    counts = chosen.mapInArrow(counted, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", "gram", "rank").collect()
    return Profiles([(r[0], r[1], r[2] - 1) for r in rows], top)


def predicted(text: Column, profiles: Profiles) -> Column:
    """Struct of ``lang_pred`` and ``score`` for each text."""

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([profiles.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict(text)


def limits(docs: DataFrame, profiles: Profiles) -> dict[tuple[str, int], float]:
    """Least score of a text, per language and bit length of the text's length.

    Calibrated on all held-out documents that are recognised as what they are labelled.
    """
    held = docs.where(held_out() & F.col("doc_id").isNotNull() & F.col("lang").isNotNull())
    scored = held.select("lang", F.length(F.bin(F.length("text"))).alias("bits"), predicted(F.col("text"), profiles).alias("p"))
    right = (F.col("p.lang_pred") == F.col("lang")) & (F.col("p.score") > 0)
    # a score is a distance over the largest one, so there are only so many different ones to a group; counted, since a
    # filter would move below the prediction with a second one of its own, in a worker of its own
    scores = scored.groupBy("lang", "bits", F.col("p.score").alias("score")).agg(F.count_if(right).alias("n")).where("n > 0")
    # bounded: languages x 32
    low = scores.groupBy("lang", "bits").agg(F.percentile("score", F.lit(LOW), F.col("n")).alias("low")).collect()
    return {(r["lang"], r["bits"]): SHARE * r["low"] for r in low}


def recognised(text: Column, profiles: Profiles, least: dict[tuple[str, int], float]) -> Column:
    """Whether a text is in a learned language: its score is above 0 and not below its limit, if there is one.

    If no language could be learned, every text with a letter is.
    """

    def known(text: str | None) -> bool:
        if not profiles.names:
            return len(gram_counts(text)[0]) > 0
        name, score = profiles.predict(text)
        return score > 0 and score >= least.get((name, len(text).bit_length()), 0.0)

    @F.pandas_udf("boolean")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([known(t) for t in texts], dtype=bool)

    return decide(text)


def identify(docs: DataFrame, top: int = TOP) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    ``docs`` has doc_id, text and lang; other columns are not read. Null texts and texts without letters are ``und`` with
    score 0, and so is everything if there is nothing to learn from. Ties go to the first language by name. Rows
    without doc_id are predicted, held out and not learned from; repeated rows are kept. An empty table gives an
    empty result.
    """
    profiles = learn(docs, top)
    rows = docs.select("doc_id", held_out().alias("held_out"), predicted(F.col("text"), profiles).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")
