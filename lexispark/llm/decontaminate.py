"""Documents that hold a test item with a few edits: exact pieces by the pigeonhole principle, then Myers' bit-parallel distance.

Texts and items are compared in lower case with white space runs as one space. An item of m characters has an error budget
of e edits and is cut into e + 1 pieces; a text that holds it with at most e insertions, deletions and substitutions holds
one of the pieces unchanged. All pieces are searched in one pass per text; each hit fixes a stretch of the text, in which
the least distance of the item to any substring is computed, unless the stretch lacks more than e of the item's disjoint
blocks, as then no substring can be near enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.operators.scale import settle

# Items are searched in blocks of at most about this many bytes, so that what a task holds does not grow with them.
BLOCK_BYTES = 4 << 20
# An edit spoils at most one of an item's disjoint blocks of so many characters.
PROBE = 5
_HIT = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType()) for n in ("item_id", "distance", "start", "end", "budget")])
)


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def budget(length: int, error_rate: float) -> int:
    """Edits allowed for an item: a share of its length, but never as many as leave a piece without characters."""
    return max(0, min(int(error_rate * length), length - 1))


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item cut into ``edits + 1`` pieces of nearly equal length, each with its offset."""
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def myers(pattern: str, text: str, anchored: bool = False, masks: dict[str, int] | None = None) -> tuple[int, int]:
    """Least edit distance of the pattern to a substring of the text (to a prefix, if anchored), and where it first ends."""
    masks = masks or _masks(pattern)
    m = len(pattern)
    full, high, first = (1 << m) - 1, 1 << (m - 1), int(anchored)
    up, down, score = full, 0, m
    best, at = m, 0
    for i, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        vertical = eq | down
        horizontal = (((eq & up) + up) ^ up) | eq
        plus = down | (full & ~(horizontal | up))
        minus = up & horizontal
        if plus & high:
            score += 1
        elif minus & high:
            score -= 1
        plus = (plus << 1 | first) & full
        minus = minus << 1 & full
        up = minus | (full & ~(vertical | plus))
        down = plus & vertical
        if score < best:
            best, at = score, i
    return best, at


def may_hold(stretch: str, blocks: list[str], edits: int) -> bool:
    """Whether at most ``edits`` of the blocks are missing in the stretch."""
    for block in blocks:
        if block not in stretch:
            edits -= 1
            if edits < 0:
                return False
    return True


class Matcher:
    """Search of a block of items; built once per task."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float):
        self.items = []
        owners: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            item = normal(text)
            if item:
                edits = budget(len(item), error_rate)
                blocks = [item[i : i + PROBE] for i in range(0, len(item) - PROBE + 1, PROBE)]
                self.items.append((item_id, item, edits, _masks(item), item[::-1], blocks))
                for offset, piece in pieces(item, edits):
                    owners.setdefault(piece, []).append((len(self.items) - 1, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        if owners:
            self.automaton.make_automaton()

    def hits(self, text: str | None) -> list[tuple[int | None, int, int, int, int]]:
        """(item_id, distance, start, end, budget) of each item within its budget: the least distance, first place."""
        if not text or not self.items:
            return []
        text = normal(text)
        stretches: dict[int, list[list[int]]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for n, offset in where:
                _, item, edits, _, _, _ = self.items[n]
                a = max(0, end + 1 - length - offset - edits)
                b = min(len(text), end + 1 - length - offset + len(item) + edits)
                mine = stretches.setdefault(n, [])
                if mine and a <= mine[-1][1]:
                    mine[-1][1] = max(b, mine[-1][1])
                    mine[-1][0] = min(a, mine[-1][0])
                else:
                    mine.append([a, b])
        found = []
        for n, mine in stretches.items():
            item_id, item, edits, masks, backwards, blocks = self.items[n]
            best = None
            for a, b in mine:
                if not may_hold(text[a:b], blocks, edits):
                    continue
                distance, end = myers(item, text[a:b], masks=masks)
                if distance <= edits and (best is None or distance < best[0]):
                    best = (distance, a, a + end)
            if best:
                distance, a, end = best
                _, length = myers(backwards, text[a:end][::-1], anchored=True)
                found.append((item_id, distance, end - length, end, edits))
        return sorted(found, key=lambda hit: (hit[0] is None, hit[0] or 0, *hit[1:]))


def item_blocks(items: DataFrame) -> Iterator[list[tuple[int | None, str]]]:
    """The test items, in blocks of bounded size by a hash of their id and text, one collected at a time.

    Rows without text are left out, those that only lack an id are not.
    """
    items = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    count = 1 + size // BLOCK_BYTES
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for n in range(count):
        yield [(r[0], r[1]) for r in items.where(block == n).orderBy("item_id", "text").collect()]


def hits_column(text: Column, block: list[tuple[int | None, str]], error_rate: float) -> Column:
    """Hits of one block of items in each text, as an array column; none for null and empty texts."""

    @F.pandas_udf(_HIT)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(block, error_rate)
        for texts in batches:
            yield pd.Series([matcher.hits(t) for t in texts])

    return search(text)


def leaks(docs: DataFrame, items: DataFrame, error_rate: float = 0.1) -> DataFrame:
    """One row per document row and test item found in it: doc_id, item_id, distance, budget, start, end.

    ``start`` and ``end`` count characters of the normalised text. ``docs`` has doc_id and text, ``items`` item_id and text;
    other columns are not read. Null and empty texts hold nothing, empty items are in nothing. Rows with a null doc_id
    are reported with it, and so are items with a null item_id; repeated rows are reported each. Of several places the one of least distance counts, the
    first of equals; of several texts under one item_id the least distance. Empty tables give an empty result.
    """
    found = None
    for block in item_blocks(items):
        hits = docs.select("doc_id", F.explode(hits_column(F.col("text"), block, error_rate)).alias("hit"))
        part = settle(hits.select("doc_id", "hit.item_id", "hit.distance", "hit.budget", "hit.start", "hit.end"), "leaks")
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, items: DataFrame, error_rate: float = 0.1) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text holds no test item."""
    for n, block in enumerate(item_blocks(items)):
        docs = settle(docs, "clean") if n else docs  # the block before is done with
        docs = docs.where(F.size(hits_column(F.col("text"), block, error_rate)) == 0)
    return docs
