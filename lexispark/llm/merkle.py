"""Merkle manifest of a dataset, with checkpoint-and-recompute proofs.

The leaves of a tree are in order; runs of ``ARITY`` consecutive nodes become the hash of their digests, level by level,
until one is left. Only every ``LEVELS``-th level is written. The nodes between two written levels belong to aligned
subtrees of at most ``ARITY ** LEVELS`` nodes, each with one parent on the next written level; a task takes a subtree's
stored descendants, regenerates the nodes between, hands out what it needs of them and forgets them.

Trees of all groups are built together: the n-th level of a small tree is written next to the n-th level of a large one,
and a tree that has ended keeps its one node. The roots of the groups, in order, are the leaves of one more tree.

A proof is the path from a leaf to the root: for each level the digests of the node's run, with ``*`` in its own place,
levels ended by ``/``. Hashing a run with the node's digest in that place gives the node above.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.operators.scale import lookup_join, number_rows, settle

ARITY = 3
LEVELS = 6
_NODES = "grp string, n bigint, node bigint, digest string"


def digest_of(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts' text, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def framed(column: Column) -> Column:
    """A value that can't be mistaken: ``-`` if null, else its UTF-8 length, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*columns: Column) -> Column:
    return digest_of(*[framed(c) for c in columns])


def _hash(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def levels_of(n: int, arity: int) -> int:
    """Levels above ``n`` leaves: the root's distance from them."""
    levels, reach = 0, 1
    while reach < n:
        levels, reach = levels + 1, reach * arity
    return levels


def regenerated(digests: list[str], levels: int, arity: int) -> list[list[str]]:
    """The levels of an aligned subtree, from its stored descendants to ``levels`` above them."""
    found = [digests]
    for _ in range(levels):
        below = found[-1]
        found.append([_hash(below[i : i + arity]) for i in range(0, len(below), arity)])
    return found


def path_of(place: int, found: list[list[str]], arity: int) -> str:
    """Path of a stored descendant to the top of its regenerated subtree."""
    steps = []
    for nodes in found[:-1]:
        first = place - place % arity
        steps.append("".join(nodes[first:place] + ["*"] + nodes[place + 1 : first + arity]) + "/")
        place //= arity
    return "".join(steps)


@dataclass(frozen=True)
class Manifest:
    """The stored levels of all trees: ``stored[i]`` has the nodes i * levels above the leaves as (grp, n, node, digest).

    ``n`` is the number of leaves of the group's tree. ``stored[0]`` also has the leaves' other columns.
    """

    stored: tuple[DataFrame, ...]
    arity: int
    levels: int

    def roots(self) -> DataFrame:
        """``(grp, n, digest)``: one root for each group."""
        return self.stored[-1].select("grp", "n", "digest")

    def paths(self, leaves: DataFrame | None = None, above: DataFrame | None = None) -> DataFrame:
        """The leaf rows (``stored[0]``, or those given, with more columns) and their ``path``.

        ``above(grp, node, path)`` has paths to append to those of the groups' roots, whose node is 0. From the top, each
        level regenerates the subtrees over its nodes and appends the path of the subtree's root.
        """
        leaves = self.stored[0] if leaves is None else leaves
        if above is None:
            above = self.roots().select("grp", F.lit(0).cast("bigint").alias("node"), F.lit("").alias("path"))
        for stage in range(len(self.stored) - 2, 0, -1):
            above = settle(self._extended(self.stored[stage], stage, above).select("grp", "node", "path"), "merkle-paths")
        return self._extended(leaves, 0, above)

    def _extended(self, nodes: DataFrame, stage: int, above: DataFrame) -> DataFrame:
        """``nodes`` of a stored level with ``path``; ``above`` has the paths of the next stored level's nodes."""
        arity, levels = self.arity, self.levels

        def extend(rows: pa.Table, upper: pa.Table) -> pa.Table:
            if not rows.num_rows:
                return rows.append_column("path", pa.array([], pa.string()))
            rows = rows.sort_by("node")
            to_go = min(levels, max(0, levels_of(rows["n"][0].as_py(), arity) - stage * levels))
            found = regenerated(rows["digest"].to_pylist(), to_go, arity)
            rest = upper["path"][0].as_py()
            return rows.append_column("path", pa.array([path_of(p, found, arity) + rest for p in range(rows.num_rows)], pa.string()))

        # the subtree's root has the number node / width on the next stored level
        subtree = F.expr(f"node div {arity**levels}").alias("subtree")
        left = nodes.select("*", subtree).groupBy("grp", "subtree")
        right = above.select("grp", F.col("node").alias("subtree"), "path").groupBy("grp", "subtree")
        columns = T.StructType([*nodes.schema, T.StructField("subtree", T.LongType()), T.StructField("path", T.StringType())])
        return left.cogroup(right).applyInArrow(extend, columns).drop("subtree")


def _raising(done: int, levels: int, arity: int):
    """From the nodes of a subtree, ``done`` levels above the leaves, its root on the next stored level."""

    def raised(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        n = int(rows["n"].iloc[0])
        to_go = min(levels, max(0, levels_of(n, arity) - done))
        top = regenerated(rows["digest"].tolist(), to_go, arity)[-1]
        return pd.DataFrame({"grp": [key[0]], "n": [n], "node": [key[1]], "digest": [top[0]]})

    return raised


def build(leaves: DataFrame, most: int, arity: int = ARITY, levels: int = LEVELS) -> Manifest:
    """Store every ``levels``-th level above ``leaves(grp, n, node, digest, …)``; no group has more than ``most`` leaves.

    ``node`` numbers the leaves of a group from 0, ``n`` is how many it has. ``grp`` is not null.
    """
    width = arity**levels
    stored, stage = [leaves], 0
    while most > 1:

        nodes = stored[-1].select("grp", "n", F.expr(f"node div {width}").alias("subtree"), "node", "digest")
        raised = _raising(stage * levels, levels, arity)
        stored.append(settle(nodes.groupBy("grp", "subtree").applyInPandas(raised, _NODES), "merkle-level"))
        stage, most = stage + 1, -(-most // width)
    return Manifest(tuple(stored), arity, levels)


@dataclass(frozen=True)
class DatasetManifest:
    """The trees of the sources and the tree above them. ``sources.stored[0]`` holds the rows with their leaf digests."""

    sources: Manifest
    top: Manifest
    root: str | None

    def proofs(self) -> DataFrame:
        """The leaf rows with ``subroot``, ``root`` and ``path``, the leaf's path to the root through its subroot."""
        tops = self.top.paths().select(F.col("of").alias("grp"), F.lit(0).cast("bigint").alias("node"), "path")
        subroots = settle(self.sources.roots().select("grp", F.col("digest").alias("subroot")), "merkle-subroots")
        leaves = lookup_join(self.sources.stored[0], subroots, "grp", ["digest"])
        return self.sources.paths(leaves, settle(tops, "merkle-top-paths")).withColumn("root", F.lit(self.root))


def manifest(docs: DataFrame, source: str, order: str, leaf: Column, *keep: Column, arity: int = ARITY, levels: int = LEVELS) -> DatasetManifest:
    """Trees over the rows of ``docs``: one for each source, its leaves by rising ``order``, and one over the sources.

    ``leaf`` is the digest of a row, ``keep`` are columns to carry along. Only the columns named are read. Null order values
    come first, equal ones by their digest; rows with equal digests are interchangeable. A null source is a source, the
    first; the others follow by their bytes. A single leaf is its tree's root. An empty table has root None.
    """
    if arity < 2 or levels < 1:
        raise ValueError("arity is at least 2, levels at least 1")
    key = F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")).alias("grp")
    rows = docs.select(key, F.col(order).alias("_by"), leaf.alias("digest"), *keep)
    rows = settle(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-leaves")
    counts = settle(rows.groupBy("grp").agg(F.count("*").alias("n")), "merkle-counts")
    numbered = number_rows(rows, [F.col("_by").asc_nulls_first(), F.col("digest"), F.col("_row")], "node", ["grp"])
    placed = lookup_join(numbered.withColumn("node", F.col("node") - 1), counts, "grp", ["_row"]).drop("_by", "_row")
    most = counts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    sources = build(settle(placed, "merkle-leaves"), most, arity, levels)

    n_sources = counts.count()
    tops = number_rows(sources.roots().select(F.col("grp").alias("of"), "digest"), [F.col("of")], "node")
    tops = tops.select(F.lit("").alias("grp"), F.lit(n_sources).cast("bigint").alias("n"), (F.col("node") - 1).alias("node"), "digest", "of")
    top = build(settle(tops, "merkle-subroots"), n_sources, arity, levels)
    root = top.roots().first()  # one row
    return DatasetManifest(sources, top, root["digest"] if root else None)


def proof_digest(path: Column) -> Column:
    """Hash of a path's siblings, from the leaf up, each run from left to right."""
    return F.sha2(F.translate(path, "*/", ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and a path lead to."""
    steps = F.filter(F.split(path, "/"), lambda step: step != "")
    return F.aggregate(steps, leaf, lambda digest, step: F.sha2(F.replace(step, F.lit("*"), digest), 256))


def tampered(doc_id: Column, text: Column) -> Column:
    """The text without line feeds where 2 divides the checksum of the row's id; a null id has no checksum."""
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def audit(docs: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of documents.

    A leaf is the digest of doc_id, source, lang, n_chars and text. The folded root is that of the leaf of the tampered
    row (see ``tampered``) and the proof of the original one, so ``verified`` is false where tampering changed the text.
    Nulls are values of their own, rows without an id are not tampered with; an empty table gives an empty result.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    after = leaf_digest(*fields, tampered(F.col("doc_id"), F.col("text")))
    made = manifest(docs, "source", "doc_id", leaf_digest(*fields, F.col("text")), F.col("doc_id"), after.alias("after"), arity=arity, levels=levels)
    proved = made.proofs().withColumn("folded_root", folded(F.col("after"), F.col("path")))
    return proved.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
