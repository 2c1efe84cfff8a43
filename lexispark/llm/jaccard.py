"""Links between documents whose word shingles have a high Jaccard similarity: adaptive multi-match prefix join.

Shingles are ordered by their estimated number of documents, rare ones first. A document of n shingles whose links need o
common ones has a prefix of n - o + m shingles; two linked documents share at least as many prefix shingles as the smaller
of their two m. Each document picks its m by the estimated cost of its candidates (see ``_prefix``), from n - o on: then a
document without so many prefix shingles in the prefixes of others (as many as the smallest partner may ask for) is done.

1. Documents with equal shingle sets form one class (map-side minima); only a class's smallest document goes on.
2. A count-min sketch of fixed size over all shingles gives the order and the costs. It may be as coarse as it likes: any
   order that all documents share is right, and shingles that occur far more often than others stand out at every size.
3. Only prefixes leave the scan. A sketch over them removes shingles that no other prefix holds, as far as its size
   allows. Of the K that are left of a prefix, links share at least some number ``least``, so the first K - least + q are
   enough for q matches, with a larger q where m was lengthened. From then on a list is kept only while it holds
   documents of two components. The whole sets are built for documents that still have a list.
4. Pivot rounds: the members of a shingle's list meet one pivot, a document with few prefix shingles of its own, not each
   other, and each component verifies its pair with most common shingles on the whole sets, if these are as many as the
   pair needs. This joins most copies without looking at all their pairs. A round that joins few of the components it
   compared is the last one.
5. Then every pair from different components that shares q entries is verified: in each list the members outside its
   largest component meet all others, and a pair counts only if the two sets may differ by few enough shingles: every
   shingle flips a bit of its set's sketch, common ones cancel out, so sets differ by at least as many shingles as their
   sketches differ in bits. Pairs inside a component can't change the result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexispark.llm.graph import components
from lexispark.llm.sketch import bits_for, counted, estimated, merged, reached
from lexispark.llm.words import LANES, Words, grams, mix, signed, slices
from lexispark.operators.scale import fits_broadcast, settle

FEW_MATCHES, MOST_MATCHES = 4, 8  # q
PIVOT_ROUNDS = 4  # at most
WORTH_A_ROUND = 8  # go on if at least one of so many compared pairs was linked
PARITY_BITS = 10  # a set's odd sketch has two to this power bits, kept as 64-bit columns
PARITY = [f"bits{i}" for i in range(1 << PARITY_BITS >> 6)]
ORDER_BITS = 21  # cells of the sketch that orders the shingles, per row
CELLS_PER_TOKEN, LEAST_BITS, MOST_BITS = 8, 16, 27


def _sets(words: Words, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row of the batch and its sorted distinct shingle hashes, for each row with words."""
    shingle = mix(grams(words.lanes[0], k, LANES[0]))
    bounds = words.bounds()
    for i in range(words.rows):
        a, b = int(bounds[i]), int(bounds[i + 1])
        if b - a >= k:
            found = np.sort(shingle[a : b - k + 1])
            fresh = np.ones(len(found), bool)
            fresh[1:] = found[1:] != found[:-1]
            yield words.first + i, found[fresh]
        elif b > a:
            yield words.first + i, mix(grams(words.lanes[0][a:b], b - a, LANES[0]) + np.uint64(b - a))


def _least(size: int, percent: int) -> int:
    """The fewest matches that a document of this size asks for; no smaller one asks for more."""
    common = -(-percent * size // 100)
    return max(1, min(common, size - common))


def _prefix(order: np.ndarray, est: np.ndarray, size: int, percent: int) -> tuple[int, int]:
    """Required matches m and prefix length of least estimated cost.

    Cost of m: the list entries that the prefix meets, and a verification for each document that can share m of them (at
    most the entries divided by m), each as costly as reading a 16th of the set.
    """
    common, lowest = -(-percent * size // 100), _least(size, percent)
    base = size - common
    most = min(lowest + MOST_MATCHES - FEW_MATCHES, common)
    sums = np.cumsum(est[order[: base + most]])
    best, least = lowest, None
    for m in range(lowest, most + 1):
        entries = sums[base + m - 1]
        others = entries - (base + m)
        cost = entries + others / m * (1 + size / 16)
        if least is None or cost < least:
            best, least = m, cost
    return best, base + best


def _fingerprint(found: np.ndarray) -> np.ndarray:
    """Of a set's hashes, whatever their order."""
    return mix(found * np.uint64(LANES[1])).sum(dtype=np.uint64)


def _parity(found: np.ndarray) -> np.ndarray:
    """Bits of a set's hashes as 64-bit numbers, each set where an odd number of hashes falls."""
    bits = np.bincount((found >> np.uint64(64 - PARITY_BITS)).astype(np.int64), minlength=1 << PARITY_BITS) & 1
    return np.packbits(bits.astype(bool), bitorder="little").view(np.int64)


def shingle_classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A-Z count as a-z. The set of a text are its distinct
    ``k``-word shingles, the whole sequence if it is shorter; texts are linked if 100 * common >= percent * union, and
    component_id is the smallest doc_id reachable by links, the document's own without any. Null and empty texts have
    n_shingles 0 and no links. Rows with a null doc_id have no links and a null component. Rows that share a doc_id
    are one document, linked by any of its texts. An empty table gives an empty result.
    """
    if not 1 <= percent <= 100 or k < 1:
        raise ValueError("percent is 1 to 100, k at least 1")
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    spark = docs.sparkSession

    # classes of equal sets
    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.zeros(batch.num_rows, np.int64)
            f1, f2 = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.uint64)
            for words in slices(batch.column("text"), lower=True, lanes=1):
                for i, found in _sets(words, k):
                    size[i] = len(found)
                    f1[i] = _fingerprint(found)
                    f2[i] = mix(found ^ np.uint64(LANES[0])).sum(dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(size), signed(f1), signed(f2)], ["doc_id", "n", "f1", "f2"])

    members = settle(docs.mapInArrow(summaries, "doc_id bigint, n bigint, f1 bigint, f2 bigint"), "members")
    linkable = members.where("doc_id is not null and n > 0")
    classes = settle(linkable.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("rep")), "class-heads")
    mapped = settle(linkable.join(classes, ["f1", "f2", "n"]).select("doc_id", "rep").distinct(), "classes")
    repeated = settle(members.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    each_once = repeated.isEmpty()

    # about how many texts a shingle occurs in
    total = members.agg(F.coalesce(F.sum(F.floor(F.col("n") * (100 - percent) / 50) + 1), F.lit(0))).first()[0]

    def all_tokens(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for words in slices(batch.column("text"), lower=True, lanes=1):
            for _, found in _sets(words, k):
                yield found

    table = counted(docs, all_tokens, ORDER_BITS)
    noise = float(table[0].sum(dtype=np.float64)) / (1 << ORDER_BITS)
    counts = spark.sparkContext.broadcast(table)
    del table

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for words in slices(batch.column("text"), lower=True, lanes=1):
                out: list[tuple] = []
                for i, found in _sets(words, k):
                    size = len(found)
                    est = estimated(counts.value, found, ORDER_BITS, noise)
                    order = np.lexsort((found, np.floor(np.log2(est) * 2)))
                    m, length = _prefix(order, est, size, percent)
                    out.append((i, _fingerprint(found), size, m, found[order[:length]].tobytes()))
                if out:
                    at, text, size, m, head = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(at)), signed(np.array(text, np.uint64)), pa.array(size, pa.int64()), pa.array(m, pa.int32()), pa.array(head, pa.binary())],
                        ["rep", "text_no", "size", "m", "head"],
                    )

    found = docs.where("doc_id is not null").mapInArrow(prefixes, "rep bigint, text_no bigint, size bigint, m int, head binary")
    firsts = classes.select("rep", F.col("f1").alias("text_no"))
    heads = found.join(F.broadcast(firsts) if fits_broadcast(classes) else firsts, ["rep", "text_no"], "left_semi")
    heads = settle(heads if each_once else heads.dropDuplicates(["rep", "text_no"]), "heads")
    counts.destroy()

    # shingles of at least two prefixes
    head_bits = bits_for(float(total), CELLS_PER_TOKEN, LEAST_BITS, MOST_BITS)
    shared = spark.sparkContext.broadcast(
        merged(heads.select("head"), lambda batch: (np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("head")), head_bits, at_least=2)
    )

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = [x.as_py() for x in batch.column("head")]
            length = np.array([len(x) // 8 for x in body])
            token = np.frombuffer(b"".join(body), np.uint64)
            at = np.repeat(np.arange(batch.num_rows), length)
            keep = reached(shared.value, token, head_bits)
            at, token = at[keep], token[keep]
            known = np.bincount(at, minlength=batch.num_rows)
            own = 16 - 16 * known // np.maximum(length, 1)  # sixteenths of the prefix
            sizes = batch.column("size").to_pylist()
            # what the smallest possible partner asks for, and the partner of that one
            partner = [-(-percent * n // 100) for n in sizes]
            least = np.array([_least(n, percent) for n in partner], np.int64)
            fewest = np.minimum(FEW_MATCHES, [_least(-(-percent * n // 100), percent) for n in partner])
            longer = batch.column("m").to_numpy() - np.array([_least(n, percent) for n in sizes], np.int64)
            q = np.minimum(least, FEW_MATCHES + longer)
            place = np.arange(len(at)) - (np.cumsum(known) - known)[at]
            enough = ((known >= least) & (known > 0))[at] & (place < (known - least + q)[at])
            at, token = pa.array(at[enough]), token[enough]
            yield pa.RecordBatch.from_arrays(
                [signed(token), *(batch.column(c).take(at) for c in ("rep", "text_no", "size")), *(pa.array(x, pa.int32()).take(at) for x in (q, own, fewest))],
                ["token", "rep", "text_no", "size", "m", "own", "least"],
            )

    lists = settle(heads.mapInArrow(postings, "token bigint, rep bigint, text_no bigint, size bigint, m int, own int, least int"), "lists")
    shared.destroy()

    def narrowed(lists: DataFrame, placed: DataFrame, round_: int) -> DataFrame:
        """Entries of lists with two components, with their own component and the list's pivot. Hot lists are joined, not gathered."""
        now = _placed(lists, placed)
        first = F.struct("own", F.xxhash64("rep", F.lit(round_)).alias("h"), "rep", "size", "m", "comp")
        pivots = now.groupBy("token").agg(F.min(first).alias("p"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
        pivots = settle(pivots.select("token", F.col("p.rep").alias("p_rep"), F.col("p.size").alias("p_size"), F.col("p.m").alias("p_m"), F.col("p.comp").alias("p_comp")), "pivots")
        now = settle(now.join(F.broadcast(pivots) if fits_broadcast(pivots) else pivots, "token"), "open-lists")
        if round_:
            return now
        # an entry for each match that a link of another component could have; most that lack them lack them from the start
        few = now.groupBy("rep", "text_no").agg(F.count("*").alias("n"), F.first("least").alias("least")).where("n < least")
        few = settle(few.select("rep", "text_no"), "few")
        return now.join(F.broadcast(few) if fits_broadcast(few) else few, ["rep", "text_no"], "left_anti")

    # documents of several texts are linked through their doc_id; classes by their smallest document
    links = mapped.where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    placed = components(links.join(repeated.withColumnRenamed("doc_id", "b"), "b", "left_semi").select("a", "b"))
    now = narrowed(lists, placed, 0)

    # whole sets of the documents that share a prefix shingle with another component
    listed = settle(now.select(F.col("rep").alias("doc_id")).distinct(), "listed")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in slices(batch.column("text"), lower=True, lanes=1):
                out = [(i, _fingerprint(found), found) for i, found in _sets(words, k)]
                if out:
                    at, text, tokens = zip(*out)
                    sketches = np.array([_parity(x) for x in tokens])
                    offsets = pa.array(np.cumsum([0, *map(len, tokens)]), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array(at)), signed(np.array(text, np.uint64)),
                            pa.ListArray.from_arrays(offsets, signed(np.concatenate(tokens))), *(pa.array(np.ascontiguousarray(x)) for x in sketches.T),
                        ],
                        ["doc_id", "text_no", "tokens", *PARITY],
                    )

    some = docs.join(F.broadcast(listed) if fits_broadcast(listed) else listed, "doc_id", "left_semi").select("doc_id", "text")
    sets = some.mapInArrow(whole, "doc_id bigint, text_no bigint, tokens array<bigint>" + "".join(f", {b} bigint" for b in PARITY))
    sets = settle(sets if each_once else sets.dropDuplicates(["doc_id", "text_no"]), "sets")

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs ``(a, b)`` of a settled table whose whole sets are similar enough. Only sets of the pairs are moved."""
        small = fits_broadcast(pairs)

        def side(node: str, name: str) -> DataFrame:
            return sets.select(F.col("doc_id").alias(node), F.col("tokens").alias(name)).join(F.broadcast(pairs) if small else pairs, node)

        common = F.size(F.array_intersect("left", "right"))
        union = F.size("left") + F.size("right") - common
        both = side("a", "left").join(side("b", "right"), ["a", "b"])
        return both.where(100 * common >= percent * union).select("a", "b").distinct()

    def reachable(common: Column, one: Column, other: Column) -> Column:
        """Whether sets of these sizes with at most so many common shingles can be linked."""
        return 100 * common >= percent * (one + other - common)

    for round_ in range(PIVOT_ROUNDS):
        sizes = F.col("size"), F.col("p_size")
        pairs = now.where("comp <> p_comp").where(reachable(F.least(*sizes), *sizes))
        pairs = pairs.select("comp", F.least("rep", "p_rep").alias("a"), F.greatest("rep", "p_rep").alias("b"), F.least("m", "p_m").alias("m"))
        pairs = pairs.groupBy("a", "b", "comp").agg(F.count("*").alias("shared"), F.min("m").alias("m")).where("shared >= m")
        # one pair for each component: the one with most common shingles
        best = pairs.groupBy("comp").agg(F.max(F.struct("shared", "a", "b")).alias("p"))
        best = settle(best.select("p.a", "p.b").distinct(), "pairs")
        alike = settle(verified(best), "alike")
        tried, linked = best.count(), alike.count()
        if linked:
            placed = _joined(placed, alike)
            # lists of one component have nothing left to compare
            now = narrowed(now.select(*lists.columns), placed, round_ + 1)
        if linked * WORTH_A_ROUND < tried or not linked:
            break
    largest = now.groupBy("token", "comp").count().groupBy("token").agg(F.max(F.struct("count", "comp")).alias("top"))
    tagged = now.join(largest.select("token", F.col("top.comp").alias("top")), "token").withColumn("minor", F.expr("comp <> top"))
    of_text = sets.select(F.col("doc_id").alias("rep"), "text_no", *PARITY)
    tagged = tagged.select("token", "rep", "text_no", "size", "m", "comp", "minor").join(of_text, ["rep", "text_no"])
    one, other = tagged.where("minor").alias("x"), tagged.alias("y")
    differ = F.expr("x.token = y.token AND x.comp <> y.comp AND (NOT y.minor OR x.rep < y.rep)")

    # linked sets differ by at most (100 - percent) / (100 + percent) of their sizes, and have sizes that allow it
    differing = reduce(add, [F.bit_count(F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}"))) for b in PARITY])
    sizes = F.col("x.size"), F.col("y.size")
    matched = reachable(F.least(*sizes), *sizes) & ((100 + percent) * differing <= (100 - percent) * reduce(add, sizes))
    # few rows can meet in many pairs, so a small table must not go to a single task as a broadcast join would send it
    met = one.join(other.hint("merge"), differ & matched)
    pairs = met.select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"), F.least("x.m", "y.m").alias("m"))
    pairs = pairs.groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("m").alias("m")).where("shared >= m").select("a", "b")
    placed = _joined(placed, verified(settle(pairs, "pairs")))

    of_class = placed.select(F.col("node").alias("rep"), "component")
    result = members.join(mapped.groupBy("doc_id").agg(F.min("rep").alias("rep")), "doc_id", "left").join(of_class, "rep", "left")
    return result.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def _joined(placed: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links."""
    return components(placed.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(links))


def _placed(lists: DataFrame, placed: DataFrame) -> DataFrame:
    """List entries with the component of their document so far."""
    return lists.join(placed.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component")
