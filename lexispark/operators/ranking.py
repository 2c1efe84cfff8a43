"""BM25 ranking and cosine similarity over term postings."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.functions.tokens import term_bag, tokenize_whitespace
from lexispark.operators.blockmax import SCORE_DIGITS, Asked, Gain, index_reader, index_table, query_sets, searched, texts_reader, totals
from lexispark.operators.scale import TASK_LOCAL_TOP_K, first_rows, fits_broadcast, lookup_join, number_rows, settle
from lexispark.operators.vectors import BagModel, stored_values
from lexispark.operators.vocabulary import counted_terms

INDEX_GROUP_BYTES = 4 << 20


def _tokens(column: str):
    return tokenize_whitespace(F.coalesce(F.col(column), F.lit("")))


@dataclass(frozen=True)
class BM25:
    """Corpus statistics: the settled table ``(term, df, idf)``, corpus size and mean document length."""

    terms: DataFrame
    n_docs: int
    mean_length: float
    k1: float
    b: float
    text: str = "processed"

    def vocabulary(self) -> DataFrame:
        return self.terms.select("term").orderBy("term")

    def weighted_queries(self, queries: DataFrame, text: str = "query") -> DataFrame:
        """``(query_id, term, weight)``: idf times the term's occurrences in the query; unknown terms drop out."""
        bags = queries.select("query_id", F.explode(term_bag(_tokens(text))).alias("t"))
        asked = settle(bags.select("query_id", "t.term", "t.tf"), "asked-terms")
        if fits_broadcast(asked):
            known = self.terms.join(F.broadcast(asked), "term")
        else:
            known = lookup_join(asked, self.terms, "term", ["query_id"])
        return settle(known.select("query_id", "term", (F.col("tf") * F.col("idf")).alias("weight")), "query-terms")

    def contributions(self, docs: DataFrame, query_terms: DataFrame, doc_id: str = "doc_id") -> DataFrame:
        """``(query_id, doc_id, term, score)`` for every query term that a document holds."""
        tokens = docs.select(doc_id, _tokens(self.text).alias("_tokens"))
        held = tokens.select(doc_id, F.size("_tokens").alias("dl"), F.explode(term_bag(F.col("_tokens"))).alias("t"))
        held = held.select(doc_id, "dl", "t.term", "t.tf")
        matched = lookup_join(held, query_terms, "term", [doc_id])
        length = 1 - self.b + self.b * F.col("dl") / F.lit(self.mean_length)
        gain = F.col("tf") * (self.k1 + 1) / (F.col("tf") + self.k1 * length)
        return matched.select("query_id", doc_id, "term", (F.col("weight") * gain).alias("score"))

    @property
    def gain(self) -> Gain:
        return Gain(self.k1, self.b, self.mean_length)

    def _asked(self, queries: DataFrame, text: str) -> list[Asked]:
        asked = settle(queries.select("query_id", text), "queries")
        return query_sets(asked, self.weighted_queries(asked, text))

    def _texts(self, docs: DataFrame, doc_id: str) -> DataFrame:
        return docs.select(doc_id, _tokens(self.text).alias("_tokens"))

    def index(self, docs: DataFrame, doc_id: str = "doc_id") -> PostingIndex:
        """The written inverted index of a corpus, for many query sets. No text is shuffled to make it."""
        # a reader holds a row group of such wide rows at once, and a writer looks at its size after so many rows
        small = {"parquet.block.size": str(INDEX_GROUP_BYTES), "parquet.page.size.row.check.min": "4"}
        table = settle(index_table(self._texts(docs, doc_id), self.gain), "postings", **small)
        return PostingIndex(self, table, doc_id)

    def scores(self, docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", text: str = "query") -> DataFrame:
        """Scores of all matching (query, document) pairs; a pair that shares no term scores 0 and has no row."""
        return self._scores(self._texts(docs, doc_id), texts_reader(self.gain), queries, docs.schema[doc_id].dataType, doc_id, text)

    def _scores(self, source: DataFrame, read: Callable, queries: DataFrame, kind: T.DataType, doc_id: str, text: str) -> DataFrame:
        return searched(source, read, self._asked(queries, text), queries.schema["query_id"].dataType, kind, doc_id, None)

    def rank(
        self,
        docs: DataFrame,
        queries: DataFrame,
        top_k: int | None = None,
        doc_id: str = "doc_id",
        text: str = "query",
    ) -> DataFrame:
        """``(query_id, rank, doc_id, score)``, best first, ties by document id; ``None`` or 0 ranks all documents.

        Where fewer than ``top_k`` documents score above zero, documents with score 0 fill up in id order.
        """
        return self._rank(self._texts(docs, doc_id), texts_reader(self.gain), docs, queries, top_k, doc_id, text)

    def _rank(self, source: DataFrame, read: Callable, docs: DataFrame, queries: DataFrame, top_k: int | None, doc_id: str, text: str) -> DataFrame:
        columns = ["query_id", "rank", doc_id, "score"]
        order = [F.round("score", SCORE_DIGITS).desc(), F.col(doc_id)]
        kind = docs.schema[doc_id].dataType
        if not top_k or top_k > TASK_LOCAL_TOP_K:
            scored = settle(self._scores(source, read, queries, kind, doc_id, text), "scores")
            return self._rank_with_zeros(docs, queries, scored, top_k or self.n_docs, order, doc_id).select(*columns)
        best = searched(source, read, self._asked(queries, text), queries.schema["query_id"].dataType, kind, doc_id, top_k)
        return first_rows(best, order, top_k, "rank", ["query_id"]).select(*columns)

    def _rank_with_zeros(self, docs: DataFrame, queries: DataFrame, scored: DataFrame, wanted: int, order, doc_id: str) -> DataFrame:
        matched = scored.groupBy("query_id").agg(F.count("*").alias("matched"))
        counts = queries.select("query_id").distinct().join(matched, "query_id", "left").na.fill(0, ["matched"])
        every = scored.unionByName(self._unmatched(docs, scored, counts, wanted, doc_id))
        return first_rows(every, order, wanted, "rank", ["query_id"])

    def _unmatched(self, docs: DataFrame, scored: DataFrame, counts: DataFrame, wanted: int, doc_id: str) -> DataFrame:
        """Zero scores: per query of ``counts`` the first documents by id that share no term with it.

        Among the first ``wanted + matched`` documents at least ``wanted`` are unmatched, so no query meets more
        documents than it has results.
        """
        numbered = number_rows(docs.select(doc_id), [F.col(doc_id)], "_number")
        last = F.least(F.lit(self.n_docs).cast("bigint"), F.lit(wanted) + F.col("matched"))
        places = counts.select("query_id", F.explode(F.sequence(F.lit(1).cast("bigint"), last)).alias("_number"))
        return (
            places.join(numbered, "_number")
            .join(scored.select("query_id", doc_id), ["query_id", doc_id], "left_anti")
            .select("query_id", doc_id, F.lit(0.0).alias("score"))
        )

    def summary(self, docs: DataFrame, queries: DataFrame, doc_id: str = "doc_id", text: str = "query") -> DataFrame:
        """Mean and maximum over the whole query x corpus block, with the zero pairs counted; null without queries."""
        return self._summary(self._texts(docs, doc_id), texts_reader(self.gain), queries, text)

    def _summary(self, source: DataFrame, read: Callable, queries: DataFrame, text: str) -> DataFrame:
        pairs = F.lit(self.n_docs * queries.count()).cast("bigint")
        scored = totals(source, read, self._asked(queries, text)).agg(
            F.coalesce(F.sum("matched"), F.lit(0)).alias("matched"),
            F.coalesce(F.sum("nonzero"), F.lit(0)).alias("nonzero"),
            F.coalesce(F.sum("total"), F.lit(0.0)).alias("total"),
            F.max("best").alias("best"),
        )
        best = F.when(F.col("matched") < pairs, F.greatest("best", F.lit(0.0))).otherwise(F.col("best"))
        return scored.select(
            pairs.alias("n_pairs"),
            F.col("nonzero").alias("n_nonzero"),
            F.try_divide("total", pairs).alias("mean_score"),
            best.alias("max_score"),
            (1 - F.try_divide("nonzero", pairs)).alias("sparsity"),
        )

    def similar(self, docs: DataFrame, document: int, top_k: int, doc_id: str = "doc_id") -> DataFrame:
        """Documents most relevant to a whole document taken as the query; the document itself is included."""
        query = docs.where(F.col(doc_id) == document).select(
            F.col(doc_id).alias("query_id"), F.col(self.text).alias("query")
        )
        return self.rank(docs, query, top_k, doc_id)


@dataclass(frozen=True)
class PostingIndex:
    """A corpus as a written table of segments, searched without reading a text again."""

    model: BM25
    table: DataFrame
    doc_id: str = "doc_id"

    @property
    def _id_type(self) -> T.DataType:
        return self.table.schema["ids"].dataType.elementType

    def scores(self, queries: DataFrame, text: str = "query") -> DataFrame:
        return self.model._scores(self.table, index_reader, queries, self._id_type, self.doc_id, text)

    def rank(self, queries: DataFrame, top_k: int | None = None, text: str = "query") -> DataFrame:
        docs = self.table.select(F.explode("ids").alias(self.doc_id))
        return self.model._rank(self.table, index_reader, docs, queries, top_k, self.doc_id, text)

    def summary(self, queries: DataFrame, text: str = "query") -> DataFrame:
        return self.model._summary(self.table, index_reader, queries, text)


def fit_bm25(docs: DataFrame, text: str = "processed", k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25) -> BM25:
    """Document frequencies and idf of every whitespace token: ln(N - df + 0.5) - ln(df + 0.5).

    A negative idf (a term in more than half of the documents) is replaced by ``epsilon`` times the mean idf.
    """
    n_docs = docs.count()
    if n_docs == 0:
        raise ValueError("Cannot fit BM25 on an empty corpus")
    # one pass over the texts: document lengths add up to the corpus frequencies
    counts = settle(counted_terms(docs, _tokens(text)), "term-df")
    raw = F.log(n_docs - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    mean_idf, n_tokens = counts.agg(F.coalesce(F.avg(raw), F.lit(0.0)), F.coalesce(F.sum("cf"), F.lit(0))).first()
    idf = F.when(raw < 0, F.lit(epsilon * mean_idf)).otherwise(raw)
    terms = counts.select("term", "df", idf.alias("idf"))
    return BM25(terms, n_docs, n_tokens / n_docs, k1, b, text)


def cosine_topk(
    docs: DataFrame, model: BagModel, document: int, k: int, doc_id: str = "doc_id", candidates: DataFrame | None = None
) -> DataFrame:
    """``(rank, doc_id, similarity)``: the ``k`` candidates closest to a document, itself excluded by its id.

    Every candidate row keeps its place in the result, also without a shared term (similarity 0).
    """
    vectors = model.transform(docs)
    # one document's vector: no larger than its terms, whatever the size of the vocabulary
    found = vectors.where(F.col(doc_id) == document).select("features").first()
    query = found.features if found else Vectors.sparse(model.vocabulary.size, {})
    query_norm = float(sum(w * w for w in query.values)) ** 0.5
    others = (vectors if candidates is None else model.transform(candidates)).where(F.col(doc_id) != document)
    # the products are made inside the row: nothing is exploded or shuffled before the top k
    product = ElementwiseProduct(scalingVec=query, inputCol="features", outputCol="_products")
    rows = product.transform(others.select(doc_id, "features"))
    dot = F.aggregate(stored_values("_products"), F.lit(0.0), lambda total, c: total + c["value"])
    square = F.aggregate(stored_values("features"), F.lit(0.0), lambda total, c: total + c["value"] * c["value"])
    norm = F.sqrt(square) * query_norm
    similarity = F.when(norm > 0, dot / norm).otherwise(F.lit(0.0))
    compared = rows.select(doc_id, similarity.alias("similarity"))
    order = [F.round("similarity", SCORE_DIGITS).desc(), F.col(doc_id)]
    return first_rows(compared, order, k, "rank").select("rank", doc_id, "similarity")
