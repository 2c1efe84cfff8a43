"""The three text representations side by side: counts, TF-IDF and BM25 fitted on one corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexispark.config import VectorConfig
from lexispark.operators.ranking import BM25, fit_bm25
from lexispark.operators.scale import first_rows
from lexispark.operators.vectors import BOW, TFIDF, BagModel, sparsity, stored_values
from lexispark.operators.vocabulary import fit_vocabulary

# Storage kind and value range of each method.
METHOD_TRAITS = (
    ("BOW", "sparse", "[0, inf)", False),
    ("TF-IDF", "sparse", "[0, 1]", False),
    ("BM25", "dense", "[0, inf)", True),
)


@dataclass(frozen=True)
class FittedMethods:
    bow: BagModel
    tfidf: BagModel
    bm25: BM25

    def vocabulary_sizes(self) -> DataFrame:
        """Counts and TF-IDF share the pruned vocabulary; BM25 keeps every term."""
        pruned = self.bow.vocabulary.table.agg(F.count("*").alias("n_terms"))
        whole = self.bm25.terms.agg(F.count("*").alias("n_terms"))
        return (
            pruned.select(F.lit("BOW").alias("method"), "n_terms")
            .unionByName(pruned.select(F.lit("TF-IDF").alias("method"), "n_terms"))
            .unionByName(whole.select(F.lit("BM25").alias("method"), "n_terms"))
        )

    def compare_document(self, docs: DataFrame, document: int, n: int = 5, doc_id: str = "doc_id") -> DataFrame:
        """Non-zero features and the ``n`` heaviest terms of one document: ``(method, n_nonzero, rank, term, weight)``.

        For BM25 the document is its own query and its terms are ranked by their part of the score.
        """
        one = docs.where(F.col(doc_id) == document)
        weights = []
        for method, model in (("BOW", self.bow), ("TF-IDF", self.tfidf)):
            cells = model.transform(one).select(F.explode(stored_values("features")).alias("c")).select("c.idx", "c.value")
            named = cells.join(model.vocabulary.feature_names(), "idx")
            weights.append(named.select(F.lit(method).alias("method"), "term", F.col("value").alias("weight")))
        query = one.select(F.lit(0).alias("query_id"), F.col(self.bm25.text).alias("query"))
        parts = self.bm25.contributions(one, self.bm25.weighted_queries(query), doc_id).where(F.col("score") != 0)
        weights.append(parts.select(F.lit("BM25").alias("method"), "term", F.col("score").alias("weight")))
        together = weights[0].unionByName(weights[1]).unionByName(weights[2])
        counts = together.groupBy("method").agg(F.count("*").alias("n_nonzero"))
        best = first_rows(together, [F.round("weight", 9).desc(), F.col("term")], n, "rank", ["method"])
        return best.join(counts, "method").select("method", "n_nonzero", "rank", "term", "weight")

    def method_comparison(self, docs: DataFrame, queries: DataFrame) -> DataFrame:
        """Vocabulary, sparsity and traits per method. BM25's sparsity is that of its query x document scores."""
        zero_shares = [
            sparsity(model.transform(docs), model.vocabulary.size).select(F.lit(method).alias("method"), "sparsity")
            for method, model in (("BOW", self.bow), ("TF-IDF", self.tfidf))
        ]
        scores = self.bm25.summary(docs, queries).select(F.lit("BM25").alias("method"), "sparsity")
        shares = zero_shares[0].unionByName(zero_shares[1]).unionByName(scores)
        traits = docs.sparkSession.createDataFrame(
            list(METHOD_TRAITS), "method string, vector_type string, output_range string, handles_length boolean"
        )
        return self.vocabulary_sizes().join(shares, "method").join(traits, "method")


def fit_methods(docs: DataFrame, text: str, config: VectorConfig) -> FittedMethods:
    """Fit all three on one corpus; counts and TF-IDF share one counted vocabulary."""
    vocabulary = fit_vocabulary(docs, text, config)
    return FittedMethods(
        BagModel(vocabulary, BOW, text), BagModel(vocabulary, TFIDF, text), fit_bm25(docs, text)
    )
