"""Bag-of-words and TF-IDF vectors.

With a vocabulary of checked size (the configured ``max_features``) a document becomes a SparseVector inside its own
row: Spark ML's count, scale and normalize transformers, no join and no shuffle. With a vocabulary beyond the broadcast
bounds the terms are joined to it with salted keys, and the cells of a document meet again by its row number and become
the same SparseVector, so that nothing that takes vectors depends on the size of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexispark.config import VectorConfig
from lexispark.functions.analyzer import analyze
from lexispark.functions.tokens import counted_bag
from lexispark.operators.scale import lookup_join, settle
from lexispark.operators.vocabulary import Vocabulary, fit_vocabulary

BOW, TFIDF = "bow", "tfidf"


def stored_values(vector: Column | str) -> Column:
    """The non-zero entries of a sparse vector column as array<struct<idx, value>>, without leaving the JVM."""
    raw = F.unwrap_udt(vector)
    return F.arrays_zip(raw["indices"].alias("idx"), raw["values"].alias("value"))


def nonzero_count(vector: Column | str) -> Column:
    return F.size(F.unwrap_udt(vector)["indices"])


@dataclass(frozen=True)
class BagModel:
    """Vectorizer fitted on a corpus; ``method`` is ``bow`` or ``tfidf``. There is no unfitted state."""

    vocabulary: Vocabulary
    method: str
    text: str = "processed"

    @cached_property
    def stages(self) -> PipelineModel:
        """Spark ML stages from ``_tokens`` to ``features``. Only built for a vocabulary of checked size."""
        if not self.vocabulary.small:
            raise ValueError("The vocabulary is too large for in-row stages; transform() joins it instead")
        terms = self.vocabulary.table.orderBy("idx").select("term", "idf").collect()
        counted = "features" if self.method == BOW else "_counts"
        count = CountVectorizerModel.from_vocabulary([t.term for t in terms], "_tokens", counted)
        if self.method == BOW:
            return PipelineModel([count])
        weight = ElementwiseProduct(
            scalingVec=Vectors.dense([t.idf for t in terms]), inputCol="_counts", outputCol="_weights"
        )
        return PipelineModel([count, weight, Normalizer(p=2.0, inputCol="_weights", outputCol="features")])

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the SparseVector column ``features``; a document without a known term gets a zero vector."""
        if not self.vocabulary.small:
            return self._assembled(df)
        tokens = df.withColumn("_tokens", analyze(F.col(self.text), self.vocabulary.config))
        return self.stages.transform(tokens).drop("_tokens", "_counts", "_weights")

    def _assembled(self, df: DataFrame) -> DataFrame:
        """``transform`` by a join. Rows and their cells are told apart by a written number, so keys may repeat.

        Only row numbers and cells cross the two exchanges, and the vectors are made by built-in functions: the stored
        form of a vector is written, and read back as vectors.
        """
        rows = settle(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
        cells = self._cells(rows.select("_row", self.text), ("_row",), outer=False)
        held = cells.select("_row", F.col("_cells.idx").alias("idx"), self._values().alias("value"))
        none = [F.array().cast("array<int>"), F.array().cast("array<double>")]
        stored = F.struct(
            F.lit(0).cast("tinyint").alias("type"),
            F.lit(self.vocabulary.size).cast("int").alias("size"),
            F.coalesce("idx", none[0]).alias("indices"),
            F.coalesce("value", none[1]).alias("values"),
        )
        joined = rows.join(held, "_row", "left").select(*[F.col(f"`{c}`") for c in df.columns], stored.alias("features"))
        return settle(joined, "vectors", T.StructType([*df.schema, T.StructField("features", VectorUDT())]))

    def _cells(self, numbered: DataFrame, keys: Sequence[str], outer: bool) -> DataFrame:
        """``(keys, _cells)``: per row of ``numbered`` its known terms as sorted array<struct<idx, w>>, not yet normalized."""
        bag = counted_bag(analyze(F.col(self.text), self.vocabulary.config))
        exploded = F.explode_outer(bag) if outer else F.explode(bag)
        counted = numbered.select(*keys, exploded.alias("t"))
        counted = counted.select(*keys, "t.term", F.col("t.tf").cast("bigint").alias("tf"))
        table = self.vocabulary.table.select("term", "idx", "idf")
        weight = F.col("tf").cast("double") if self.method == BOW else F.col("tf") * F.col("idf")
        known = lookup_join(counted, table, "term", ["_row"], "left" if outer else "inner", self.vocabulary.small)
        cell = F.when(F.col("idx").isNotNull(), F.struct("idx", weight.alias("w")))
        return known.groupBy(*keys).agg(F.sort_array(F.collect_list(cell)).alias("_cells"))

    def _values(self) -> Column:
        """The values of ``_cells``, those of TF-IDF divided by their norm."""
        if self.method == BOW:
            return F.col("_cells.w")
        # bound once, not once for each cell
        norm = F.sqrt(F.aggregate("_cells", F.lit(0.0), lambda total, cell: total + cell["w"] * cell["w"]))
        scaled = F.transform(F.array(norm), lambda whole: F.transform("_cells", lambda cell: cell["w"] / whole))
        return F.get(scaled, F.lit(0))

    def long_form(self, df: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
        """``(keys, idx, value)``, one row per non-zero cell; a zero row appears once with null ``idx``."""
        if self.vocabulary.small:
            cells = self.transform(df).select(*keys, F.explode_outer(stored_values("features")).alias("cell"))
            return cells.select(*keys, "cell.idx", "cell.value")
        return self.joined_form(df, keys)

    def joined_form(self, df: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
        """The long form by a join on the term, for vocabularies of any size."""
        numbered = df.withColumn("_row", F.monotonically_increasing_id())  # before the terms are exploded
        # rows are told apart by their number, so that a repeated key keeps its rows; a row without a known term stays
        rows = self._cells(numbered, ("_row", *keys), outer=True).withColumn("_value", self._values())
        cells = rows.select(*keys, F.explode_outer(F.arrays_zip(F.col("_cells.idx").alias("idx"), F.col("_value").alias("value"))).alias("cell"))
        return cells.select(*keys, "cell.idx", "cell.value")


def fit_bag(df: DataFrame, config: VectorConfig, method: str = TFIDF, text: str = "processed") -> BagModel:
    method = method.lower()
    if method not in (BOW, TFIDF):
        raise ValueError(f"no such representation: {method}")
    return BagModel(fit_vocabulary(df, text, config), method, text)


def fit_transform(df: DataFrame, config: VectorConfig, method: str = TFIDF, text: str = "processed") -> DataFrame:
    return fit_bag(df, config, method, text).transform(df)


def dense_vectors(vectors: DataFrame, column: str = "features", out: str = "dense") -> DataFrame:
    """ARRAY<DOUBLE> of the vocabulary's length, made row by row."""
    return vectors.withColumn(out, vector_to_array(column))


def sparsity(vectors: DataFrame, n_features: int, column: str = "features") -> DataFrame:
    """Share of zero cells, from the stored entries alone."""
    filled = F.sum(nonzero_count(column))
    return vectors.agg(
        F.count("*").alias("n_docs"),
        filled.alias("n_nonzero"),
        (1 - filled / (F.count("*") * F.lit(n_features))).alias("sparsity"),
    )


def nonzero_features(vectors: DataFrame, keys: Sequence[str] = ("doc_id",), column: str = "features") -> DataFrame:
    return vectors.select(*keys, nonzero_count(column).alias("n_nonzero"))


def top_terms(
    vectors: DataFrame, vocabulary: Vocabulary, n: int, keys: Sequence[str] = ("doc_id",), column: str = "features"
) -> DataFrame:
    """The ``n`` heaviest terms of each document, ties by term. Ranked inside the row, then joined to their names."""
    # the feature index follows the sorted terms, so index order is term order
    heaviest_first = F.transform(
        stored_values(column), lambda cell: F.struct((-cell["value"]).alias("minus"), cell["idx"].alias("idx"))
    )
    ranked = F.sort_array(heaviest_first)
    best = vectors.select(*keys, F.posexplode(F.slice(ranked, 1, n)).alias("place", "cell"))
    named = lookup_join(
        best.select(*keys, (F.col("place") + 1).cast("bigint").alias("rank"), "cell.idx", (-F.col("cell.minus")).alias("weight")),
        vocabulary.feature_names(),
        "idx",
        keys,
        broadcast=vocabulary.small,
    )
    return named.select(*keys, "rank", "term", "weight")
