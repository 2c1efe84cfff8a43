"""V and R: vocabulary, vectors, ranking and similarity."""

from dataclasses import replace
from functools import lru_cache

from pyspark.sql import functions as F

from checks.base import PROCESSED_SQL, check, processed, processed_docs, sql_processed, table
from lexispark.config import VectorConfig
from lexispark.functions import analyzer
from lexispark.operators import ranking, vectors
from lexispark.operators import vocabulary as V
from lexispark.operators.comparison import fit_methods

CONFIG = VectorConfig(max_features=5000)
EVERY_TERM = VectorConfig(max_features=None, min_df=1, max_df=1.0)
NONWORD = r"[^\p{L}\p{N}_]+"


def texts(spark, folder):
    return table(spark, folder, "documents").select("doc_id", "text")


def analyzed_sql(rows: str, keys: str = "doc_id") -> str:
    words = f"list_filter(string_split_regex(strip_accents(lower(coalesce(text, ''))), '{NONWORD}'), lambda w: length(w) >= 2)"
    return f"SELECT {keys}, {words} AS tokens FROM ({rows})"


def vocabulary_ctes(rows: str, min_df=2, max_df=0.95, limit=5000) -> str:
    """CTEs post(doc_id, term, tf), stats, vocab(term, idx, df, cf, idf) and bow(doc_id, idx, term, tf, w)."""
    return f"""
    ana AS ({analyzed_sql(rows)}),
    post AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM ana) GROUP BY ALL),
    n AS (SELECT count(*) AS n FROM ana),
    stats AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM post GROUP BY term),
    kept AS (SELECT * FROM stats, n WHERE df >= {min_df} AND df <= {max_df}::DOUBLE * n),
    lim AS (SELECT * FROM kept ORDER BY cf DESC, term LIMIT {limit}),
    vocab AS (SELECT term, (row_number() OVER (ORDER BY term) - 1)::INT AS idx, df, cf,
              ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1.0 AS idf FROM lim),
    bow AS (SELECT doc_id, idx, term, tf, tf * idf AS w FROM post JOIN vocab USING (term)),
    tfidf AS (SELECT doc_id, idx, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS v FROM bow)
    """


DOCS = "SELECT doc_id, text FROM documents"
CTES = "WITH " + vocabulary_ctes(DOCS)


@lru_cache(maxsize=4)
def vocab(spark, folder):
    """The vocabulary is written once per session and folder; every check transforms the whole table itself."""
    return V.fit_vocabulary(texts(spark, folder), "text", CONFIG)


def fitted(spark, folder, method=vectors.TFIDF):
    return vectors.BagModel(vocab(spark, folder), method, "text")


def beyond(model):
    """The model as if its vocabulary were beyond the broadcast bounds."""
    return replace(model, vocabulary=replace(model.vocabulary, small=False))


def fitted_beyond(spark, folder, method=vectors.TFIDF):
    return beyond(fitted(spark, folder, method))


def both_forms(name, sql, make):
    """Register a query with vectors made in the row, and once more with vectors assembled from joined cells."""
    place, _, rest = name.partition("_")
    check(name, sql)(lambda spark, folder: make(spark, folder, fitted))
    check(f"{place}_joined_{rest}", sql)(lambda spark, folder: make(spark, folder, fitted_beyond))


@check(
    "v01_analyzer",
    f"SELECT doc_id, array_to_string(tokens, ' ') AS tokens, len(tokens)::INT AS n FROM ({analyzed_sql(DOCS)})",
)
def analyze(spark, folder):
    tokens = texts(spark, folder).select("doc_id", analyzer.analyze(F.col("text"), CONFIG).alias("t"))
    return tokens.select("doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").alias("n"))


@check(
    "v01_ascii_analyzer",
    f"SELECT doc_id, array_to_string(tokens, ' ') AS tokens FROM ({analyzed_sql(DOCS)})".replace(
        "strip_accents(lower(coalesce(text, '')))",
        r"regexp_replace(strip_accents(lower(coalesce(text, ''))), '[^\x00-\x7F]', '', 'g')",
    ),
)
def ascii_analyze(spark, folder):
    tokens = analyzer.analyze(F.col("text"), VectorConfig(strip_accents="ascii"))
    return texts(spark, folder).select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@check(
    "v02_ngrams",
    f"""WITH ana AS ({analyzed_sql(DOCS)}),
    w AS (SELECT doc_id, unnest(tokens) AS t, generate_subscripts(tokens, 1) AS i FROM ana),
    g AS (SELECT t AS term FROM w
          UNION ALL SELECT a.t || ' ' || b.t FROM w a JOIN w b ON a.doc_id = b.doc_id AND b.i = a.i + 1)
    SELECT term, count(*) AS n FROM g GROUP BY term""",
)
def ngrams(spark, folder):
    runs = analyzer.analyze(F.col("text"), VectorConfig(ngram_range=(1, 2)))
    return texts(spark, folder).select(F.explode(runs).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def stats(spark, folder):
    return V.term_stats(V.postings(texts(spark, folder), "text", CONFIG, ()))


check("v03_term_stats", f"{CTES} SELECT term, df, cf FROM stats")(stats)
check("v04_min_df", f"{CTES} SELECT term, df, cf FROM stats WHERE df >= 2")(lambda s, f: V.prune_min_df(stats(s, f), 2))


@check("v05_max_df", f"{CTES} SELECT term, df, cf FROM stats, n WHERE df <= 0.3::DOUBLE * n")
def max_df(spark, folder):
    return V.prune_max_df(stats(spark, folder), 0.3, texts(spark, folder).count())


@check("v06_max_features", f"{CTES} SELECT term, df, cf FROM stats ORDER BY cf DESC, term LIMIT 3000")
def max_features(spark, folder):
    return V.limit_features(stats(spark, folder), 3000)


check("v07_feature_names", f"{CTES} SELECT idx, term FROM vocab")(lambda s, f: vocab(s, f).feature_names())


@check(
    "v07_every_feature_name",
    "WITH " + vocabulary_ctes(DOCS, 1, 1.0, 10**9) + " SELECT idx, term, df, cf FROM vocab",
)
def every_feature_name(spark, folder):
    return V.fit_vocabulary(texts(spark, folder), "text", EVERY_TERM).table.drop("idf")


ZERO_ROWS = "SELECT doc_id FROM ana"


@check(
    "v08_bow_transform",
    f"{CTES} SELECT a.doc_id, idx, tf AS value FROM ana a LEFT JOIN bow b ON a.doc_id = b.doc_id",
)
def bow_transform(spark, folder):
    cells = fitted(spark, folder, vectors.BOW).long_form(texts(spark, folder))
    return cells.withColumn("value", F.col("value").cast("bigint"))


@check(
    "v08_joined_bow_transform",
    f"{CTES} SELECT a.doc_id, idx, tf AS value FROM ana a LEFT JOIN bow b ON a.doc_id = b.doc_id",
)
def joined_bow_transform(spark, folder):
    cells = fitted(spark, folder, vectors.BOW).joined_form(texts(spark, folder))
    return cells.withColumn("value", F.col("value").cast("bigint"))


def fit_transform(spark, folder, model_of):
    pages = table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text"))
    if model_of is fitted:
        counted = vectors.fit_transform(pages, CONFIG, vectors.BOW, "text")
    else:
        counted = beyond(vectors.fit_bag(pages, CONFIG, vectors.BOW, "text")).transform(pages)
    total = F.aggregate(F.unwrap_udt("features")["values"], F.lit(0.0), lambda acc, x: acc + x)
    return counted.select(
        "doc_id", vectors.nonzero_count("features").cast("bigint").alias("n_terms"), total.cast("bigint").alias("n_tokens")
    )


both_forms(
    "v09_fit_transform",
    "WITH "
    + vocabulary_ctes("SELECT page_id AS doc_id, html AS text FROM pages")
    + "SELECT doc_id, count(*) AS n_terms, sum(tf)::BIGINT AS n_tokens FROM bow GROUP BY doc_id",
    fit_transform,
)


@check("v10_idf", f"{CTES} SELECT term, round(idf, 6) AS idf FROM vocab")
def idf(spark, folder):
    return vocab(spark, folder).idf().withColumn("idf", F.round("idf", 6))


TFIDF_SQL = f"{CTES} SELECT a.doc_id, idx, round(v, 6) AS value FROM ana a LEFT JOIN tfidf t ON a.doc_id = t.doc_id"


@check("v11_tfidf_transform", TFIDF_SQL)
def tfidf_transform(spark, folder):
    return fitted(spark, folder).long_form(texts(spark, folder)).withColumn("value", F.round("value", 6))


@check("v11_joined_tfidf_transform", TFIDF_SQL)
def joined_tfidf_transform(spark, folder):
    return fitted(spark, folder).joined_form(texts(spark, folder)).withColumn("value", F.round("value", 6))


@check("v12_top_idf", f"{CTES} SELECT term, round(idf, 6) AS idf FROM vocab ORDER BY vocab.idf DESC, term LIMIT 10")
def top_idf(spark, folder):
    return vocab(spark, folder).top_idf(10).withColumn("idf", F.round("idf", 6))


@check(
    "v13_dense_vectors",
    "WITH "
    + vocabulary_ctes(DOCS, limit=40)
    + """SELECT a.doc_id, string_agg(coalesce(tf, 0)::VARCHAR, ' ' ORDER BY v.idx) AS dense
         FROM ana a CROSS JOIN vocab v LEFT JOIN post p ON p.doc_id = a.doc_id AND p.term = v.term GROUP BY a.doc_id""",
)
def dense_vectors(spark, folder):
    model = vectors.fit_bag(texts(spark, folder), VectorConfig(max_features=40), vectors.BOW, "text")
    dense = vectors.dense_vectors(model.transform(texts(spark, folder)))
    return dense.select("doc_id", F.array_join(F.col("dense").cast("array<bigint>"), " ").alias("dense"))


def sparsity(spark, folder, model_of):
    model = model_of(spark, folder)
    zeros = vectors.sparsity(model.transform(texts(spark, folder)), model.vocabulary.size)
    return zeros.withColumn("sparsity", F.round("sparsity", 6))


both_forms(
    "v14_sparsity",
    f"""{CTES} SELECT n AS n_docs, (SELECT count(*) FROM bow) AS n_nonzero,
        round(1 - (SELECT count(*) FROM bow) / (n * (SELECT count(*) FROM vocab)), 6) AS sparsity FROM n""",
    sparsity,
)


def nonzero_features(spark, folder, model_of):
    return vectors.nonzero_features(model_of(spark, folder).transform(texts(spark, folder)))


both_forms(
    "v15_nonzero_features",
    f"{CTES} SELECT a.doc_id, count(idx)::INT AS n_nonzero FROM ana a LEFT JOIN bow b ON a.doc_id = b.doc_id GROUP BY a.doc_id",
    nonzero_features,
)


def top_terms(spark, folder, model_of):
    model = model_of(spark, folder, vectors.BOW)
    return vectors.top_terms(model.transform(texts(spark, folder)), model.vocabulary, 15)


both_forms(
    "v16_top_terms",
    f"""{CTES} SELECT doc_id, rank, term, tf::DOUBLE AS weight FROM (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term) AS rank FROM bow) WHERE rank <= 15""",
    top_terms,
)


# ------------------------------------------------------------------ the three methods on the processed corpus
RANK_CTES = f"""
    docs AS ({PROCESSED_SQL}),
    btok AS (SELECT doc_id, list_filter(string_split(processed, ' '), lambda w: w <> '') AS tokens FROM docs),
    bpost AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM btok) GROUP BY ALL),
    bn AS (SELECT count(*) AS nd, sum(len(tokens)) / count(*) AS avgdl FROM btok),
    bdf AS (SELECT term, count(*) AS df FROM bpost GROUP BY term),
    braw AS (SELECT term, df, ln(nd - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS raw FROM bdf, bn),
    bidf AS (SELECT term, df, CASE WHEN raw < 0 THEN 0.25 * avg(raw) OVER () ELSE raw END AS idf FROM braw),
    gain AS (SELECT p.doc_id, p.term, idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(t.tokens) / avgdl)) AS part
             FROM bpost p JOIN bidf USING (term) JOIN btok t ON t.doc_id = p.doc_id, bn)
"""
QUERIES_SQL = f"SELECT item_id AS query_id, processed AS query FROM ({sql_processed('SELECT item_id, text FROM benchmark')})"
SCORE_CTES = f"""{RANK_CTES},
    asked AS ({QUERIES_SQL}),
    qterms AS (SELECT query_id, term, count(*) AS qtf FROM (
      SELECT query_id, unnest(string_split(query, ' ')) AS term FROM asked) GROUP BY ALL),
    scores AS (SELECT query_id, doc_id, sum(qtf * part) AS score FROM qterms JOIN gain USING (term) GROUP BY ALL)
"""


def benchmark_queries(spark, folder):
    items = processed(table(spark, folder, "benchmark"), "item_id")
    return items.select(F.col("item_id").alias("query_id"), F.col("processed").alias("query"))


@lru_cache(maxsize=4)
def bm25(spark, folder):
    return ranking.fit_bm25(processed_docs(spark, folder))


@lru_cache(maxsize=4)
def methods(spark, folder):
    return fit_methods(processed_docs(spark, folder), "processed", CONFIG)


def methods_beyond(spark, folder):
    both = methods(spark, folder)
    return replace(both, bow=beyond(both.bow), tfidf=beyond(both.tfidf))


METHOD_CTES = "WITH " + vocabulary_ctes(f"SELECT doc_id, processed AS text FROM ({PROCESSED_SQL})")
SIZES_SQL = """SELECT 'BOW' AS method, count(*) AS n_terms FROM vocab UNION ALL SELECT 'TF-IDF', count(*) FROM vocab
               UNION ALL SELECT 'BM25', count(*) FROM bidf"""

check("v17_vocabulary_sizes", f"{METHOD_CTES}, {RANK_CTES} {SIZES_SQL}")(lambda s, f: methods(s, f).vocabulary_sizes())


COMPARE_DOCUMENT_SQL = f"""{METHOD_CTES}, {RANK_CTES},
    parts AS (SELECT 'BOW' AS method, term, tf::DOUBLE AS weight FROM bow WHERE doc_id = 0
      UNION ALL SELECT 'TF-IDF', term, v FROM tfidf WHERE doc_id = 0
      UNION ALL SELECT 'BM25', term, tf * part FROM gain JOIN bpost USING (doc_id, term) WHERE doc_id = 0 AND part <> 0)
    SELECT method, n_nonzero, rank, term, round(weight, 4) AS weight FROM (
      SELECT *, count(*) OVER (PARTITION BY method) AS n_nonzero,
             row_number() OVER (PARTITION BY method ORDER BY round(weight, 9) DESC, term) AS rank FROM parts)
    WHERE rank <= 5"""


@check("v18_compare_document", COMPARE_DOCUMENT_SQL)
def compare_document(spark, folder, of=methods):
    compared = of(spark, folder).compare_document(processed_docs(spark, folder), 0)
    return compared.withColumn("weight", F.round("weight", 4))


check("v18_joined_compare_document", COMPARE_DOCUMENT_SQL)(lambda s, f: compare_document(s, f, methods_beyond))


METHOD_COMPARISON_SQL = f"""{METHOD_CTES}, {SCORE_CTES}, sizes AS ({SIZES_SQL}),
    cells AS (SELECT 1 - (SELECT count(*) FROM bow) / (n * (SELECT count(*) FROM vocab)) AS s FROM n),
    pairs AS (SELECT 1 - (SELECT count(*) FROM scores WHERE score <> 0) / (nd * (SELECT count(*) FROM asked)) AS s FROM bn)
    SELECT method, n_terms, round(CASE method WHEN 'BM25' THEN pairs.s ELSE cells.s END, 6) AS sparsity,
           CASE method WHEN 'BM25' THEN 'dense' ELSE 'sparse' END AS vector_type,
           CASE method WHEN 'TF-IDF' THEN '[0, 1]' ELSE '[0, inf)' END AS output_range,
           method = 'BM25' AS handles_length FROM sizes, cells, pairs"""


@check("v19_method_comparison", METHOD_COMPARISON_SQL)
def method_comparison(spark, folder, of=methods):
    table_ = of(spark, folder).method_comparison(processed_docs(spark, folder), benchmark_queries(spark, folder))
    return table_.withColumn("sparsity", F.round("sparsity", 6))


check("v19_joined_method_comparison", METHOD_COMPARISON_SQL)(lambda s, f: method_comparison(s, f, methods_beyond))


@check(
    "v20_fit_all",
    f"""{METHOD_CTES}, {RANK_CTES}
    SELECT b.term, b.df AS bm25_df, round(b.idf, 6) AS bm25_idf, v.idx, round(v.idf, 6) AS tfidf_idf
    FROM bidf b LEFT JOIN vocab v ON v.term = b.term""",
)
def fit_all(spark, folder):
    both = methods(spark, folder)
    pruned = both.tfidf.vocabulary.table.select("term", "idx", F.round("idf", 6).alias("tfidf_idf"))
    whole = both.bm25.terms.select("term", F.col("df").alias("bm25_df"), F.round("idf", 6).alias("bm25_idf"))
    return whole.join(pruned, "term", "left")


# ------------------------------------------------------------------ ranking
@check("r01_bm25_statistics", f"WITH {RANK_CTES} SELECT term, df, round(idf, 6) AS idf, nd AS n_docs, round(avgdl, 6) AS mean_length FROM bidf, bn")
def bm25_statistics(spark, folder):
    model = ranking.fit_bm25(processed_docs(spark, folder))
    return model.terms.select(
        "term",
        "df",
        F.round("idf", 6).alias("idf"),
        F.lit(model.n_docs).cast("bigint").alias("n_docs"),
        F.round(F.lit(model.mean_length), 6).alias("mean_length"),
    )


@check("r02_bm25_scores", f"WITH {SCORE_CTES} SELECT query_id, doc_id, round(score, 4) AS score FROM scores")
def bm25_scores(spark, folder):
    scores = bm25(spark, folder).scores(processed_docs(spark, folder), benchmark_queries(spark, folder))
    return scores.withColumn("score", F.round("score", 4))


def ranked_sql(scores: str, k: int) -> str:
    return f"""SELECT query_id, rank, doc_id, round(score, 4) AS score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM ({scores}))
      WHERE rank <= {k}"""


@check("r03_bm25_rank", f"WITH {SCORE_CTES} {ranked_sql('SELECT * FROM scores', 10)}")
def bm25_rank(spark, folder):
    ranked = bm25(spark, folder).rank(processed_docs(spark, folder), benchmark_queries(spark, folder), 10)
    return ranked.withColumn("score", F.round("score", 4))


@check(
    "r03_bm25_rank_all",
    f"""WITH {SCORE_CTES} {ranked_sql('''
      SELECT q.query_id, d.doc_id, coalesce(s.score, 0) AS score FROM asked q CROSS JOIN docs d
      LEFT JOIN scores s ON s.query_id = q.query_id AND s.doc_id = d.doc_id''', 10**9)}""",
)
def bm25_rank_all(spark, folder):
    ranked = bm25(spark, folder).rank(processed_docs(spark, folder), benchmark_queries(spark, folder))
    return ranked.withColumn("score", F.round("score", 4))


check("r04_bm25_vocabulary", f"WITH {RANK_CTES} SELECT DISTINCT term FROM bpost")(lambda s, f: bm25(s, f).vocabulary())


@check(
    "r05_bm25_summary",
    f"""WITH {SCORE_CTES}
    SELECT n_pairs, count(*) FILTER (score <> 0) AS n_nonzero, round(sum(score) / n_pairs, 4) AS mean_score,
           round(CASE WHEN count(*) < n_pairs THEN greatest(max(score), 0) ELSE max(score) END, 4) AS max_score,
           round(1 - count(*) FILTER (score <> 0) / n_pairs, 6) AS sparsity
    FROM scores, (SELECT nd * (SELECT count(*) FROM asked) AS n_pairs FROM bn) GROUP BY n_pairs""",
)
def bm25_summary(spark, folder):
    summary = bm25(spark, folder).summary(processed_docs(spark, folder), benchmark_queries(spark, folder))
    for column, digits in (("mean_score", 4), ("max_score", 4), ("sparsity", 6)):
        summary = summary.withColumn(column, F.round(column, digits))
    return summary


def cosine_sql(vector: str) -> str:
    return f"""{CTES}, vec AS ({vector}),
    norms AS (SELECT doc_id, sqrt(sum(v * v)) AS norm FROM vec GROUP BY doc_id),
    dots AS (SELECT b.doc_id, sum(a.v * b.v) AS dot FROM vec a JOIN vec b ON a.idx = b.idx
             WHERE a.doc_id = 5 AND b.doc_id <> 5 GROUP BY b.doc_id),
    sims AS (SELECT d.doc_id, coalesce(dot / (m.norm * (SELECT norm FROM norms WHERE doc_id = 5)), 0) AS similarity
             FROM ana d LEFT JOIN dots ON dots.doc_id = d.doc_id LEFT JOIN norms m ON m.doc_id = d.doc_id
             WHERE d.doc_id <> 5)
    SELECT row_number() OVER (ORDER BY round(similarity, 9) DESC, doc_id) AS rank, doc_id,
           round(similarity, 4) AS similarity FROM sims QUALIFY rank <= 25"""


def cosine(method):
    def query(spark, folder, model_of):
        similar = ranking.cosine_topk(texts(spark, folder), model_of(spark, folder, method), 5, 25)
        return similar.withColumn("similarity", F.round("similarity", 4))

    return query


both_forms("r06_cosine_bow", cosine_sql("SELECT doc_id, idx, tf::DOUBLE AS v FROM bow"), cosine(vectors.BOW))
both_forms("r07_cosine_tfidf", cosine_sql("SELECT doc_id, idx, v FROM tfidf"), cosine(vectors.TFIDF))


@check(
    "r08_bm25_similar",
    f"""WITH {RANK_CTES}, scores AS (
      SELECT q.doc_id AS query_id, g.doc_id, sum(q.tf * g.part) AS score FROM bpost q JOIN gain g USING (term)
      WHERE q.doc_id = 5 GROUP BY ALL) {ranked_sql('SELECT * FROM scores', 25)}""",
)
def bm25_similar(spark, folder):
    similar = bm25(spark, folder).similar(processed_docs(spark, folder), 5, 25)
    return similar.withColumn("score", F.round("score", 4))


@lru_cache(maxsize=4)
def posting_index(spark, folder):
    return bm25(spark, folder).index(processed_docs(spark, folder))


@check("r02_index_scores", f"WITH {SCORE_CTES} SELECT query_id, doc_id, round(score, 4) AS score FROM scores")
def index_scores(spark, folder):
    scores = posting_index(spark, folder).scores(benchmark_queries(spark, folder))
    return scores.withColumn("score", F.round("score", 4))


@check(
    "r03_index_rank",
    f"""WITH {SCORE_CTES} {ranked_sql('''
      SELECT q.query_id, d.doc_id, coalesce(s.score, 0) AS score FROM asked q CROSS JOIN docs d
      LEFT JOIN scores s ON s.query_id = q.query_id AND s.doc_id = d.doc_id''', 10)}""",
)
def index_rank(spark, folder):
    ranked = posting_index(spark, folder).rank(benchmark_queries(spark, folder), 10)
    return ranked.withColumn("score", F.round("score", 4))


def document_queries(spark, folder):
    """The first words of every document: one query for each, so a set that grows with the corpus."""
    words = F.array_join(F.slice(F.split("processed", " "), 1, 8), " ")
    return processed_docs(spark, folder).select(F.col("doc_id").alias("query_id"), words.alias("query"))


@check(
    "r03_rank_document_queries",
    f"""WITH {RANK_CTES},
    asked AS (SELECT doc_id AS query_id, string_split(processed, ' ')[1:8] AS words FROM docs),
    qterms AS (SELECT query_id, term, count(*) AS qtf FROM (SELECT query_id, unnest(words) AS term FROM asked) GROUP BY ALL),
    scores AS (SELECT query_id, doc_id, sum(qtf * part) AS score FROM qterms JOIN gain USING (term) GROUP BY ALL)
    {ranked_sql('''
      SELECT q.query_id, d.doc_id, coalesce(s.score, 0) AS score FROM asked q CROSS JOIN docs d
      LEFT JOIN scores s ON s.query_id = q.query_id AND s.doc_id = d.doc_id''', 5)}""",
)
def rank_document_queries(spark, folder):
    ranked = posting_index(spark, folder).rank(document_queries(spark, folder), 5)
    return ranked.withColumn("score", F.round("score", 4))
