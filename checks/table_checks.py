"""S, P and A: sources and sinks, row preparation, corpus profile."""

import uuid

from pyspark.sql import functions as F

from checks.base import (
    LABELLED_SQL,
    PROCESSED_SQL,
    SNIPPET_SQL,
    check,
    labelled,
    predictions,
    processed,
    processed_docs,
    snippet_docs,
    sql_processed,
    table,
)
from lexispark.operators import metrics, prep, profile
from lexispark.operators.scale import work_dir
from lexispark.sources import run_log, text_tables


def fresh(spark, name):
    return f"{work_dir(spark)}/lexispark/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ sources and sinks
REVIEWS_SQL = f"SELECT text AS \"Text\", (1 + doc_id % 5)::INT AS \"Score\" FROM ({SNIPPET_SQL})"


def review_csv(spark, folder):
    """The documents as a headed review file: quotes, line breaks, blank and missing texts included."""
    path = fresh(spark, "reviews")
    rows = snippet_docs(spark, folder).select(
        F.col("doc_id").alias("Id"), F.col("text").alias("Text"), (1 + F.col("doc_id") % 5).alias("Score")
    )
    rows.write.csv(path, header=True, **text_tables.VERBATIM)
    return text_tables.read_reviews(spark, path, ["Id", "Text", "Score"])


check("s01_read_reviews", REVIEWS_SQL)(review_csv)


TWEET_FIELDS = "((conv_id + turn) % 5)::INT AS polarity, conv_id AS id, 'Mon Apr 06 22:19:45' AS date, 'NO_QUERY' AS query"


@check(
    "s02_read_tweets",
    f"SELECT {TWEET_FIELDS}, role AS user, {'regexp_replace(text, chr(10), chr(32), $$g$$)'} AS text FROM conversations",
)
def read_tweets(spark, folder):
    path = fresh(spark, "tweets")
    rows = table(spark, folder, "conversations").select(
        ((F.col("conv_id") + F.col("turn")) % 5).cast("int"),
        "conv_id",
        F.lit("Mon Apr 06 22:19:45"),
        F.lit("NO_QUERY"),
        "role",
        F.replace("text", F.lit("\n"), F.lit(" ")),
    )
    rows.write.csv(path, header=False, encoding="ISO-8859-1", **text_tables.VERBATIM)
    return text_tables.read_tweets(spark, path)


SNIPPET_PROCESSED = sql_processed(f"SELECT doc_id, source, text FROM ({SNIPPET_SQL})")


def snippet_rows(spark, folder):
    return processed(snippet_docs(spark, folder), "doc_id", "source").withColumn("label", (F.col("doc_id") % 2).cast("int"))


@check("s03_read_processed", f"SELECT nullif(processed, '') AS processed, (doc_id % 2)::INT AS label FROM ({SNIPPET_PROCESSED})")
def read_processed(spark, folder):
    path = fresh(spark, "processed")
    text_tables.write_processed(snippet_rows(spark, folder), path)
    return text_tables.read_processed(spark, path)


@check(
    "s04_write_processed",
    f"SELECT doc_id, source, nullif(processed, '') AS processed, (doc_id % 2)::INT AS label FROM ({SNIPPET_PROCESSED})",
)
def write_processed(spark, folder):
    path = fresh(spark, "processed")
    text_tables.write_processed(snippet_rows(spark, folder), path, "parquet")
    return text_tables.read_processed(spark, path, "parquet")


def written_results(spark, folder):
    """The comparison table as written and read back; registered next to the SQL of the table."""
    path = fresh(spark, "results")
    text_tables.write_results(metrics.comparison_table(predictions(spark, folder)), path)
    return spark.read.csv(path, header=True, schema="model string, accuracy double, precision double, recall double, f1 double, auc_score double")


# one run per source, with its size and mean text length as parameter and metric
def logged(spark, folder):
    path = fresh(spark, "runs")
    sizes = table(spark, folder, "documents").groupBy("source").agg(
        F.count("*").alias("n"), F.floor(F.avg("n_chars")).alias("mean_chars")
    )
    entry = lambda kind, key, value: F.struct(F.lit(kind).alias("kind"), F.lit(key).alias("key"), value.cast("string").alias("value"))
    entries = F.array(
        entry("run", "name", F.col("source")),
        entry("param", "rows", F.col("n")),
        entry("metric", "mean_chars", F.col("mean_chars")),
    )
    rows = sizes.select(
        F.lit("profiles").alias("experiment"),
        F.md5("source").alias("run_id"),
        F.md5(F.lit("profiles")).alias("parent_id"),
        F.col("source").alias("name"),
        F.when(F.col("n") > 45, "FINISHED").otherwise("FAILED").alias("status"),
        F.explode(entries).alias("e"),
    ).select("experiment", "run_id", "parent_id", "name", "status", "e.*")
    run_log.log_table(rows, path)
    return path


RUNS_SQL = """
SELECT 'profiles' AS experiment, md5(source) AS run_id, md5('profiles') AS parent_id, source AS name,
       CASE WHEN n > 45 THEN 'FINISHED' ELSE 'FAILED' END AS status, kind, key,
       CASE kind WHEN 'run' THEN source WHEN 'param' THEN n::VARCHAR ELSE mean_chars::VARCHAR END AS value
FROM (SELECT source, count(*) AS n, floor(avg(n_chars))::BIGINT AS mean_chars FROM documents GROUP BY source),
     (VALUES ('run', 'name'), ('param', 'rows'), ('metric', 'mean_chars')) k(kind, key)
"""


@check("s08_log_run", RUNS_SQL)
def log_run(spark, folder):
    return run_log.read_runs(spark, logged(spark, folder))


@check(
    "s09_search_runs",
    f"""SELECT run_id, parent_id, name, status, count(*) FILTER (kind = 'param') AS n_params,
        count(*) FILTER (kind = 'metric') AS n_metrics, count(*) FILTER (kind = 'artifact') AS n_artifacts
        FROM ({RUNS_SQL}) GROUP BY ALL""",
)
def search_runs(spark, folder):
    return run_log.search_runs(spark, logged(spark, folder), "profiles")


@check(
    "s09_run_counts",
    f"SELECT experiment, status, count(*) AS n_runs FROM ({RUNS_SQL}) WHERE kind = 'run' GROUP BY ALL",
)
def run_counts(spark, folder):
    return run_log.run_counts(spark, logged(spark, folder))


# ------------------------------------------------------------------ preparation
@check("p01_drop_incomplete", f"SELECT doc_id, text FROM ({SNIPPET_SQL}) WHERE text IS NOT NULL AND doc_id IS NOT NULL")
def drop_incomplete(spark, folder):
    return prep.drop_incomplete(snippet_docs(spark, folder).select("doc_id", "text"), ["doc_id", "text"])


@check("p02_label_threshold", "SELECT event_id, value, (value >= 50)::INT AS label FROM events")
def label_threshold(spark, folder):
    return prep.label_threshold(table(spark, folder, "events").select("event_id", "value"), "value", 50)


@check("p03_label_equals", "SELECT event_id, event_type, (event_type = 'purchase')::INT AS label FROM events")
def label_equals(spark, folder):
    return prep.label_equals(table(spark, folder, "events").select("event_id", "event_type"), "event_type", "purchase")


@check("p04_fill_text", f"SELECT doc_id, coalesce(text, '') AS text FROM ({SNIPPET_SQL})")
def fill_text(spark, folder):
    return prep.fill_text(snippet_docs(spark, folder).select("doc_id", "text"), "text")


@check("p05_drop_missing_text", f"SELECT doc_id, source, text FROM ({SNIPPET_SQL}) WHERE text IS NOT NULL")
def drop_missing_text(spark, folder):
    return prep.drop_missing_text(snippet_docs(spark, folder).select("doc_id", "source", "text"), "text")


def head_sql(n):
    return f"""SELECT doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS nr
               FROM documents) WHERE nr <= {n}"""


@check("p06_head_per_source", head_sql(20))
def head_per_source(spark, folder):
    return prep.head_per_source(table(spark, folder, "documents").select("doc_id", "source", "n_chars"), 20)


@check("p06_long_head_per_source", head_sql(1500))
def long_head_per_source(spark, folder):
    return prep.head_per_source(table(spark, folder, "documents").select("doc_id", "source", "n_chars"), 1500)


@check(
    "p07_combine",
    """SELECT doc_id, text, 'documents' AS source FROM documents
       UNION ALL SELECT item_id, text, 'benchmark' FROM benchmark UNION ALL SELECT page_id, html, 'pages' FROM pages""",
)
def combine(spark, folder):
    return prep.combine(
        {
            "documents": table(spark, folder, "documents").select("doc_id", "text"),
            "benchmark": table(spark, folder, "benchmark").select(F.col("item_id").alias("doc_id"), "text"),
            "pages": table(spark, folder, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text")),
        }
    )


KEYED = "SELECT *, md5('42|' || doc_id) AS k FROM"


@check("p08_shuffle", f"SELECT doc_id, lang, row_number() OVER (ORDER BY k, doc_id) - 1 AS position FROM ({KEYED} documents)")
def shuffle(spark, folder):
    return prep.shuffle(table(spark, folder, "documents").select("doc_id", "lang"), 42)


@check("p09_sample", f"SELECT doc_id, lang FROM ({KEYED} documents) ORDER BY k, doc_id LIMIT 77")
def sample(spark, folder):
    return prep.sample_n(table(spark, folder, "documents").select("doc_id", "lang"), 77, 42)


def split_sql(rows: str, key: str = "'42|' || doc_id") -> str:
    """``rows`` with a ``label`` column -> the same with ``split``."""
    return f"""
    SELECT * EXCLUDE (k, nr, quota), CASE WHEN nr <= quota THEN 'test' ELSE 'train' END AS split FROM (
      SELECT r.*, md5({key}) AS k, q.quota, row_number() OVER (PARTITION BY r.label ORDER BY md5({key}), doc_id) AS nr
      FROM ({rows}) r JOIN (
        SELECT label, test * c // n + (row_number() OVER (ORDER BY test * c % n DESC, label)
                 <= test - sum(test * c // n) OVER ())::INT AS quota
        FROM (SELECT label, count(*) AS c, sum(count(*)) OVER () AS n,
                     ceil(0.2::DOUBLE * sum(count(*)) OVER ())::BIGINT AS test FROM ({rows}) GROUP BY label)
      ) q ON r.label = q.label)"""


LABELS = "SELECT doc_id, quality AS label FROM labels"


def label_rows(spark, folder):
    return table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))


@check("p10_stratified_split", split_sql(LABELS))
def stratified_split(spark, folder):
    return prep.stratified_split(label_rows(spark, folder))


@check(
    "p11_split_report",
    f"""SELECT split, label, n, sum(n) OVER (PARTITION BY split)::BIGINT AS split_size,
        round(sum(n) OVER (PARTITION BY split) / sum(n) OVER (), 6) AS split_share,
        round(n / sum(n) OVER (PARTITION BY split), 6) AS class_share
        FROM (SELECT split, label, count(*) AS n FROM ({split_sql(LABELS)}) GROUP BY ALL)""",
)
def split_report(spark, folder):
    report = prep.split_report(prep.stratified_split(label_rows(spark, folder)))
    return report.withColumn("split_share", F.round("split_share", 6)).withColumn("class_share", F.round("class_share", 6))


# ------------------------------------------------------------------ profile
@check(
    "a01_dataset_summary",
    "SELECT source, count(*) AS n_rows, 'doc_id,text,lang,source,n_chars' AS columns FROM documents GROUP BY source",
)
def dataset_summary(spark, folder):
    return profile.dataset_summary(table(spark, folder, "documents"))


COUNTS_SQL = f"SELECT doc_id, source, len(list_filter(string_split(processed, ' '), lambda w: w <> ''))::INT AS n_tokens FROM ({SNIPPET_PROCESSED})"


def counts(spark, folder):
    return profile.token_counts(snippet_rows(spark, folder)).select("doc_id", "source", "n_tokens")


check("a02_token_counts", COUNTS_SQL)(counts)


@check(
    "a03_length_histogram",
    f"""SELECT source, bin, round(low + bin * width, 6) AS bin_start, round(low + (bin + 1) * width, 6) AS bin_end,
               count(*) AS n
        FROM (SELECT source, low, width, least(floor((n_tokens - low) / width), 49)::BIGINT AS bin
              FROM (SELECT source, n_tokens, min(n_tokens) OVER (PARTITION BY source) AS low,
                    (max(n_tokens) OVER (PARTITION BY source) - min(n_tokens) OVER (PARTITION BY source)) / 50 AS width
                    FROM ({COUNTS_SQL})))
        GROUP BY source, bin, low, width""",
)
def length_histogram(spark, folder):
    bins = profile.length_histogram(counts(spark, folder), 50)
    return bins.withColumn("bin_start", F.round("bin_start", 6)).withColumn("bin_end", F.round("bin_end", 6))


@check(
    "a04_length_stats",
    f"""SELECT source, round(avg(n_tokens), 6) AS mean_tokens, median(n_tokens) AS median_tokens
        FROM ({COUNTS_SQL}) GROUP BY source""",
)
def length_stats(spark, folder):
    return profile.length_stats(counts(spark, folder)).withColumn("mean_tokens", F.round("mean_tokens", 6))


QUANTILES, ACCURACY = (0.1, 0.5, 0.9, 0.99), 200


@check(
    "a04_length_quantiles",
    f"""SELECT source, share::DOUBLE AS share, count(*) AS n, true AS within FROM documents, (VALUES {", ".join(f"({q})" for q in QUANTILES)}) q(share)
        GROUP BY source, share""",
)
def length_quantiles(spark, folder):
    """Whether each sketched quantile has a rank within the stated error, by the exact ranks of all rows."""
    lengths = table(spark, folder, "documents").select("source", F.coalesce(F.length("text"), F.lit(0)).alias("n_tokens"))
    sketched = profile.length_quantiles(lengths, QUANTILES, ACCURACY)
    ranks = lengths.join(F.broadcast(sketched), "source").groupBy("source", "share").agg(
        F.count("*").alias("n"), F.count_if(F.col("n_tokens") < F.col("quantile")).alias("below"), F.count_if(F.col("n_tokens") <= F.col("quantile")).alias("upto")
    )
    error = F.col("n") / ACCURACY + 1
    within = (F.col("below") <= F.col("share") * F.col("n") + error) & (F.col("upto") >= F.col("share") * F.col("n") - error)
    return ranks.select("source", "share", "n", within.alias("within"))


@check(
    "a05_top_tokens",
    f"""SELECT source, term, count, rank FROM (
          SELECT source, term, count(*) AS count,
                 row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, term) AS rank
          FROM (SELECT source, unnest(string_split(processed, ' ')) AS term FROM ({PROCESSED_SQL}))
          WHERE term <> '' GROUP BY source, term) WHERE rank <= 30""",
)
def top_tokens(spark, folder):
    return profile.top_tokens(processed_docs(spark, folder), 30)


@check("a06_label_counts", f"SELECT source, label, count(*) AS n FROM ({LABELLED_SQL}) GROUP BY ALL")
def label_counts(spark, folder):
    return profile.label_counts(labelled(spark, folder))


@check(
    "a07_label_shares",
    f"SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM ({LABELS}) GROUP BY label",
)
def label_shares(spark, folder):
    return profile.label_shares(label_rows(spark, folder)).withColumn("share", F.round("share", 6))


# null is a group of its own, and the limit lies beyond what a task prunes by itself
EVENT_TYPES_SQL = "SELECT event_id, CASE WHEN event_id % 7 > 0 THEN event_type END AS event_type FROM events"


@check(
    "p06_head_per_event_type",
    f"SELECT * FROM ({EVENT_TYPES_SQL}) QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY event_id) <= 1200",
)
def head_per_event_type(spark, folder):
    events = table(spark, folder, "events").select("event_id", F.when(F.col("event_id") % 7 > 0, F.col("event_type")).alias("event_type"))
    return prep.head_per_source(events, 1200, order="event_id", source="event_type")
