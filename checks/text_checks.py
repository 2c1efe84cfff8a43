"""T, K and P12: cleaning, tokenizing and normalizing."""

from pyspark.sql import functions as F

from checks.base import (
    NONSPACE,
    PLAIN,
    SNIPPET_SQL,
    WORD,
    applied,
    check,
    clean_steps,
    quoted,
    snippet_docs,
    sql_collapse,
    sql_contractions,
    sql_filtered,
    sql_keep,
    sql_numbers,
    sql_split,
    sql_word_split,
    sub,
    table,
)
from lexispark import config as settings
from lexispark.functions import clean as C
from lexispark.functions import stemming
from lexispark.functions import tokens as K
from lexispark.operators import normalize as N


def on_docs(function):
    def query(spark, folder):
        return snippet_docs(spark, folder).select("doc_id", function(F.col("text")).alias("text"))

    return query


def on_pages(function, column="html"):
    def query(spark, folder):
        return table(spark, folder, "pages").select("page_id", function(F.col(column)).alias("text"))

    return query


def docs_sql(*steps):
    return applied(f"SELECT doc_id, text FROM ({SNIPPET_SQL})", list(steps))


def pages_sql(*steps, column="html"):
    return applied(f"SELECT page_id, {column} AS text FROM pages", list(steps))


URLS = rf"https?://{NONSPACE}+|www\.{NONSPACE}+"
PUNCTUATION = r"[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x{85}\p{Z}]"

check("p12_blank_guard", docs_sql(f"CASE WHEN regexp_matches(text, '{NONSPACE}') THEN text ELSE '' END"))(
    on_docs(C.blank_guard)
)
check("t01_lowercase", docs_sql("lower(text)"))(on_docs(C.lower_text))
check("t02_contractions", docs_sql("lower(text)", sql_contractions("text", settings.CONTRACTIONS)))(
    on_docs(lambda c: C.expand_contractions(C.lower_text(c), settings.CONTRACTIONS))
)
check("t03_html_tags", pages_sql(sub("text", "<[^>]+>")))(on_pages(C.strip_html_tags))
check("t04_html_entities", pages_sql(sub("text", "&[a-z]+;")))(on_pages(C.strip_entities))
check("t05_urls", docs_sql(sub("text", URLS)))(on_docs(C.strip_urls))
check("t06_mentions", docs_sql(sub("text", f"@{WORD}+")))(on_docs(C.strip_mentions))
check("t07_hashtags", docs_sql(sub("text", f"#{WORD}+")))(on_docs(C.drop_hashtags))
check("t08_hash_symbol", docs_sql("replace(text, '#', ' ')"))(on_docs(C.strip_hash_symbol))
check("t09_numbers", docs_sql(sql_numbers("text")))(on_docs(C.strip_numbers))
check("t10_punctuation", docs_sql(sub("text", PUNCTUATION)))(on_docs(C.strip_punctuation))
check("t11_whitespace", docs_sql(sql_collapse("text")))(on_docs(C.collapse_whitespace))

EVERYTHING = settings.CleanConfig(remove_mentions=True, remove_hashtags=True, remove_numbers=True)
check("t12_clean", pages_sql(*clean_steps(EVERYTHING)))(on_pages(lambda c: C.clean(c, EVERYTHING)))
check("t13_review_preset", docs_sql(*clean_steps(settings.review_config())))(
    on_docs(lambda c: C.clean(c, settings.review_config()))
)
check("t15_default_preset", docs_sql(*clean_steps(settings.default_config())))(
    on_docs(lambda c: C.clean(c, settings.default_config()))
)

MESSAGES = "SELECT conv_id, turn, text || ' @' || role || ' said 42 times: it''s #fine at www.ex.org' AS text FROM conversations"


@check("t14_tweet_preset", applied(MESSAGES, clean_steps(settings.tweet_config())))
def tweet_preset(spark, folder):
    tail = F.concat(F.lit(" @"), "role", F.lit(" said 42 times: it's #fine at www.ex.org"))
    text = F.concat("text", tail)
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", C.clean(text, settings.tweet_config()).alias("text")
    )


# ------------------------------------------------------------------ tokens; arrays are compared joined
CLEANED = applied(f"SELECT doc_id, text FROM ({SNIPPET_SQL})", clean_steps(PLAIN))


def tokens_sql(expression):
    return f"SELECT doc_id, array_to_string({expression}, ' ') AS tokens, len({expression}) AS n FROM ({CLEANED})"


def on_tokens(function):
    def query(spark, folder):
        cleaned = snippet_docs(spark, folder).select("doc_id", C.clean(F.col("text"), PLAIN).alias("text"))
        tokens = cleaned.select("doc_id", function(F.col("text")).alias("tokens"))
        # size of a null array is null here, as in SQL
        n = F.when(F.col("tokens").isNotNull(), F.size("tokens")).cast("bigint")
        return tokens.select("doc_id", F.array_join("tokens", " ").alias("tokens"), n.alias("n"))

    return query


check("k01_whitespace_tokens", tokens_sql(sql_split("text")))(on_tokens(K.tokenize_whitespace))
check("k02_word_tokens", tokens_sql(sql_word_split("text")))(on_tokens(K.tokenize_words))
check(
    "k03_token_length", tokens_sql(f"list_filter({sql_split('text')}, lambda w: length(w) BETWEEN 2 AND 50)")
)(on_tokens(lambda c: K.filter_length(K.tokenize_whitespace(c), 2, 50)))
STOPWORDS = ", ".join(map(quoted, settings.ENGLISH_STOPWORDS))
check(
    "k04_stopwords",
    tokens_sql(f"list_filter({sql_split('text')}, lambda w: NOT list_contains([{STOPWORDS}], w))"),
)(on_tokens(lambda c: K.remove_stopwords(K.tokenize_whitespace(c), settings.ENGLISH_STOPWORDS)))


@check("k08_join_tokens", f"SELECT doc_id, array_to_string({sql_word_split('text')}, ' ') AS text FROM ({CLEANED})")
def join_tokens(spark, folder):
    cleaned = snippet_docs(spark, folder).select("doc_id", C.clean(F.col("text"), PLAIN).alias("text"))
    return cleaned.select("doc_id", K.join_tokens(K.tokenize_words(F.col("text"))).alias("text"))


# ------------------------------------------------------------------ lemmas
def sql_lemmas(tokens: str) -> str:
    """CTEs ``vocab(term, cf)`` and ``lemmas(term, lemma)`` over a query with a ``tokens`` column."""
    rules = ", ".join(
        f"({i}, {quoted(end)}, {quoted(new)})" for i, (end, new) in enumerate(N.NOUN_ENDINGS, 1)
    )
    exceptions = ", ".join(f"({quoted(a)}, {quoted(b)})" for a, b in settings.NOUN_EXCEPTIONS)
    return f"""
    vocab AS (SELECT term, count(*) AS cf FROM (SELECT unnest(tokens) AS term FROM ({tokens})) GROUP BY term),
    lexicon AS (SELECT term AS form FROM vocab WHERE cf >= 2),
    irregular(term, form) AS (VALUES {exceptions}),
    rules(place, ending, replacement) AS (VALUES {rules}),
    tried AS (
      SELECT term, 1 AS round, [0] AS place, term AS form FROM vocab
      UNION ALL
      SELECT t.term, CASE WHEN t.place = [0] THEN 1 ELSE t.round + 1 END,
             CASE WHEN t.place = [0] THEN [r.place] ELSE list_append(t.place, r.place) END,
             substr(t.form, 1, length(t.form) - length(r.ending)) || r.replacement
      FROM tried t JOIN rules r ON suffix(t.form, r.ending)),
    regular AS (SELECT * FROM tried WHERE term NOT IN (SELECT term FROM irregular)),
    candidates AS (
      SELECT term, round, place, form FROM regular
      UNION ALL SELECT term, 1, [0], term FROM vocab WHERE term IN (SELECT term FROM irregular)
      UNION ALL SELECT i.term, 1, [1], i.form FROM irregular i JOIN vocab v ON v.term = i.term),
    best AS (
      SELECT term, form, row_number() OVER (PARTITION BY term ORDER BY round, length(form), place) AS nr
      FROM candidates WHERE form IN (SELECT form FROM lexicon)),
    lemmas AS (SELECT v.term, coalesce(b.form, v.term) AS lemma FROM vocab v
               LEFT JOIN best b ON b.term = v.term AND b.nr = 1)
    """


SNIPPET_TOKENS = sql_filtered(f"SELECT doc_id, text FROM ({SNIPPET_SQL})", PLAIN)
LEMMA_CTES = sql_lemmas(SNIPPET_TOKENS)


def tokens_of(spark, folder):
    return snippet_docs(spark, folder).select("doc_id", K.filtered_tokens(F.col("text"), PLAIN).alias("tokens"))


@check("k05_lemmas", f"WITH RECURSIVE {LEMMA_CTES} SELECT term, lemma FROM lemmas")
def lemmas(spark, folder):
    terms = N.distinct_terms(tokens_of(spark, folder), "tokens")
    return N.lemmatize(terms, N.corpus_lexicon(terms), N.default_exceptions(terms))


# ------------------------------------------------------------------ stems
def sql_shape(word: str) -> str:
    """Letters as c/v. Runs of y alternate, so left-to-right reduction decides each from its predecessor."""
    return (
        f"list_reduce(list_prepend('', string_split({word}, '')), lambda seen, ch: seen || CASE "
        "WHEN ch IN ('a','e','i','o','u') OR (ch = 'y' AND suffix(seen, 'c')) THEN 'v' ELSE 'c' END)"
    )


def cut(column: str, n: int) -> str:
    return f"substr({column}, 1, length({column}) - {n})"


CVC = "((suffix({s}, 'cvc') AND NOT regexp_matches({w}, '[wxy]$')) OR {s} = 'vc')"


def cvc(word: str, shape: str) -> str:
    return CVC.replace("{s}", shape).replace("{w}", word)


def ruled(rules, condition) -> str:
    branches = " ".join(
        f"WHEN suffix(w, {quoted(end)}) THEN CASE WHEN {condition(end)} THEN {cut('w', len(end))} || {quoted(new)} ELSE w END"
        for end, new in rules
    )
    return f"CASE {branches} ELSE w END"


def positive(end: str) -> str:
    return f"regexp_matches({cut('s', len(end))}, 'vc')"


def removable(end: str) -> str:
    test = f"regexp_matches({cut('s', len(end))}, 'vc+v+c')"
    return f"{test} AND regexp_matches({cut('w', 3)}, '[st]$')" if end == "ion" else test


ONE = "^c*v+c+v*$"
STEM, STEM_SHAPE = cut("w", 1), cut("s", 1)
STEM_STEPS = (
    f"CASE WHEN regexp_matches(w, '^.ies$') THEN {cut('w', 1)} ELSE {ruled(stemming.PLURAL_RULES, lambda _: 'true')} END",
    f"""CASE WHEN regexp_matches(w, '^.ied$') THEN {cut('w', 1)} WHEN suffix(w, 'ied') THEN {cut('w', 2)}
        WHEN suffix(w, 'eed') THEN CASE WHEN {positive('eed')} THEN {cut('w', 1)} ELSE w END
        WHEN suffix(w, 'ed') AND contains({cut('s', 2)}, 'v') THEN {cut('w', 2)} || '-'
        WHEN suffix(w, 'ing') AND contains({cut('s', 3)}, 'v') THEN {cut('w', 3)} || '-' ELSE w END""",
    f"""CASE WHEN NOT suffix(w, '-') THEN w
        WHEN regexp_matches({STEM}, '(at|bl|iz)$') THEN {STEM} || 'e'
        WHEN length(w) > 2 AND right({STEM}, 1) = substr(w, length(w) - 2, 1) AND suffix({STEM_SHAPE}, 'c')
          THEN CASE WHEN regexp_matches({STEM}, '[lsz]$') THEN {STEM} ELSE {cut('w', 2)} END
        WHEN regexp_matches({STEM_SHAPE}, '{ONE}') AND {cvc(STEM, STEM_SHAPE)} THEN {STEM} || 'e'
        ELSE {STEM} END""",
    f"CASE WHEN suffix(w, 'y') AND length(w) > 2 AND suffix({STEM_SHAPE}, 'c') THEN {STEM} || 'i' ELSE w END",
    f"CASE WHEN suffix(w, 'alli') AND {positive('alli')} THEN {cut('w', 2)} ELSE w END",
    f"""CASE WHEN suffix(w, 'logi') THEN CASE WHEN {positive('ogi')} THEN {STEM} ELSE w END
        ELSE {ruled(stemming.DOUBLE_SUFFIX_RULES, positive)} END""",
    ruled(stemming.ADJECTIVE_RULES, positive),
    ruled([(end, "") for end in stemming.REMOVED_SUFFIXES], removable),
    f"""CASE WHEN suffix(w, 'e') AND (regexp_matches({STEM_SHAPE}, 'vc+v+c')
        OR (regexp_matches({STEM_SHAPE}, '{ONE}') AND NOT {cvc(STEM, STEM_SHAPE)})) THEN {STEM} ELSE w END""",
    f"CASE WHEN suffix(w, 'll') AND regexp_matches({STEM_SHAPE}, 'vc+v+c') THEN {STEM} ELSE w END",
)


def sql_stems(terms: str) -> str:
    steps = f"SELECT term, lower(term) AS w FROM ({terms})"
    for step in STEM_STEPS:
        steps = f"SELECT term, {step} AS w FROM (SELECT term, w, {sql_shape('w')} AS s FROM ({steps}))"
    irregular = " ".join(f"WHEN {quoted(a)} THEN {quoted(b)}" for a, b in stemming.IRREGULAR_STEMS)
    return f"SELECT term, CASE WHEN length(term) <= 2 THEN lower(term) ELSE CASE lower(term) {irregular} ELSE w END END AS stem FROM ({steps})"


DISTINCT_TERMS = f"SELECT DISTINCT unnest(tokens) AS term FROM ({SNIPPET_TOKENS})"


@check("k06_stems", sql_stems(DISTINCT_TERMS))
def stems(spark, folder):
    return N.stem_terms(N.distinct_terms(tokens_of(spark, folder), "tokens"))


def mapped_sql(ctes: str, mapping: str, tokens: str, keys: str, out: str = "processed") -> str:
    return f"""
    WITH RECURSIVE {ctes}, toks AS ({tokens}),
    placed AS (SELECT {keys}, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM toks),
    swapped AS (SELECT {keys}, string_agg(m.new_term, ' ' ORDER BY pos) AS text
                FROM placed JOIN ({mapping}) m USING (term) GROUP BY {keys})
    SELECT {keys}, coalesce(s.text, '') AS {out} FROM toks LEFT JOIN swapped s USING ({keys})
    """


LEMMA_MAP = "SELECT term, lemma AS new_term FROM lemmas"
STEM_MAP = f"SELECT term, stem AS new_term FROM ({sql_stems(DISTINCT_TERMS)})"


@check("k07_lemma_precedence", mapped_sql(LEMMA_CTES, LEMMA_MAP, SNIPPET_TOKENS, "doc_id"))
def lemma_precedence(spark, folder):
    both = PLAIN.but(lemmatization=True, stemming=True)
    normal = N.normalize(tokens_of(spark, folder), "tokens", both, ["doc_id"])
    return normal.select("doc_id", K.join_tokens(F.col("tokens")).alias("processed"))


@check("k07_stems_in_place", mapped_sql("none AS (SELECT 1)", STEM_MAP, SNIPPET_TOKENS, "doc_id"))
def stems_in_place(spark, folder):
    stemmed = PLAIN.but(lemmatization=False, stemming=True)
    normal = N.normalize(tokens_of(spark, folder), "tokens", stemmed, ["doc_id"])
    return normal.select("doc_id", K.join_tokens(F.col("tokens")).alias("processed"))


@check("k09_process", mapped_sql(LEMMA_CTES, LEMMA_MAP, SNIPPET_TOKENS, "doc_id"))
def process(spark, folder):
    return N.process(snippet_docs(spark, folder), "text", settings.review_config())


TWEETS = settings.tweet_config()
MESSAGE_TOKENS = sql_filtered("SELECT conv_id, turn, text FROM conversations", TWEETS)


@check("k10_process_batch", mapped_sql(sql_lemmas(MESSAGE_TOKENS), LEMMA_MAP, MESSAGE_TOKENS, "conv_id, turn"))
def process_batch(spark, folder):
    return N.process_batch(table(spark, folder, "conversations"), "text", TWEETS, keys=["conv_id", "turn"])


EXPLAIN_SQL = f"""
SELECT doc_id, original, text AS after_cleaning, array_to_string(raw, ' ') AS tokens_raw,
       array_to_string({sql_keep('raw', PLAIN)}, ' ') AS tokens_normalized,
       array_to_string({sql_keep('raw', PLAIN)}, ' ') AS final
FROM (SELECT *, {sql_word_split('text')} AS raw FROM ({applied(
    f"SELECT doc_id, text AS original, text FROM ({SNIPPET_SQL})", clean_steps(PLAIN))}))
"""


@check("k11_explain", EXPLAIN_SQL)
def explain(spark, folder):
    steps = N.explain_steps(snippet_docs(spark, folder), "text", PLAIN)
    for column in ("tokens_raw", "tokens_normalized"):
        steps = steps.withColumn(column, F.array_join(column, " "))
    return steps


EXPLAIN_LEMMAS_SQL = f"""
WITH RECURSIVE {LEMMA_CTES},
steps AS (SELECT *, {sql_keep('raw', PLAIN)} AS tokens FROM (SELECT *, {sql_word_split('text')} AS raw FROM ({applied(
    f"SELECT doc_id, text AS original, text FROM ({SNIPPET_SQL})", clean_steps(PLAIN))}))),
placed AS (SELECT doc_id, unnest(tokens) AS term, generate_subscripts(tokens, 1) AS pos FROM steps),
swapped AS (SELECT doc_id, string_agg(lemma, ' ' ORDER BY pos) AS final FROM placed JOIN lemmas USING (term) GROUP BY doc_id)
SELECT doc_id, original, text AS after_cleaning, array_to_string(raw, ' ') AS tokens_raw,
       coalesce(final, '') AS tokens_normalized, coalesce(final, '') AS final
FROM steps LEFT JOIN swapped USING (doc_id)
"""


@check("k11_explain_with_lemmas", EXPLAIN_LEMMAS_SQL)
def explain_lemmas(spark, folder):
    steps = N.explain_steps(snippet_docs(spark, folder), "text", settings.review_config())
    for column in ("tokens_raw", "tokens_normalized"):
        steps = steps.withColumn(column, F.array_join(column, " "))
    return steps
