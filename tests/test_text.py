"""Cleaning, tokens, lemmas and stems against hand-made results and plain Python."""

import random
import re
import string
import unicodedata
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexispark import config as C
from lexispark.functions import accents, analyzer, clean, stemming, tokens
from lexispark.operators import normalize, vocabulary
from lexispark.streaming.text_stream import process_stream


def one(spark, function, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    return [r[0] for r in df.orderBy("id").select(function(F.col("text"))).collect()]


def python_clean(text, cfg):
    if cfg.lowercase:
        text = text.lower()
    if cfg.expand_contractions:
        for short, long in cfg.contractions:
            text = text.replace(short, long)
    steps = [
        (cfg.remove_html, r"<[^>]+>"),
        (cfg.remove_html, r"&[a-z]+;"),
        (cfg.remove_urls, r"https?://\S+|www\.\S+"),
        (cfg.remove_mentions, r"@\w+"),
        (cfg.remove_hashtags, r"#\w+"),
        (not cfg.remove_hashtags, "#"),
        (cfg.remove_numbers, r"\b\d+\b"),
        (cfg.remove_punctuation, r"[^\w\s]"),
        (True, r"\s+"),
    ]
    for on, pattern in steps:
        text = re.sub(pattern, " ", text) if on else text
    return text.strip()


CONFIGS = [
    C.review_config(),
    C.tweet_config(),
    C.default_config().but(remove_hashtags=True, remove_numbers=True, remove_mentions=True),
    C.default_config().but(remove_punctuation=False, tokenizer="whitespace", lowercase=False),
]
PIECES = ["I'm", "don't", "<br/>", "&amp;", "&#39;", "http://a.b/c?d=1", "www.x.y", "@me_1", "#tag", "42", "x9", "3.14",
          "é", "Straße", "naïve", "日本", "_a_", " ", " ", "\n", "\t", "won't", "cannot", "it's", "!", "...", "<", ">", "&"]


@pytest.mark.parametrize("cfg", CONFIGS, ids=["review", "tweet", "all", "raw"])
def test_clean_equals_python(spark, cfg):
    rng = random.Random(7)
    texts = ["".join(rng.choice(PIECES) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    assert one(spark, lambda c: clean.clean(c, cfg), *texts) == [python_clean(t, cfg) for t in texts]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.sampled_from(string.printable + "éß日  '#@&<>"), max_size=40), min_size=1, max_size=20))
def test_clean_of_any_text(spark, texts):
    cfg = C.default_config().but(remove_numbers=True, remove_mentions=True)
    assert one(spark, lambda c: clean.clean(c, cfg), *texts) == [python_clean(t, cfg) for t in texts]


def test_single_steps(spark):
    assert one(spark, clean.strip_numbers, "5 x9 9x 3.14 é5 5é 42") == ["  x9 9x  .  é5 5é  "]
    assert one(spark, clean.strip_entities, "&amp; &AMP; &#39;") == ["  &AMP; &#39;"]
    assert one(spark, clean.blank_guard, None, "  \n", "a ") == ["", "", "a "]


def test_contractions_keep_their_order(spark):
    result = one(spark, lambda c: clean.expand_contractions(c, C.CONTRACTIONS), "won't can't don't john's Won't")
    assert result == ["will not cannot do not john is Wo not"]


def test_word_tokens(spark):
    texts = ["i cannot wanna go", "Cannot cannots gonna_ xgonna lemme gimme gotta"]
    assert one(spark, tokens.tokenize_words, *texts) == [
        ["i", "can", "not", "wan", "na", "go"],
        ["Can", "not", "cannots", "gonna_", "xgonna", "lem", "me", "gim", "me", "got", "ta"],
    ]


def test_term_bag_counts(spark):
    texts = ["b a b c a b", "", "x"]
    bags = one(spark, lambda c: tokens.term_bag(tokens.tokenize_whitespace(c)), *texts)
    assert [{r["term"]: r["tf"] for r in bag} for bag in bags] == [dict(Counter(t.split())) for t in texts]


def test_accents_fold_like_the_unicode_database(spark):
    texts = ["Café ﬁne ½ ", "가나 각", "𝐀𝐁 İ ﷺ", "plain", "ÀÉÎÕÜ ñ ß ø Ł", "é"]
    fold = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    assert one(spark, accents.fold_accents, *texts) == [fold(t) for t in texts]
    ascii_only = one(spark, lambda c: accents.fold_accents(c, "ascii"), *texts)
    assert ascii_only == [fold(t).encode("ascii", "ignore").decode() for t in texts]


def test_analyzer_and_ngrams(spark):
    cfg = C.VectorConfig(ngram_range=(1, 3))
    assert one(spark, lambda c: analyzer.analyze(c, cfg), "A bc Dé fg", "x", None) == [
        ["bc", "de", "fg", "bc de", "de fg", "bc de fg"],
        [],
        [],
    ]


STEMS = dict(
    caresses="caress", ponies="poni", dies="die", cats="cat", feed="feed", agreed="agre", plastered="plaster",
    motoring="motor", sing="sing", conflated="conflat", troubled="troubl", sized="size", hopping="hop", falling="fall",
    hissing="hiss", fizzed="fizz", failing="fail", filing="file", happy="happi", sky="sky", enjoy="enjoy", cried="cri",
    tied="tie", relational="relat", conditional="condit", valenci="valenc", digitizer="digit", radically="radic",
    hopefulness="hope", formality="formal", sensibility="sensibl", triplicate="triplic", formative="form",
    electrical="electr", goodness="good", revival="reviv", allowance="allow", inference="infer", adjustable="adjust",
    replacement="replac", adoption="adopt", communism="commun", activate="activ", effective="effect", probate="probat",
    rate="rate", cease="ceas", controll="control", roll="roll", geology="geolog", dying="die", news="news", at="at",
    by="by", say="say", generalizations="gener", oscillators="oscil",
)


def test_stems(spark):
    found = one(spark, stemming.stem, *STEMS)
    assert dict(zip(STEMS, found)) == STEMS


def lemma_map(spark, terms, lexicon, exceptions=()):
    terms_df = spark.createDataFrame([(t,) for t in terms], "term string")
    lexicon_df = spark.createDataFrame([(t,) for t in lexicon], "form string")
    exceptions_df = spark.createDataFrame(list(exceptions), "term string, form string")
    return {r["term"]: r["lemma"] for r in normalize.lemmatize(terms_df, lexicon_df, exceptions_df).collect()}


def test_lemmas(spark):
    lexicon = ["city", "box", "boxe", "wolf", "man", "church", "glass", "class", "as", "foot", "unknow"]
    terms = ["cities", "boxes", "wolves", "men", "churches", "glass", "classes", "as", "feet", "zzzs", "unknowsss"]
    expected = ["city", "box", "wolf", "man", "church", "glass", "class", "as", "foot", "zzzs", "unknow"]
    assert lemma_map(spark, terms, lexicon, [("feet", "foot")]) == dict(zip(terms, expected))
    # an exception replaces the rules, also when none of its forms is known
    assert lemma_map(spark, ["boxes"], ["box"], [("boxes", "boxen")]) == {"boxes": "boxes"}


def test_tweet_example(spark):
    df = spark.createDataFrame([(1, "@user Check this out! https://t.co/abc #NLP is great"), (2, None), (3, " ")], "doc_id int, text string")
    lexicon = spark.createDataFrame([("check",)], "form string")
    processed = normalize.process(df, "text", C.tweet_config(), lexicon=lexicon)
    assert sorted(map(tuple, processed.collect())) == [(1, "check nlp great"), (2, ""), (3, "")]


def test_review_example(spark):
    df = spark.createDataFrame([(1, "This product is <b>amazing</b>! Won't buy anything else.")], "doc_id int, text string")
    plain = C.review_config().but(lemmatization=False)
    assert normalize.process(df, "text", plain).first()["processed"] == "product amazing buy anything else"


def test_lemmas_win_over_stems(spark):
    df = spark.createDataFrame([(1, "running boxes boxes box box")], "doc_id int, text string")
    both = C.default_config().but(stemming=True)
    assert normalize.process(df, "text", both).first()["processed"] == "running box box box box"
    stems = both.but(lemmatization=False)
    assert normalize.process(df, "text", stems).first()["processed"] == "run box box box box"


def test_explain_has_no_blank_guard(spark):
    df = spark.createDataFrame([(1, "Don't <b>stop</b>"), (2, None)], "doc_id int, text string")
    steps = {r["doc_id"]: r for r in normalize.explain_steps(df, "text", C.default_config()).collect()}
    assert steps[1]["after_cleaning"] == "do not stop"
    assert steps[1]["tokens_raw"] == ["do", "not", "stop"] and steps[1]["tokens_normalized"] == ["stop"]
    assert steps[1]["final"] == "stop" and steps[2]["after_cleaning"] is None


def test_config_errors():
    with pytest.raises(ValueError):
        C.CleanConfig(tokenizer="sentence")
    with pytest.raises(ValueError):
        C.CleanConfig(remove_punctuation=False)
    with pytest.raises(ValueError):
        C.VectorConfig(ngram_range=[2, 1])
    cfg = C.TrainConfig.from_mapping({"vectorizer": "bow", "vectorizer_config": {"ngram_range": [1, 2]}})
    assert cfg.vectorizer_config.ngram_range == (1, 2) and cfg.test_size == 0.2
    with pytest.raises(TypeError):
        C.TrainConfig.from_mapping({"unknown": 1})


def test_stream_is_processed_like_a_batch(spark, tmp_path):
    cfg = C.tweet_config().but(lemmatization=False)
    batch = spark.createDataFrame([(1, "@a Good #day 12"), (2, None)], "doc_id int, text string")
    batch.write.parquet(str(tmp_path / "in"))
    stream = process_stream(spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in")), "text", cfg)
    query = stream.writeStream.format("memory").queryName("texts").trigger(availableNow=True).start()
    query.awaitTermination()
    streamed = spark.table("texts").select("doc_id", "processed")
    assert sorted(map(tuple, streamed.collect())) == [(1, "good day"), (2, "")]
    with pytest.raises(ValueError):
        process_stream(batch, "text", C.tweet_config())


def test_counted_bags_and_terms_equal_the_bags(spark, monkeypatch):
    """Counts made for many rows at once: empty and null arrays, copies, rows beyond one part; sums leave a task's first step."""
    monkeypatch.setattr(tokens, "COUNTED_ROWS", 3)
    rows = [["b", "a", "b"], [], None, ["ä", ""], ["b"], ["b", "a", "b"], ["x"] * 5, None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, t array<string>").coalesce(1)
    bags = {r[0]: sorted(map(tuple, r[1])) for r in df.select("i", tokens.counted_bag(F.col("t"))).collect()}
    assert bags == {i: sorted(Counter(r or []).items()) for i, r in enumerate(rows)}
    found = vocabulary.counted_terms(df, F.col("t"))
    want = [(t, sum(t in (r or []) for r in rows), sum((r or []).count(t) for r in rows)) for t in {t for r in rows for t in r or []}]
    assert sorted(map(tuple, found.collect())) == sorted(want)
    assert vocabulary.counted_terms(df.limit(0), F.col("t")).count() == 0
