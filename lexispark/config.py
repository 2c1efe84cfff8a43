"""Settings for cleaning, vectorizing and training. They only describe; the operators build plans from them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from types import MappingProxyType
from typing import Any

# Contraction -> expansion, replaced one after the other in this order.
CONTRACTIONS: tuple[tuple[str, str], ...] = (
    ("won't", "will not"),
    ("can't", "cannot"),
    ("n't", " not"),
    ("'re", " are"),
    ("'s", " is"),
    ("'d", " would"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
    ("it's", "it is"),
    ("i'm", "i am"),
    ("don't", "do not"),
    ("doesn't", "does not"),
    ("didn't", "did not"),
    ("isn't", "is not"),
    ("aren't", "are not"),
    ("wasn't", "was not"),
    ("weren't", "were not"),
    ("haven't", "have not"),
    ("hasn't", "has not"),
    ("hadn't", "had not"),
    ("wouldn't", "would not"),
    ("couldn't", "could not"),
    ("shouldn't", "should not"),
    ("mustn't", "must not"),
)

# The English stopword list commonly used in text preprocessing.
ENGLISH_STOPWORDS: tuple[str, ...] = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
    he him his himself she she's her hers herself it it's its itself they them their theirs themselves
    what which who whom this that that'll these those am is are was were be been being
    have has had having do does did doing a an the and but if or because as until while
    of at by for with about against between into through during before after above below
    to from up down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too very
    s t can will just don don't should should've now d ll m o re ve y
    ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't
    isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't
    wasn wasn't weren weren't won won't wouldn wouldn't
    he'd he'll he's i'd i'll i'm i've it'd it'll she'd she'll they'd they'll they're they've
    we'd we'll we're we've
    """.split()
)

# Irregular noun plurals and their singular, the default exception table of the lemmatizer.
NOUN_EXCEPTIONS: tuple[tuple[str, str], ...] = (
    ("children", "child"),
    ("feet", "foot"),
    ("geese", "goose"),
    ("men", "man"),
    ("mice", "mouse"),
    ("oxen", "ox"),
    ("teeth", "tooth"),
    ("women", "woman"),
    ("knives", "knife"),
    ("lives", "life"),
    ("wives", "wife"),
    ("analyses", "analysis"),
    ("crises", "crisis"),
    ("criteria", "criterion"),
    ("phenomena", "phenomenon"),
)


@dataclass(frozen=True)
class CleanConfig:
    """What to do with one text column, from raw text to normalized tokens."""

    domain: str = "generic"
    lowercase: bool = True
    expand_contractions: bool = True
    contractions: tuple[tuple[str, str], ...] = CONTRACTIONS
    remove_html: bool = True
    remove_urls: bool = True
    remove_mentions: bool = False
    remove_hashtags: bool = False
    remove_numbers: bool = False
    remove_punctuation: bool = True
    tokenizer: str = "word"
    min_token_length: int = 2
    max_token_length: int = 50
    remove_stopwords: bool = True
    stopwords: tuple[str, ...] = ENGLISH_STOPWORDS
    lemmatization: bool = True
    stemming: bool = False

    def __post_init__(self):
        if self.tokenizer not in ("word", "whitespace"):
            raise ValueError(f"Unknown tokenizer: {self.tokenizer}")
        if self.tokenizer == "word" and not self.remove_punctuation:
            raise ValueError("The word tokenizer works on text without punctuation; use tokenizer='whitespace'")

    def but(self, **changes) -> CleanConfig:
        return replace(self, **changes)


def default_config() -> CleanConfig:
    return CleanConfig()


def review_config() -> CleanConfig:
    """Long reviews: markup and URLs go, numbers and mentions stay."""
    return CleanConfig(domain="reviews")


def tweet_config() -> CleanConfig:
    """Short messages: mentions and numbers go, hashtag words stay, markup is not expected."""
    return CleanConfig(domain="tweets", remove_html=False, remove_mentions=True, remove_numbers=True)


@dataclass(frozen=True)
class VectorConfig:
    """Analyzer and vocabulary pruning. ``max_features=None`` keeps every term that survives the df bounds."""

    max_features: int | None = 1_000_000
    min_df: int = 2
    max_df: float = 0.95
    ngram_range: tuple[int, int] = (1, 1)
    lowercase: bool = True
    strip_accents: str | None = "unicode"

    def __post_init__(self):
        object.__setattr__(self, "ngram_range", tuple(self.ngram_range))
        lo, hi = self.ngram_range
        if not 1 <= lo <= hi:
            raise ValueError(f"Invalid ngram_range: {self.ngram_range}")
        if self.strip_accents not in ("unicode", "ascii", None):
            raise ValueError(f"Unknown strip_accents: {self.strip_accents}")


def _default_classifiers() -> Mapping[str, Mapping[str, Any]]:
    return MappingProxyType(
        {
            "logistic_regression": {"C": 1.0, "max_iter": 1000},
            "svm": {"C": 1.0, "max_iter": 1000},
            "random_forest": {"n_estimators": 100, "max_depth": 10},
        }
    )


@dataclass(frozen=True)
class TrainConfig:
    """One training run: split, vectorizer and the models to fit."""

    random_state: int = 42
    test_size: float = 0.2
    vectorizer: str = "tfidf"
    vectorizer_config: VectorConfig = field(default_factory=lambda: VectorConfig(max_features=5000))
    classifiers: Mapping[str, Mapping[str, Any]] = field(default_factory=_default_classifiers)

    @classmethod
    def from_mapping(cls, settings: Mapping[str, Any]) -> TrainConfig:
        """Build from a parsed YAML/JSON training file; unknown keys are an error, not silently dropped."""
        values = dict(settings)
        if "vectorizer_config" in values:
            values["vectorizer_config"] = VectorConfig(**values["vectorizer_config"])
        return cls(**values)
