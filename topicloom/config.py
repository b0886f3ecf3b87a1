"""Job configuration (ML-15): one frozen dataclass per model, defaults as the
reference's model config sets them."""

from __future__ import annotations

from dataclasses import dataclass, field

from topicloom.operators.tfidf import TfidfConfig


@dataclass(frozen=True)
class TopicModelConfig:
    algorithm: str = "nmf"
    n_topics: int = 6
    random_state: int = 42
    max_iter: int = 500
    tol: float = 1e-4
    top_n_keywords: int = 8
    text_column: str = "topic_text"
    window_days: int = 3
    tfidf: TfidfConfig = field(default_factory=TfidfConfig)


@dataclass(frozen=True)
class ClassifierConfig:
    text_column: str = "headline_clean"
    target_column: str = "category"
    test_size: float = 0.2
    random_state: int = 42
    max_iter: int = 1000
    tfidf: TfidfConfig = field(
        default_factory=lambda: TfidfConfig(max_features=5000, min_df=1, max_df=1.0, ngram_min=1, ngram_max=2, stop_words=False)
    )
