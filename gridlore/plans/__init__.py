"""Whole reports, put together from the operators."""
from gridlore.plans.annotations import (
    annotate_reviews,
    review_lemmas,
    review_vocabulary,
    text_features,
    top_lemmas,
)
from gridlore.plans.fitted import Fit, FittedPipeline, fit_pipeline, load_model, load_pipeline
from gridlore.plans.sentiment import (
    predict_sentiment,
    sentiment_words,
    title_sentiment,
    title_stats,
    train_sentiment,
)

__all__ = [
    "annotate_reviews", "review_lemmas", "review_vocabulary", "text_features", "top_lemmas",
    "Fit", "FittedPipeline", "fit_pipeline", "load_model", "load_pipeline",
    "predict_sentiment", "sentiment_words", "title_sentiment", "title_stats", "train_sentiment",
]
