"""Joins, aggregates and trained models over DataFrames."""
from gridlore.operators.bayes import NaiveBayes, predict_nb, train_nb
from gridlore.operators.lemmas import build_lemma_dict, lemma_count, lemmatize, top_words
from gridlore.operators.proximity import (
    distance_join,
    near_ids,
    near_people,
    neighbor_count,
    pair_count,
)
from gridlore.operators.reviews import (
    clean_reviews,
    explode_categories,
    reviews_by_category,
    score_stats,
    user_category_stats,
    user_stats,
)
from gridlore.operators.skew import Limits, balanced_join, lookup, salted_join
from gridlore.operators.tagging import Tagger, tag_tokens, train_tagger
from gridlore.operators.tokens import drop_words, word_count

__all__ = [
    "NaiveBayes", "predict_nb", "train_nb", "build_lemma_dict", "lemma_count",
    "lemmatize", "top_words", "distance_join", "near_ids", "near_people",
    "neighbor_count", "pair_count", "clean_reviews", "explode_categories", "reviews_by_category",
    "score_stats", "user_category_stats", "user_stats", "Limits", "balanced_join",
    "lookup", "salted_join",
    "Tagger", "tag_tokens", "train_tagger", "drop_words", "word_count",
]
