"""Column expressions, built from Spark's own functions only."""
from gridlore.functions.categories import category_list
from gridlore.functions.geometry import cell_width, distance, grid_cell
from gridlore.functions.stopwords import ENGLISH_STOP_WORDS, stop_words
from gridlore.functions.words import (
    NEGATORS,
    clean_words,
    mark_negation,
    normalize_tokens,
    remove_stopwords,
    tokenize,
)

__all__ = [
    "category_list", "cell_width", "distance", "grid_cell", "ENGLISH_STOP_WORDS",
    "stop_words", "NEGATORS", "clean_words", "mark_negation", "normalize_tokens",
    "remove_stopwords", "tokenize",
]
