"""From text to arrays of words."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlore.functions.stopwords import ENGLISH_STOP_WORDS

# Words that turn the meaning of what follows, in the form that
# ``normalize_tokens`` gives them.
NEGATORS = (
    "no", "not", "nor", "never", "cannot",
    "aint", "arent", "cant", "couldnt", "didnt", "doesnt", "dont", "hadnt",
    "hasnt", "havent", "isnt", "mustnt", "shouldnt", "wasnt", "werent", "wont",
    "wouldnt",
)
_ENDS = "[.,;:!?]"
_OPEN = "\x01"
NOT_LETTERS = r"[^\pL+]"


def _present(words: Column) -> Column:
    return F.array_remove(words, "")


def tokenize(text: Column, pattern: str = r"\s+") -> Column:
    """Pieces of ``text`` between matches of ``pattern``, empty ones left out."""
    return _present(F.split(text, pattern))


def normalize_tokens(tokens: Column, drop: str = NOT_LETTERS) -> Column:
    """Lower-case tokens without the characters that match ``drop``."""
    return _present(F.transform(tokens, lambda t: F.lower(F.regexp_replace(t, drop, ""))))


def clean_words(text: Column) -> Column:
    """The same words as ``normalize_tokens(tokenize(text))``.

    The whole text is cleaned at once, which is cheaper than one regular
    expression per token.
    """
    letters = F.lower(F.regexp_replace(text, r"[^\pL+\s]+", ""))
    return _present(F.split(letters, r"\s+"))


def remove_stopwords(
    tokens: Column, words: Sequence[str] = ENGLISH_STOP_WORDS, case_sensitive: bool = False
) -> Column:
    """Tokens that are not in ``words``."""
    if case_sensitive:
        return F.filter(tokens, lambda t: ~t.isin(*words))
    lowered = sorted({word.lower() for word in words})
    return F.filter(tokens, lambda t: ~F.lower(t).isin(*lowered))


def mark_negation(
    text: Column,
    negators: Sequence[str] = NEGATORS,
    drop_words: Sequence[str] = (),
) -> Column:
    """Normalized words of ``text``, with ``not_`` before each negated one.

    A token that ends in ``. , ; : ! ?`` closes a segment. Inside a segment
    each negator, itself kept as it is, switches negation on or off for the
    words after it. ``drop_words`` are left out afterwards, negated or not.
    """
    # Keep letters, blanks, and the marks at the end of a token.
    kept = F.regexp_replace(text, rf"[^\pL+\s]*({_ENDS})(?=\s|\z)|[^\pL+\s]+", "$1")
    # Each negator stands for itself, whatever characters it has.
    quoted = "|".join(rf"\Q{word}\E" for word in negators)
    opened = F.regexp_replace(
        F.concat(F.lit(" "), F.lower(kept)), rf"(?<=\s)(?=(?:{quoted})(?:\s|{_ENDS}|\z))", _OPEN
    )

    def mark_piece(piece: Column, number: Column) -> Column:
        # A piece after the first starts with the negator that opens it. The
        # words after the negator are negated in every other piece.
        marked = F.regexp_replace(piece, r"(?<=\s)(?=\S)", "not_")
        return F.when(number % 2 == 1, marked).otherwise(piece)

    def mark_segment(segment: Column) -> Column:
        marked = F.array_join(F.transform(F.split(segment, _OPEN), mark_piece), "")
        return F.when(segment.contains(_OPEN), marked).otherwise(segment)

    def mark_text(whole: Column) -> Column:
        segments = F.transform(F.split(whole, _ENDS), mark_segment)
        return F.when(whole.contains(_OPEN), F.array_join(segments, " ")).otherwise(whole)

    # One-element arrays, so that the text is worked out once and used twice.
    marked = F.transform(F.array(opened), mark_text)[0]
    words = _present(F.split(marked, rf"(?:\s|{_ENDS})+"))
    if not drop_words:
        return words
    dropped = sorted({prefix + word for word in drop_words for prefix in ("", "not_")})
    return F.filter(words, lambda word: ~word.isin(*dropped))
