"""Parsing of category lists that are stored as text."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def category_list(categories: Column) -> Column:
    """Categories in a string such as ``['A', 'B']``.

    Brackets and apostrophes go, and every ``", "`` separates, also one inside
    a name. Empty names and the word ``null`` are left out.
    """
    names = F.split(F.regexp_replace(categories, r"[\[\]']", ""), ", ")
    return F.filter(names, lambda name: ~name.isin("", "null"))
