"""Predicates and labels on a ``", "``-separated category list."""

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The cuisines told apart, and the word every restaurant carries.
CUISINES = ("Thai", "Chinese", "Japanese", "Korean", "Indian", "American", "Caribbean",
            "Italian", "Mediterranean", "Mexican", "Vietnamese", "Cajun", "Greek")
RESTAURANT = "Restaurant"
OTHER = "Other"


def mentions_any(categories: str, words) -> Column:
    """True where the text contains one of ``words``, as a case-sensitive substring."""
    return reduce(or_, [F.col(categories).contains(w) for w in words], F.lit(False))


def first_category(categories: str, wanted=CUISINES, other: str = OTHER) -> Column:
    """The first listed category that equals a wanted word, else ``other``."""
    # A whole item between separators. Unlike a filter on the split list, this
    # takes part in code generation and stops at the first hit.
    words = "|".join(rf"\Q{w}\E" for w in wanted)
    hit = F.regexp_extract(categories, rf"(?:^|, )({words})(?=, |\z)", 1)
    return F.coalesce(F.nullif(hit, F.lit("")), F.lit(other))
