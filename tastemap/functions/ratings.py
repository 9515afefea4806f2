"""Star ratings as labels and as colours."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def binarize_rating(rating, threshold: float = 4) -> Column:
    """1 from ``threshold`` up, else 0; NULL stays NULL.

    NaN counts as 0: Spark orders it above every number, which would make it 1.
    """
    stars = F.col(rating) if isinstance(rating, str) else rating
    good = (stars >= threshold) & ~F.isnan(stars)
    return F.when(stars.isNotNull(), F.when(good, 1).otherwise(0)).cast("int")


def hue(value: str, best: float = 5.0) -> Column:
    """Hue in degrees, from 0 (red) to 120 (green) at ``best``."""
    return F.col(value) * F.lit(120.0 / best)


def price_hue(price: str, most: int = 4) -> Column:
    """Hue of a price point such as ``$$``, from 0 to 120 at ``most`` signs.

    NULL for anything but 1 to ``most`` signs.
    """
    return F.when(F.col(price).rlike(rf"\A\${{1,{most}}}\z"),
                  F.length(price) * F.lit(120.0 / most))


def category_hue(category: str, categories) -> Column:
    """Hue of a category by its place among ``categories``, from 0 to 120 at the last.

    NULL for a category that is not listed.
    """
    place = F.array_position(F.array(*map(F.lit, categories)), F.col(category))
    step = F.lit(120.0 / max(1, len(categories) - 1))
    return F.when(place > 0, (place - 1) * step)
