"""Map points."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.functions.geo import address_line, mercator_x, mercator_y
from tastemap.functions.ratings import category_hue, hue, price_hue


def map_points(df: DataFrame, *, name: str = "name",
               address=("address", "city", "state", "postal_code"),
               rating: str = "stars", sentiment: str = "predicted_sentiment",
               longitude: str = "longitude", latitude: str = "latitude",
               colour_by: str | None = None, colour_best: float = 5.0,
               colour_kind: str = "number", colour_categories=(),
               keep=()) -> DataFrame:
    """One point per row: position in metres, label, address, scores and hue.

    The hue follows the rating unless ``colour_by`` names another column: by
    ``colour_kind`` a ``number`` whose greenest value is ``colour_best``, a ``price``
    of dollar signs, of which ``colour_best`` are greenest, or a ``category`` by its
    place among ``colour_categories``.
    """
    colour_by = colour_by or rating
    if colour_kind == "number":
        colour = hue(colour_by, colour_best)
    elif colour_kind == "price":
        colour = price_hue(colour_by, int(colour_best))
    elif colour_kind == "category":
        colour = category_hue(colour_by, colour_categories)
    else:
        raise ValueError(f"colour_kind must be number, price or category, not {colour_kind}")
    return df.select(
        *keep,
        mercator_x(longitude).alias("x"),
        mercator_y(latitude).alias("y"),
        F.col(name).alias("name"),
        address_line(*address).alias("addr"),
        F.col(rating).alias("rating"),
        F.col(sentiment).alias("sentiment"),
        colour.alias("hue"),
    )
