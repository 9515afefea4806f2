"""Row filters made of plain predicates, so that they reach the scan."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.functions.categories import CUISINES, RESTAURANT, mentions_any


def filter_categories(df: DataFrame, categories: str = "categories",
                      required: str = RESTAURANT, wanted=CUISINES) -> DataFrame:
    """Rows whose category text contains ``required`` and one of ``wanted``."""
    return df.where(F.col(categories).contains(required) & mentions_any(categories, wanted))


def filter_points(df: DataFrame, prices=None, price_range=None, postal_code=None,
                  category=None, *, price_col: str = "price",
                  postal_code_col: str = "postal_code",
                  categories_col: str = "categories") -> DataFrame:
    """Rows that meet every filter given: price points, price range, ZIP, category text."""
    if prices is not None:
        df = df.where(F.col(price_col).isin(*prices))
    if price_range is not None:
        df = df.where(F.col(price_col).between(*price_range))
    if postal_code is not None:
        df = df.where(F.col(postal_code_col) == postal_code)
    if category is not None:
        df = df.where(F.col(categories_col).contains(category))
    return df
