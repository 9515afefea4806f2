"""Medians from stored sketches: one per group and part, merged when a question is asked.

The exact median counts all rows anew for each question. A KLL sketch of a group is a few
kilobytes however many rows it stands for, sketches of parts add up to that of the whole,
and a part that comes later only adds its own.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size parameter of the sketches, and the share of rows by which a rank may be off.
K = 1024


def rank_error(k: int = K) -> float:
    """Share of rows by which the rank of one quantile is off at most, in 99 of 100 cases.

    The bound that the authors of the sketch publish for single ranks.
    """
    return 2.296 / k ** 0.9723


def quantile_sketches(df: DataFrame, groups: list[str], value: str, parts: list[str] = (),
                      k: int = K) -> DataFrame:
    """``groups, parts, sketch``: to be stored, and to be added to as parts come.

    ``parts`` are what later questions choose by, such as a day or a batch. Partial
    sketches meet in the shuffle, so a group with a third of all rows moves a few kilobytes
    a task. NULL and NaN values are not counted; a group of nothing else has an empty sketch.
    """
    number = F.col(value).cast("double")
    return df.groupBy(*groups, *parts).agg(F.kll_sketch_agg_double(
        F.when(~F.isnan(number), number), F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, groups: list[str],
                     ranks: dict[str, float] | None = None) -> DataFrame:
    """``groups``, ``n`` and a column for each of ``ranks``, the median by default.

    Of the parts that ``sketches`` still has, whatever they were cut by. Ranks 0 and 1 are
    the exact least and greatest values. Without values quantiles are NULL.
    """
    ranks = {"median": 0.5} if ranks is None else ranks
    merged = sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    n = F.kll_sketch_get_n_double("sketch")
    held = F.when(n > 0, F.col("sketch"))
    return merged.select(*groups, n.alias("n"), *(
        F.kll_sketch_get_quantile_double(held, F.lit(float(r))).alias(name)
        for name, r in ranks.items()))


def rank_misses(df: DataFrame, groups: list[str], value: str, found: DataFrame, column: str,
                rank: float = 0.5) -> DataFrame:
    """``groups, miss``: by which share of rows ``column`` of ``found`` misses its ``rank``.

    Zero where the values equal to it span the rank. One reading of ``df``, counts only.
    """
    number = F.col(value).cast("double")
    rows = df.where(number.isNotNull() & ~F.isnan(number)).select(*groups, number.alias("_value"))
    counted = rows.join(found.select(*groups, F.col(column).alias("_found")), groups).groupBy(
        *groups).agg(F.avg((F.col("_value") < F.col("_found")).cast("int")).alias("_below"),
                     F.avg((F.col("_value") <= F.col("_found")).cast("int")).alias("_upto"))
    return counted.select(*groups, _outside("_below", "_upto", rank).alias("miss"))


def _outside(low: str, high: str, at: float) -> Column:
    return F.greatest(F.col(low) - at, at - F.col(high), F.lit(0.0))
