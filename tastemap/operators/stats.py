"""Statistics by group and classification quality."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.operators.ranking import value_statistics

# Each of these keeps a few numbers per group and is combined before the shuffle.
STATS = {
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "stddev": F.stddev,
    "count": F.count,
    "approx_median": lambda value: F.percentile_approx(value, 0.5),
}


def stats_by(df: DataFrame, key: str, value: str, stats=("avg",)) -> DataFrame:
    """Statistics of ``value`` per group from one reading of ``df``.

    ``stats`` lists names, or maps output columns to names. Without the exact
    ``median`` that is one aggregation. The median needs ranks, so all statistics
    then come from counts of equal values; ``approx_median``, a sketch of fixed
    size, does not go with it.
    """
    named = stats if isinstance(stats, dict) else {s: s for s in stats}
    unknown = set(named.values()) - set(STATS) - {"median"}
    if unknown:
        raise ValueError(f"unknown statistics: {', '.join(sorted(unknown))}")
    if "median" not in named.values():
        return df.groupBy(key).agg(*(STATS[s](F.col(value)).alias(out)
                                     for out, s in named.items()))
    if "approx_median" in named.values():
        raise ValueError("median and approx_median together: ask for one of them")
    return value_statistics(df, key, value, named)


def weighted_mean_by(df: DataFrame, key: str, total: str, count: str, name: str) -> DataFrame:
    """Mean over the underlying rows, from a sum and a count per row."""
    return df.groupBy(key).agg((F.sum(total) / F.nullif(F.sum(count), F.lit(0))).alias(name))


def weighted_f1(df: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """F1 per class weighted by class support, beside what always guessing the
    commonest class would score.

    One pass counts the pairs; the rest works on one row per pair. Rows
    without a label or a prediction are left out.
    """
    pairs = (df.groupBy(F.col(label).cast("double").alias("label"),
                        F.col(prediction).cast("double").alias("prediction"))
               .agg(F.count(F.lit(1)).alias("n")))
    # No filter: it would be pushed down and make every prediction twice.
    n = F.when(F.col("label").isNotNull() & F.col("prediction").isNotNull(), F.col("n"))
    hits = F.when(F.col("label") == F.col("prediction"), n)
    none = F.lit(None).cast("bigint")
    roles = F.array(
        F.struct(F.col("label").alias("class"), n.alias("support"),
                 none.alias("predicted"), hits.alias("hits")),
        F.struct(F.col("prediction").alias("class"), none.alias("support"),
                 n.alias("predicted"), none.alias("hits")))
    classes = (pairs.select(F.inline(roles)).groupBy("class")
               .agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c)
                      for c in ("support", "predicted", "hits"))))
    share = (F.col("support") * 2 * F.col("hits")
             / F.nullif(F.col("support") + F.col("predicted"), F.lit(0)))
    rows, most = F.nullif(F.sum("support"), F.lit(0)), F.max("support")
    return classes.agg((F.sum(share) / rows).alias("f1"),
                       (most / rows * 2 * most / (most + rows)).alias("majority_f1"))
