"""Exact ranks without sorting a group, or the whole table, in one task.

The values are range-partitioned into slices, so that one hot group spreads
over as many slices as it needs. Slice totals, one row per group and slice,
tell which slice holds a wanted rank; only that slice is looked into. The
slices are written out first: range bounds come from a sample, and numbering
them anew after a lost executor would mix two numberings. So these functions
run jobs when called; what they return is lazy as usual.
"""

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.sources.durable import durable


def range_slices(df: DataFrame, *order: str) -> DataFrame:
    return durable(df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))


def value_statistics(df: DataFrame, key: str, value: str, stats: dict[str, str]) -> DataFrame:
    """Statistics of the non-NULL values of each group from one reading of ``df``.

    ``stats`` maps output columns to ``avg``, ``min``, ``max``, ``stddev``,
    ``count`` or the exact ``median``; NULL is a group too. Equal values collapse to
    counts, which hold all of these; the source is not read again.
    """
    counts = (df.groupBy(F.col(key).alias("k"), F.col(value).alias("v"))
                .agg(F.count(F.lit(1)).alias("n")))
    slices = range_slices(counts, "k", "v")
    n = F.when(F.col("v").isNotNull(), F.col("n"))
    x = F.col("v").cast("double")
    # One row per group and slice. Written out, it has a known size: for few groups
    # Spark broadcasts it and drops all but the wanted slices before the next shuffle.
    group = Window.partitionBy("k")
    parts = durable(
        slices.groupBy("k", "_slice")
        .agg(F.coalesce(F.sum(n), F.lit(0)).alias("rows"), F.sum(x * n).alias("sum"),
             F.min("v").alias("least"), F.max("v").alias("most"))
        .withColumn("_upto", F.sum("rows").over(group.orderBy("_slice")))
        .withColumn("total", F.sum("rows").over(group))
        .withColumn("mean", F.sum("sum").over(group) / F.nullif("total", F.lit(0))))
    plain = {"avg": F.first("mean"), "min": F.min("least"), "max": F.max("most"),
             "count": F.first("total")}
    found = parts.groupBy("k").agg(*(plain[s].alias(out) for out, s in stats.items()
                                     if s in plain), F.first("total").alias("_total"))
    # Values without NULL, beside what their group or slice says of them.
    values = slices.where(F.col("v").isNotNull()).withColumnsRenamed({"k": "vk", "_slice": "vs"})
    for out, stat in stats.items():
        if stat == "stddev":
            means = parts.groupBy("k").agg(F.first("mean").alias("mean"))
            off = F.col("v").cast("double") - F.col("mean")
            more = (values.join(means, F.col("vk").eqNullSafe(F.col("k")))
                    .groupBy("vk").agg((F.sum(off * off * F.col("n"))).alias("_squares")))
            spread = F.sqrt(F.col("_squares") / F.nullif(F.col("_total") - 1, F.lit(0)))
            found = (found.join(more, F.col("k").eqNullSafe(F.col("vk")), "left")
                     .withColumn(out, spread).drop("vk", "_squares"))
        elif stat == "median":
            more = _medians(values, parts, out)
            found = found.join(more, F.col("k").eqNullSafe(F.col("vk")), "left").drop("vk")
    return found.select(F.col("k").alias(key), *stats)


def _medians(values: DataFrame, parts: DataFrame, name: str) -> DataFrame:
    """Ranks count from 1; an even group has two middle ones."""
    middle = (parts.select("k", "_slice", (F.col("_upto") - F.col("rows")).alias("before"), "_upto",
                           F.expr("(total + 1) div 2").alias("low"),
                           F.expr("total div 2 + 1").alias("high"))
              .where("_upto >= low AND before < high AND _upto > before"))
    at = F.sum("n").over(Window.partitionBy("vk", "vs").orderBy("v")) + F.col("before")
    return (values.join(middle, F.col("vk").eqNullSafe(F.col("k")) & (F.col("vs") == F.col("_slice")))
            .withColumn("at", at)
            .where("at >= low AND at - n < high")
            .groupBy("vk").agg(F.avg(F.col("v").cast("double")).alias(name)))


def median_by(df: DataFrame, key: str, value: str, name: str = "median") -> DataFrame:
    """Exact median of the non-NULL values of each group; NULL is a group too."""
    return value_statistics(df, key, value, {name: "median"})


def take_rows(df: DataFrame, order, n: int, unique: bool = False) -> DataFrame:
    """Exactly the first ``n`` rows by the ascending ``order`` columns, still distributed.

    Unlike ``limit`` this leaves a filter on ``df``, not one partition. NULL
    comes first. Rows with equal order columns cannot be told apart: a cut
    between them, or at a NULL, is an error. ``unique`` says that there are none.
    """
    return take_row_counts(df, order, [n], unique)[0]


def take_row_counts(df: DataFrame, order, counts, unique: bool = False) -> list[DataFrame]:
    """:func:`take_rows` for each of several ``counts``, from one slicing.

    A count between 0 and 1 that is a ``Fraction`` is that part of all rows, rounded down.
    """
    order = [order] if isinstance(order, str) else list(order)
    if not any(isinstance(n, Fraction) or n > 0 for n in counts):
        return [df.where(F.lit(False)) for _ in counts]
    # Copies collapse first, so that no slice is larger for them.
    copies = (df.select(*order, F.lit(1).alias("_copies")) if unique
              else df.groupBy(*order).agg(F.count(F.lit(1)).alias("_copies")))
    slices = range_slices(copies, *order)
    # One row per range partition reaches the driver.
    sizes = slices.groupBy("_slice").agg(F.sum("_copies").alias("rows")).orderBy("_slice").collect()
    total = sum(rows for _, rows in sizes)
    wanted = [total * n.numerator // n.denominator if isinstance(n, Fraction) else n
              for n in counts]
    return [_cut(df, order, n, slices, sizes) for n in wanted]


def _cut(df: DataFrame, order: list[str], n: int, slices: DataFrame, sizes: list) -> DataFrame:
    if n <= 0:
        return df.where(F.lit(False))
    before = 0
    for number, rows in sizes:
        if before + rows >= n:
            break
        before += rows
    else:
        return df
    upto = F.sum("_copies").over(Window.partitionBy("_slice").orderBy(*order)) + before
    last = (slices.where(F.col("_slice") == number).withColumn("_upto", upto)
            .where(F.col("_upto") >= n).orderBy("_upto").first())
    values = [last[c] for c in order]
    if last["_upto"] != n or None in values:
        raise ValueError(f"cannot cut at row {n}: {order} does not identify it")
    return df.where(_not_after(order, values))


def _not_after(order, last):
    upto = F.lit(True)
    for column, value in reversed(list(zip(order, last))):
        here = F.col(column)
        upto = here.isNull() | (here < value) | ((here == value) & upto)
    return upto
