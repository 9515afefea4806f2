"""Tables laid out so that filters skip most of them: Z-order, statistics, Bloom filters.

Rows that are close in several columns are stored together, so each Parquet row group has
a narrow range of every one of them, and the scan passes over the groups that a filter on
any of the columns rules out. For values that ranges cannot rule out a column may have
Bloom filters.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemap.sources.tables import check_target

# Bits of a column in the order; twice as many bins need one more.
BITS = 6
# Bytes of a row group before compression, and of its Bloom filter per column.
ROW_GROUP, BLOOM = 16 << 20, 1 << 20


def write_clustered(df: DataFrame, path: str, by: list[str], *, bloom: list[str] = (),
                    bits: int = BITS, row_group: int = ROW_GROUP, bloom_bytes: int = BLOOM,
                    partitions: int | None = None, mode: str = "overwrite", sources=()) -> None:
    """Write ``df`` in the Z-order of the columns ``by``, which may be of any type with an order.

    Each column is cut into bins of about equal numbers of rows, by bounds that a sample
    gives: they shape the layout, never the result. The bits of the bins taken in turn are
    the order; rows of one bin follow the columns themselves, so that a value with a third of
    all rows is spread over many row groups by the other columns. NULL comes first.
    """
    check_target(df.sparkSession, path, sources)
    cut = {c: bounds(df, c, 1 << bits) for c in by}
    # In columns of their own, so that a bin is found once and not for each of its bits.
    bins = df.withColumns({f"_bin{i}": bin_of(c, cut[c]) for i, c in enumerate(by)})
    placed = bins.withColumn("_order", z_order([F.col(f"_bin{i}") for i in range(len(by))], bits))
    order = ["_order", *by]
    dealt = (placed.repartitionByRange(*order) if partitions is None
             else placed.repartitionByRange(partitions, *order))
    writer = dealt.sortWithinPartitions(*order).select(df.columns).write.mode(mode)
    writer = writer.option("parquet.block.size", row_group)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.option("parquet.bloom.filter.max.bytes", bloom_bytes).parquet(path)


def bounds(df: DataFrame, column: str, bins: int) -> list:
    """The least values of up to so many ranges of a column with about equal numbers of rows."""
    ranges = (df.select(column).where(F.col(column).isNotNull())
              .repartitionByRange(bins, column).groupBy(F.spark_partition_id())
              .agg(F.min(column).alias("least")))
    return sorted(r.least for r in ranges.collect() if r.least is not None)


def bin_of(column: str, least: list) -> Column:
    """Number of the bin of a value: how many of the bounds but the first it has reached."""
    if len(least) < 2:
        return F.lit(0)
    reached = [(F.col(column) >= F.lit(b)).cast("int") for b in least[1:]]
    # A tree of sums, so that the expression is not as deep as it is long.
    while len(reached) > 1:
        reached = [reduce(Column.__add__, reached[i:i + 2]) for i in range(0, len(reached), 2)]
    return F.coalesce(reached[0], F.lit(0))


def z_order(bins: list[Column], bits: int) -> Column:
    """The bits of several numbers in turn, highest first, as one."""
    places = [F.shiftleft(F.shiftright(b, bit).bitwiseAND(F.lit(1)).cast("long"),
                          bit * len(bins) + len(bins) - 1 - i)
              for i, b in enumerate(bins) for bit in range(bits)]
    return reduce(Column.bitwiseOR, places)
