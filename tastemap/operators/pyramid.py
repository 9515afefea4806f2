"""A pyramid of map cells: counts per square at every zoom level, so a page reads cells.

The square map is cut into 2**zoom columns and rows. A cell's key takes the bits of its
column and row in turn, so the cell above it at the next lower zoom is the key without the
last two bits, and neighbours on the map are mostly neighbours in key order.
"""

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.functions.geo import HALF_SIDE
from tastemap.sources.clustered import z_order
from tastemap.sources.tables import check_target, read_table

# Cells of the deepest level are some 40 metres wide at the equator.
ZOOM = 20


def place_in_grid(metres: Column, zoom: int, from_north: bool = False) -> Column:
    """Column (or row, counted from the north) of a position; the map's edge is inside."""
    offset = HALF_SIDE - metres if from_north else metres + HALF_SIDE
    place = F.floor(offset / (2 * HALF_SIDE) * float(1 << zoom))
    return F.when(offset.isNotNull() & ~F.isnan(offset),
                  F.least(F.greatest(place, F.lit(0)), F.lit((1 << zoom) - 1)))


def with_cell(points: DataFrame, x: str = "x", y: str = "y", zoom: int = ZOOM) -> DataFrame:
    """``points`` with the ``cell`` that holds each; NULL without a position."""
    places = {"_column": place_in_grid(F.col(x), zoom), "_row": place_in_grid(F.col(y), zoom, True)}
    return points.withColumns(places).withColumn(
        "cell", z_order([F.col("_column"), F.col("_row")], zoom)).drop(*places)


def cell_pyramid(points: DataFrame, zoom: int = ZOOM, values=("rating", "sentiment"), x: str = "x",
                 y: str = "y") -> DataFrame:
    """``zoom, cell, column, row, n`` and each value's mean, for all levels from 0 to ``zoom``.

    Points without a position are in no cell; ``n`` of every level sums to all others. Points
    are counted once, in the deepest cells; the levels above are summed from those. A crowded
    place is one row a task in either step. The mean is NULL where no point has the value.
    """
    sums = {v: (F.sum(v).cast("double"), F.count(v)) for v in values}
    deepest = (with_cell(points, x, y, zoom).where("cell IS NOT NULL")
               .groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *(
                   column.alias(f"_{part}_{v}") for v, pair in sums.items()
                   for part, column in zip(("sum", "n"), pair))))
    levels = deepest.withColumn("zoom", F.explode(F.sequence(F.lit(0), F.lit(zoom)))).withColumn(
        "cell", F.expr(f"shiftright(cell, 2 * ({zoom} - zoom))"))
    found = levels.groupBy("zoom", "cell").agg(F.sum("n").alias("n"), *(
        F.try_divide(F.sum(f"_sum_{v}"), F.sum(f"_n_{v}")).alias(v) for v in values))
    return found.select("zoom", "cell", _alternate(1, zoom).alias("column"),
                        _alternate(0, zoom).alias("row"), "n", *values)


def _alternate(first: int, zoom: int) -> Column:
    """Every other bit of the key, from bit ``first``."""
    bits = [F.shiftleft(F.shiftright("cell", 2 * b + first).bitwiseAND(F.lit(1)), b)
            for b in range(max(zoom, 1))]
    found = bits[0]
    for bit in bits[1:]:
        found = found.bitwiseOR(bit)
    return found.cast("int")


def write_pyramid(pyramid: DataFrame, path: str, sources=()) -> None:
    """A folder per level, its cells in the order of their keys."""
    check_target(pyramid.sparkSession, path, sources)
    (pyramid.repartitionByRange("zoom", "cell").sortWithinPartitions("zoom", "cell")
     .write.mode("overwrite").partitionBy("zoom").parquet(path))


def cells_in_view(spark: SparkSession, path: str, west: float, south: float, east: float,
                  north: float, cells: int = 4096) -> DataFrame:
    """Cells of a written pyramid in a rectangle, in metres, at the deepest level at which there
    can be no more than ``cells`` of them.

    Only that level's folder is read, and of it the row groups whose columns and rows meet
    the rectangle.
    """
    table = read_table(spark, path)
    deepest = table.agg(F.max("zoom")).first()[0] or 0
    zoom = 0
    for level in range(deepest + 1):
        columns, rows = _range(west, east, level), _range(-north, -south, level)
        if (columns[1] - columns[0] + 1) * (rows[1] - rows[0] + 1) <= cells or level == 0:
            zoom = level
    columns, rows = _range(west, east, zoom), _range(-north, -south, zoom)
    return table.where((F.col("zoom") == zoom) & F.col("column").between(*columns)
                       & F.col("row").between(*rows))


def _range(low: float, high: float, zoom: int) -> tuple[int, int]:
    side = 1 << zoom
    return tuple(min(max(math.floor((v + HALF_SIDE) / (2 * HALF_SIDE) * side), 0), side - 1)
                 for v in (low, high))
