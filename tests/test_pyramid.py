"""The cell pyramid: sums of levels, keys, views."""

import math

import pytest
from pyspark.sql import functions as F

from tastemap.functions.geo import HALF_SIDE
from tastemap.operators.pyramid import cell_pyramid, cells_in_view, write_pyramid


@pytest.fixture(scope="module")
def points(spark):
    """Scattered points, a third of them at one place, some on the edges, some nowhere."""
    row = F.col("id")
    part = [F.pmod(F.xxhash64(row, F.lit(i)), F.lit(100_000)) / 100_000 for i in (0, 1)]
    x, y = ((p * 2 - 1) * HALF_SIDE for p in part)
    edge = F.when(row % 97 == 1, HALF_SIDE).when(row % 97 == 2, -HALF_SIDE)
    hot = F.when(row % 3 == 0, 1234.5)
    return spark.range(0, 5000, 1, 6).select(
        "id", F.coalesce(hot, edge, x).alias("x"),
        F.when(row % 101 != 0, F.coalesce(hot, edge, y)).alias("y"),
        F.when(row % 5 != 0, row % 7).cast("int").alias("rating"),
        F.lit(None).cast("double").alias("sentiment"))


def brute(rows, zoom):
    side, cells = 1 << zoom, {}
    for r in rows:
        if r.x is None or r.y is None:
            continue
        column, row = (min(max(math.floor(v / (2 * HALF_SIDE) * side), 0), side - 1)
                       for v in (r.x + HALF_SIDE, HALF_SIDE - r.y))
        cells.setdefault((column, row), []).append(r.rating)
    return cells


def test_as_by_brute_force(points):
    rows, found = points.collect(), cell_pyramid(points, 6).collect()
    for zoom in range(7):
        level = {(c.column, c.row): c for c in found if c.zoom == zoom}
        expected = brute(rows, zoom)
        assert set(level) == set(expected)
        for place, ratings in expected.items():
            cell, known = level[place], [r for r in ratings if r is not None]
            assert cell.n == len(ratings) and cell.sentiment is None
            assert cell.rating == (pytest.approx(sum(known) / len(known)) if known else None)
            bits = [(place[i] >> b & 1) << 2 * b + 1 - i for b in range(zoom) for i in (0, 1)]
            assert cell.cell == sum(bits)


def test_every_level_has_all_placed_points(points):
    placed = points.where("x IS NOT NULL AND y IS NOT NULL").count()
    sums = cell_pyramid(points).groupBy("zoom").agg(F.sum("n").alias("n"), F.max("n")).collect()
    assert len(sums) == 21 and {r.n for r in sums} == {placed}


def test_views(spark, points, tmp_path, plan):
    write_pyramid(cell_pyramid(points, 8), f"{tmp_path}/p")
    whole = cells_in_view(spark, f"{tmp_path}/p", -HALF_SIDE, -HALF_SIDE, HALF_SIDE, HALF_SIDE, 64)
    assert {r.zoom for r in whole.collect()} == {3}
    quarter = cells_in_view(spark, f"{tmp_path}/p", 1.0, 1.0, HALF_SIDE, HALF_SIDE, 64)
    zooms = {r.zoom for r in quarter.collect()}
    assert zooms == {4} and "PartitionFilters: [isnotnull(zoom" in plan(quarter)
    found = {(r.column, r.row): r.n for r in quarter.collect()}
    assert found == {p: len(v) for p, v in brute(points.collect(), 4).items()
                     if p[0] >= 8 and p[1] < 8}
    assert quarter.count() <= 64
    one = cells_in_view(spark, f"{tmp_path}/p", 0.0, 0.0, 1.0, 1.0)
    assert {r.zoom for r in one.collect()} <= {8}


def test_no_points(points):
    assert cell_pyramid(points.limit(0), 3).count() == 0
    assert cell_pyramid(points.where("y IS NULL"), 3).count() == 0
