"""Sketched medians: bounds on ranks, parts that add up, sizes that do not grow."""

import pytest
from pyspark.sql import functions as F

from tastemap.operators.sketches import (K, merged_quantiles, quantile_sketches, rank_error,
                                         rank_misses)


@pytest.fixture(scope="module")
def ratings(spark):
    """Group 0 has a third of the rows; values are skewed, with ties, NULL and NaN."""
    row = F.col("id")
    noise = F.pmod(F.xxhash64(row), F.lit(1_000_003)) / 1000
    value = F.when(row % 50 == 0, None).when(row % 51 == 0, float("nan")) \
        .when(row % 5 == 0, 17.0).otherwise(noise * noise)
    return spark.range(0, 300_000, 1, 12).select(
        F.when(row % 3 == 0, 0).otherwise(row % 7).alias("g"), (row % 4).alias("day"),
        value.alias("x"))


@pytest.fixture(scope="module")
def stored(ratings, tmp_path_factory, spark):
    path = str(tmp_path_factory.mktemp("sketches") / "s")
    for day in range(4):  # a part at a time, as they come
        quantile_sketches(ratings.where(F.col("day") == day), ["g"], "x", ["day"]).write.mode(
            "append").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("days", [None, [1], [0, 3]])
def test_ranks_within_the_bound(ratings, stored, days):
    rows, sketches = ratings, stored
    if days is not None:
        rows, sketches = (df.where(F.col("day").isin(days)) for df in (rows, sketches))
    for rank in (0.1, 0.5, 0.99):
        found = merged_quantiles(sketches, ["g"], {"q": rank})
        misses = rank_misses(rows, ["g"], "x", found, "q", rank).collect()
        assert len(misses) == 7 and max(r.miss for r in misses) < 2 * rank_error()
    exact = {r.g: (r.n, r.low, r.high) for r in rows.where("NOT isnan(x)").groupBy("g").agg(
        F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()}
    ends = merged_quantiles(sketches, ["g"], {"low": 0, "high": 1}).collect()
    assert {r.g: (r.n, r.low, r.high) for r in ends} == exact


def test_small_groups_are_exact(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(1, 100)] + [("b", 5.0)], "g string, x double")
    found = {r.g: r["median"] for r in merged_quantiles(quantile_sketches(df, ["g"], "x"), ["g"]).collect()}
    assert found == {"a": 50.0, "b": 5.0}


def test_a_hot_group_has_no_larger_sketch(ratings):
    sizes = {r.g: r.size for r in quantile_sketches(ratings, ["g"], "x").select(
        "g", F.length("sketch").alias("size")).collect()}
    assert sizes[0] < 2 * sizes[1] and max(sizes.values()) < 32 * K
    assert rank_error(200) == pytest.approx(0.0133, abs=1e-4)


def test_what_moves_is_one_row_per_task_and_group(ratings, plan):
    df = quantile_sketches(ratings, ["g"], "x")
    df.collect()
    text = plan(df)
    assert text.index("partial_kll_sketch_agg_double") > text.index("Exchange hashpartitioning(g")
    assert "Python" not in text


def test_no_values(spark):
    df = spark.createDataFrame([("a", None), ("b", float("nan")), ("c", 1.0)], "g string, x double")
    sketches = quantile_sketches(df, ["g"], "x")
    found = {r.g: (r.n, r["median"]) for r in merged_quantiles(sketches, ["g"]).collect()}
    assert found == {"a": (0, None), "b": (0, None), "c": (1, 1.0)}
    assert merged_quantiles(sketches.limit(0), ["g"]).count() == 0
