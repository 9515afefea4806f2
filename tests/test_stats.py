import random
import statistics

import pytest
from pyspark.sql import functions as F

from tastemap.functions.ratings import binarize_rating, category_hue, hue, price_hue
from tastemap.operators.ranking import median_by, range_slices
from tastemap.operators.stats import stats_by, weighted_f1, weighted_mean_by


def test_rating_label(spark):
    df = spark.createDataFrame([(5.0,), (4.0,), (3.5,), (1.0,), (None,), (float("nan"),)],
                               "stars double")
    got = [r.label for r in df.select(binarize_rating("stars").alias("label")).collect()]
    assert got == [1, 1, 0, 0, None, 0]
    whole = spark.createDataFrame([(4,), (3,)], "stars int")
    assert [r.label for r in whole.select(binarize_rating("stars").alias("label")).collect()] \
        == [1, 0]


def test_hue(spark):
    df = spark.createDataFrame([(5.0,), (2.5,), (0.0,), (None,)], "stars double")
    assert [r.h for r in df.select(hue("stars").alias("h")).collect()] == [120, 60, 0, None]


def test_hue_of_price_and_category(spark):
    df = spark.createDataFrame([("$", "a"), ("$$$$", "c"), ("$$$$$", "x"), ("", None), (None, "b"),
                                ("2", "a")], "price string, category string")
    got = df.select(price_hue("price").alias("p"),
                    category_hue("category", ["a", "b", "c"]).alias("c")).collect()
    assert [r.p for r in got] == [30, 120, None, None, None, None]
    assert [r.c for r in got] == [0, 120, None, None, 60, 0]


def test_null_group_and_null_values(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 4.0), ("NV", None), ("CA", 2.0), ("CA", None)],
                               "state string, stars double")
    stats = ("avg", "min", "max", "median", "stddev", "count")
    got = {r.state: tuple(r)[1:] for r in stats_by(df, "state", "stars", stats).collect()}
    assert got.keys() == {None, "NV", "CA"}
    assert got[None][:4] == (2.5, 1.0, 4.0, 2.5)
    assert got["NV"] == (None, None, None, None, None, 0)
    assert got["CA"] == (2.0, 2.0, 2.0, 2.0, None, 1)


def test_all_statistics_of_random_groups(spark, many_slices):
    rng = random.Random(9)
    rows = [(rng.choice("aab") if i % 50 else None, rng.choice([None, 1e6 + rng.random(), 3.5]))
            for i in range(900)] + [("one", 2.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    stats = ("avg", "min", "max", "stddev", "count")
    plain = {r.k: r for r in stats_by(df, "k", "v", stats).collect()}
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    got = {r.k: r for r in stats_by(df, "k", "v", (*stats, "median")).collect()}
    assert got.keys() == plain.keys() == groups.keys()
    for k, row in got.items():
        values = [v for v in groups[k] if v is not None]
        assert row.median == (pytest.approx(statistics.median(values)) if values else None)
        for s in stats:
            assert row[s] == (pytest.approx(plain[k][s], rel=1e-9) if plain[k][s] is not None else None)


def test_median_keeps_the_type_of_extremes(spark):
    df = spark.createDataFrame([("a", 1), ("a", 4)], "k string, v int")
    row = stats_by(df, "k", "v", ("min", "median", "max")).first()
    assert (row["min"], row["median"], row["max"]) == (1, 2.5, 4)
    with pytest.raises(ValueError, match="approx_median"):
        stats_by(df, "k", "v", ("median", "approx_median"))


def test_names_and_unknown_statistic(spark):
    df = spark.createDataFrame([("NV", 1.0)], "state string, stars double")
    assert stats_by(df, "state", "stars", {"mean": "avg", "mid": "median"}).columns == \
        ["state", "mean", "mid"]
    assert stats_by(df, "state", "stars", ("median",)).collect()[0].median == 1.0
    with pytest.raises(ValueError, match="mode"):
        stats_by(df, "state", "stars", ("mode",))


@pytest.mark.parametrize("distinct", [3, 10_000])
def test_median_of_a_hot_group(spark, distinct, many_slices):
    rng = random.Random(distinct)
    keys = ["hot"] * 3000 + [f"k{i % 400}" for i in range(6000)]
    rows = [(k, float(rng.randrange(distinct)) / 8 - 40) for k in keys]
    df = spark.createDataFrame(rows, "k string, v double").repartition(8)
    groups = {}
    for k, v in rows:
        groups.setdefault(k, []).append(v)
    got = {r.k: r.median for r in median_by(df, "k", "v").collect()}
    assert got == {k: statistics.median(v) for k, v in groups.items()}


def test_a_hot_group_spans_slices(spark, many_slices):
    df = spark.range(8000).select(F.lit("hot").alias("k"), F.rand(1).alias("v"))
    sizes = [r["count"] for r in range_slices(df, "k", "v").groupBy("_slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 4000


def test_order_of_statistics(spark):
    df = spark.range(5000).select((F.col("id") % 7).alias("k"), F.xxhash64("id").alias("v"))
    for r in stats_by(df, "k", "v", ("min", "median", "max")).collect():
        assert r.min <= r.median <= r.max
    for r in stats_by(df, "k", "v", ("min", "max", "approx_median")).collect():
        assert r.min <= r.approx_median <= r.max


def test_weighted_mean(spark):
    df = spark.createDataFrame([("NV", 2.0, 4), ("NV", 1.0, 1), ("CA", 0.0, 0)],
                               "s string, total double, n long")
    got = {r.s: r.m for r in weighted_mean_by(df, "s", "total", "n", "m").collect()}
    assert got == {"NV": 0.6, "CA": None}


def test_weighted_f1_known_case(spark):
    pairs = [(0.0, 1), (1.0, 1), (1.0, 0), (1.0, 1), (0.0, 0)]
    df = spark.createDataFrame(pairs, "prediction double, label int")
    got = weighted_f1(df).first()
    assert abs(got.f1 - 0.6) < 1e-12
    assert abs(got.majority_f1 - 0.6 * 2 * 3 / 8) < 1e-12


def test_weighted_f1_agrees_with_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rng = random.Random(3)
    pairs = [(float(rng.choice((0, 1, 1, 2, 4))), float(rng.choice((0, 1, 2, 2, 3))))
             for _ in range(500)]
    df = spark.createDataFrame(pairs, "prediction double, label double")
    expected = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert abs(weighted_f1(df).first().f1 - expected) < 1e-12


def test_weighted_f1_without_pairs(spark):
    df = spark.createDataFrame([(None, 1), (1.0, None), (None, None)],
                               "prediction double, label int")
    assert tuple(weighted_f1(df).first()) == (None, None)
    assert tuple(weighted_f1(df.where("false")).first()) == (None, None)
