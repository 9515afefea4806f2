import pytest
from pyspark.sql import functions as F

from tastemap.operators.ranking import take_rows
from tastemap.operators.sampling import (split_by_hash, take_exact_fraction,
                                         take_exact_fractions, take_fraction)


def ids(df, key="id"):
    return sorted(r[0] for r in df.select(key).collect())


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("id"))
    train, test = split_by_hash(df, "id")
    assert not set(ids(train)) & set(ids(test))
    assert sorted(ids(train) + ids(test)) == ids(df)
    assert 1500 < train.count() < 1700
    again, _ = split_by_hash(df.repartition(7), "id")
    assert ids(again) == ids(train)
    other, _ = split_by_hash(df, "id", seed=100)
    assert ids(other) != ids(train)


@pytest.mark.parametrize("hashed", [True, False])
def test_null_keys_are_on_one_side(spark, hashed):
    df = spark.createDataFrame([(None,), (1,), (4,)], "id long")
    train, test = split_by_hash(df, "id", hashed=hashed)
    assert train.count() + test.count() == 3


def test_fractions_nest(spark):
    df = spark.range(4000)
    parts = [set(ids(take_fraction(df, "id", j, 4))) for j in (1, 2, 3, 4)]
    assert parts[0] < parts[1] < parts[2] < parts[3] == set(range(4000))
    assert 850 < len(parts[0]) < 1150
    assert ids(take_fraction(df, "id", 1, 4, hashed=False)) == list(range(0, 4000, 4))


@pytest.mark.parametrize("n", [0, 1, 332, 333, 999, 1000, 5000])
def test_exact_rows(spark, n, many_slices):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("id")).repartition(5)
    assert ids(take_rows(df, "id", n)) == list(range(min(n, 1000)))


def test_exact_fraction(spark):
    assert take_exact_fraction(spark.range(1001), "id", 2, 3).count() == 667


def test_many_fractions_from_one_slicing(spark, many_slices):
    cuts = take_exact_fractions(spark.range(1001).repartition(4), "id", [(0, 5), (1, 5), (2, 3), (5, 5)])
    assert [c.count() for c in cuts] == [0, 200, 667, 1001]
    assert ids(cuts[1]) == list(range(200))


def test_exact_rows_by_two_columns(spark, many_slices):
    rows = [(i % 3, f"t{i:03}") for i in range(300)]
    df = spark.createDataFrame(rows, "a int, b string")
    got = sorted(tuple(r) for r in take_rows(df, ["a", "b"], 150).collect())
    assert got == sorted(rows)[:150]


def test_exact_rows_by_columns_of_any_name(spark):
    df = spark.range(100).select(F.col("id").alias("slice"), (-F.col("id")).alias("copies"))
    assert ids(take_rows(df, ["slice", "copies"], 10), "slice") == list(range(10))


def test_exact_rows_by_a_unique_key(spark, many_slices):
    df = spark.range(500).repartition(3)
    assert ids(take_rows(df, "id", 123, unique=True)) == list(range(123))


def test_null_keys_come_first(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (1, None), (1, "c"), (2, "d")],
                               "a int, b string")
    got = [tuple(r) for r in take_rows(df, ["a", "b"], 4).collect()]
    assert set(got) == {(None, "b"), (None, "a"), (1, None), (1, "c")}


def test_cut_between_copies_is_an_error(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id int")
    with pytest.raises(ValueError, match="does not identify"):
        take_rows(df, "id", 2)
    assert ids(take_rows(df, "id", 3)) == [1, 2, 2]
    with pytest.raises(ValueError):
        take_rows(spark.createDataFrame([(None,), (1,)], "id int"), "id", 1)
