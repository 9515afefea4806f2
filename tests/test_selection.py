"""Exact fractions by radix selection."""

import pytest
from pyspark.sql import functions as F

from tastemap.operators.selection import HASH_BITS, hash_of, select_cuts, take_selected_fractions

FRACTIONS = [(0, 4), (1, 4), (1, 3), (2, 4), (3, 4), (1, 1)]


def ids(df):
    return {r.id for r in df.collect()}


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000, 4321])
def test_exactly_so_many_and_nested(spark, n):
    df = spark.range(n).withColumn("x", F.col("id") * 2)
    found = [ids(part) for part in take_selected_fractions(df, "id", FRACTIONS)]
    assert [len(f) for f in found] == [n * a // b for a, b in FRACTIONS]
    assert all(a <= b for a, b in zip(found, found[1:]))


def test_the_same_rows_on_any_partitioning(spark):
    one, many = (ids(take_selected_fractions(spark.range(0, 999, 1, p), "id", [(1, 3)])[0])
                 for p in (1, 13))
    hashes = sorted((r.h, r.id) for r in spark.range(999).select("id", hash_of("id").alias("h")).collect())
    assert one == many == {i for _, i in hashes[:333]}
    assert 0 <= hashes[0][0] and hashes[-1][0] < 1 << HASH_BITS


@pytest.mark.parametrize("step", [1, 3, 16])
def test_hashes_with_few_values(spark, step):
    """Cuts in the midst of rows that share a hash, which bits alone cannot tell apart."""
    df = spark.range(100)
    hashed = (F.col("id") % 5).cast("long")
    assert select_cuts(df, [1, 20, 21, 99], hashed, 3, step) == [(0, 1), (0, 20), (1, 1), (4, 19)]
    found = ids(take_selected_fractions(df, "id", [(21, 100)], hashed, 3)[0])
    assert found == {i for i in range(100) if i % 5 == 0} | {1}


def test_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None,), (1,), (2,), (3,)], "id long")
    assert sum(len(part.collect()) for part in take_selected_fractions(df, "id", [(1, 2), (3, 4)])) == 5
    twice = spark.createDataFrame([(1,)] * 4, "id long")
    assert take_selected_fractions(twice, "id", [(1, 1)])[0].count() == 4
    with pytest.raises(ValueError, match="identify"):
        take_selected_fractions(twice, "id", [(1, 2)])
    with pytest.raises(ValueError, match="fewer"):
        select_cuts(twice, [5], hash_of("id"))


def test_no_row_is_shuffled(spark, plan, tmp_path):
    spark.range(1000).withColumn("text", F.lit("wide")).write.parquet(f"{tmp_path}/t")
    part = take_selected_fractions(spark.read.parquet(f"{tmp_path}/t"), "id", [(1, 4)])[0]
    assert part.count() == 250
    assert "Exchange" not in plan(part) and "Sort" not in plan(part)
