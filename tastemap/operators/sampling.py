"""Fractions and splits by a bucket of the row id.

A bucket test is a filter: it moves no row, and a row stays on its side
however the table is partitioned or re-read.
"""

from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastemap.operators.ranking import take_row_counts


def bucket(key: str, buckets: int, seed: int = 0, hashed: bool = True) -> Column:
    """Bucket of a row; ``hashed=False`` takes an integer key itself, modulo ``buckets``."""
    if hashed:
        return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets))
    return F.pmod(F.coalesce(F.col(key), F.lit(0)), F.lit(buckets))


def take_fraction(df: DataFrame, key: str, num: int, den: int, seed: int = 0,
                  hashed: bool = True) -> DataFrame:
    """About ``num/den`` of the rows, each smaller fraction within the larger ones."""
    if num >= den:
        return df
    return df.where(bucket(key, den, seed, hashed) < num)


def take_exact_fraction(df: DataFrame, key: str, num: int, den: int) -> DataFrame:
    """The first ``rows * num // den`` rows by ``key``, which must identify a row."""
    return take_exact_fractions(df, key, [(num, den)])[0]


def take_exact_fractions(df: DataFrame, key: str, fractions) -> list[DataFrame]:
    """:func:`take_exact_fraction` for each ``(num, den)``, from one slicing of the table."""
    parts = [Fraction(num, den) for num, den in fractions]
    cuts = iter(take_row_counts(df, key, [p for p in parts if p < 1]))
    return [df if p >= 1 else next(cuts) for p in parts]


def split_by_hash(df: DataFrame, key: str, parts: int = 5, train_parts: int = 4,
                  seed: int = 50, hashed: bool = True) -> tuple[DataFrame, DataFrame]:
    """Train and test sides, ``train_parts`` out of ``parts`` buckets for training."""
    side = bucket(key, parts, seed, hashed)
    return df.where(side < train_parts), df.where(side >= train_parts)
